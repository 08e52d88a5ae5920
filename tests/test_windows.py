import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import versions, windows

WIDTHS = windows.width_slices(7, 50)


def brute_force(data):
    """(group, moment, id, value) rows with their window results, one by one."""
    out = []
    for g, moment, i, value in data:
        mine = sorted((m, j, v) for h, m, j, v in data if h == g)
        at = mine.index((moment, i, value))
        held = [v for _, _, v in mine[: at + 1] if v is not None]
        newer = [(m, j) for m, j, _ in mine if m > moment]
        out.append(
            (
                g,
                i,
                sum(held) if held else None,
                mine[at - 1][2] if at else None,
                len(newer) + 1 + sum(1 for m, j, _ in mine if m == moment and j < i),
                len(newer) + 1,
                len({m for m, _ in newer}) + 1,
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("slices", [(), WIDTHS[:1], WIDTHS])
def test_sliced_windows_equal_brute_force(spark, rows, seed, slices):
    rng = random.Random(seed)
    # One group holds most rows; one has a null key.
    data = [
        (rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(120), i, rng.choice([None, 1, 5, 9]))
        for i in range(150)
    ]
    df = spark.createDataFrame(data, "g string, moment int, id int, value int")
    result = windows.running_sum(df, ["g"], ["moment", "id"], "value", "running", slices)
    result = windows.previous_values(result, ["g"], ["moment", "id"], ["value"], slices)
    result = windows.ranked(result, ["g"], ["moment"], ["id"], slices[0] if slices else None)
    columns = ["g", "id", "running", "previous_value", "row_number", "rank", "dense_rank"]
    plain = [(g or "", *rest) for g, *rest in brute_force([(g or "", m, i, v) for g, m, i, v in data])]
    assert rows(result.fillna({"g": ""}), *columns) == plain


def test_no_task_holds_a_whole_hot_group(spark):
    df = spark.range(1000).select(F.lit("hot").alias("g"), F.col("id").alias("moment"), F.lit(1).alias("v"))
    plan = windows.running_sum(df, ["g"], ["moment"], "v", "r", windows.width_slices(10, 100))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [l for l in text.splitlines() if "Window" in l and "_kind" in l]
    assert row_windows and all("_slice" in line for line in row_windows)
    assert plan.agg(F.max("r")).first()[0] == 1000


def test_running_sum_across_days_and_gaps(spark, rows):
    moves = {"north": [(1, 7), (2, -3), (9, 4)], "south": [(4, 10), (30, 1), (31, -11)]}
    data = [(depot, f"2025-03-{day:02d}", n) for depot, days in moves.items() for day, n in days]
    df = spark.createDataFrame(data, "depot string, day string, moved int").withColumn("day", F.to_date("day"))
    result = windows.running_sum(df, ["depot"], ["day"], "moved", "stock", windows.time_slices("DAY"))
    assert [r[2] for r in rows(result, "depot", F.col("day").cast("string"), "stock")] == [7, 4, 8, 10, 11, 0]


def test_ranks_with_a_hot_rank_cut_by_its_ties(spark, rows):
    data = [("hot", 5, i) for i in range(90)] + [("hot", 9, 100), ("hot", 1, 101), ("b", 5, 200)]
    df = spark.createDataFrame(data, "g string, points int, id int")
    result = windows.ranked(df, ["g"], ["points"], ["id"], windows.width_slices(10)[0])
    mine = {r["id"]: (r["row_number"], r["rank"], r["dense_rank"]) for r in result.collect()}
    assert mine[100] == (1, 1, 1) and mine[101] == (92, 92, 3) and mine[200] == (1, 1, 1)
    assert [mine[i] for i in (0, 9, 10, 89)] == [(2, 2, 2), (11, 2, 2), (12, 2, 2), (91, 2, 2)]
    text = result._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [line for line in text.splitlines() if "Window" in line and "_kind" in line]
    assert row_windows and all("_slice" in line for line in row_windows)


# Firmware versions per (site, device): two claim the newest moment of (1, "pump").
VERSIONS = [
    (1, "pump", "v1", "beta", 100),
    (1, "pump", "v2", "beta", 250),
    (1, "pump", "v3", "final", 400),
    (1, "pump", "v4", "beta", 400),
    (1, "valve", "v7", "final", 90),
    (2, "pump", "v2", "final", 300),
]
KEY = ["site", "device"]


def history(spark):
    return spark.createDataFrame(VERSIONS, "site int, device string, firmware string, stage string, moment int")


def test_ranks_and_changes_of_versions(spark, rows):
    df = history(spark)
    ranks = windows.ranked(df, KEY, ["moment"], ["firmware"])
    mine = ranks.filter("site = 1 AND device = 'pump'").orderBy("row_number")
    assert [tuple(r) for r in mine.select("firmware", "row_number", "rank", "dense_rank").collect()] == [
        ("v3", 1, 1, 1),
        ("v4", 2, 1, 1),
        ("v2", 3, 3, 2),
        ("v1", 4, 4, 3),
    ]
    before = windows.previous_values(df, KEY, ["moment", "firmware"], ["firmware", "stage"])
    flagged = before.select(
        *KEY,
        "firmware",
        windows.changed(F.col("firmware"), F.col("previous_firmware")).alias("newer"),
        windows.changed(F.col("stage"), F.col("previous_stage")).alias("moved"),
    )
    assert rows(flagged) == [
        (1, "pump", "v1", False, False),
        (1, "pump", "v2", True, False),
        (1, "pump", "v3", True, True),
        (1, "pump", "v4", True, True),
        (1, "valve", "v7", False, False),
        (2, "pump", "v2", False, False),
    ]


def test_current_and_ambiguous_versions(spark, rows):
    df = history(spark)
    resolved = versions.resolve_versions(df, KEY, "moment")
    assert rows(versions.ambiguous_keys(resolved, KEY)) == [(1, "pump", 2)]
    assert rows(versions.current_rows(resolved), *KEY, "firmware") == [(1, "valve", "v7"), (2, "pump", "v2")]
    assert rows(versions.ambiguous_rows(df, resolved, KEY, "moment"), "firmware") == [("v3",), ("v4",)]
    assert versions.latest_candidates(df, KEY, "moment").count() == 4
    latest = versions.latest_version(df, KEY, "moment", ["firmware"])
    assert rows(latest, *KEY, "firmware") == [(1, "pump", "v4"), (1, "valve", "v7"), (2, "pump", "v2")]
    with pytest.raises(TypeError):
        versions.latest_version(df, KEY, "moment")


def test_versions_without_a_readable_time(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", None, 2), ("b", None, 3), ("b", "2026-01-01", 4), ("c", None, 5)],
        "k string, at string, v int",
    )
    resolved = versions.resolve_versions(df, ["k"], "at")
    assert rows(versions.current_rows(resolved), "k", "v") == [("b", 4), ("c", 5)]
    assert rows(versions.ambiguous_rows(df, resolved, ["k"], "at"), "k", "v") == [("a", 1), ("a", 2)]
    assert rows(versions.latest_candidates(df, ["k"], "at"), "v") == [(1,), (2,), (4,), (5,)]


def test_a_hot_group_is_cut_along_a_text_column(spark, tmp_path):
    path = str(tmp_path / "rows")
    name = F.concat(F.md5(F.col("id").cast("string")), F.lit("-"), "id")
    spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.lit("b")).otherwise(F.lit("hot")).alias("g"),
        F.when(F.col("id") % 5 == 1, F.lit("same")).otherwise(name).alias("name"),
        F.col("id").alias("i"),
        (F.col("id") % 7).alias("v"),
    ).write.parquet(path)
    df = spark.read.parquet(path)
    slices = windows.quantile_slices(df, "name", rows=250)
    sizes = df.groupBy("g", slices[0](F.col("name")).alias("at")).agg(F.count("*").alias("n"), F.min("name").alias("low"), F.max("name").alias("high"))
    cut = sorted(tuple(r) for r in sizes.where("g = 'hot'").collect())
    assert len(cut) > 10 and max(n for _, _, n, low, high in cut if low != high) < 800
    assert all(a[4] < b[3] for a, b in zip(cut, cut[1:], strict=False))  # slices follow each other
    assert ("same", "same") in [c[3:] for c in cut]  # the frequent value alone
    plain = windows.running_sum(df, ["g"], ["name", "i"], "v", "sum")
    sliced = windows.running_sum(df, ["g"], ["name", "i"], "v", "sum", slices)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, sliced.collect()))
    before = windows.previous_values(df, ["g"], ["name", "i"], ["v"], slices)
    assert sorted(map(str, before.collect())) == sorted(map(str, windows.previous_values(df, ["g"], ["name", "i"], ["v"]).collect()))
    assert "hashpartitioning(g" in sliced._jdf.queryExecution().executedPlan().toString()
    assert windows.quantile_slices(df, "name") == [] and windows.quantile_slices(df.where("i < 0"), "name", rows=0 + 1) == []
