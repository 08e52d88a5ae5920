import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.plans.incremental_orders import check_core, core_near, core_orders, load_batch, load_initial
from ledgerloom.sources.contracts import ORDER_LINES
from ledgerloom.sources.part_checks import standing_violations, write_checks
from ledgerloom.sources.part_index import parts_of_keys, write_index
from ledgerloom.sources.run_log import RunLog
from ledgerloom.sources.snapshots import Snapshots

HEADER = "order_id,line_id,order_date,customer_id,product_id,quantity,unit_price,updated_at\n"


def line(order, day, quantity=1, changed=None):
    return f"{order},1,{day},,P,{quantity},1,{changed or day} 00:00:00\n"


@pytest.fixture
def store(spark, tmp_path, table):
    made = Snapshots(spark, str(tmp_path / "store"))
    # Ranges of the three months overlap, so only the bits can tell them apart.
    days = [f"2026-0{m}-{d:02d}" for m in (1, 2, 3) for d in range(1, 21)]
    load_initial(made, table(HEADER + "".join(line(f"{i % 20:02d}-{day[5:7]}", day) for i, day in enumerate(days))))
    return made


def test_parts_are_named_by_range_and_bits(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    r = random.Random(1)
    rows = [(p, k, r.randint(0, 9)) for p in ("a", "b", "c", "d") for k in r.sample(range(10_000 * (p == "d"), 9_000 + 50_000 * (p == "d")), 3000)]
    df = spark.createDataFrame(rows, "p string, k long, n int")
    parts = store.write_parts("layer", df, F.col("p"), ["k", "n"], 2)
    store.publish({**parts, **write_index(store, "layer", df, F.col("p"), ["k", "n"])})
    schema = df.drop("p").schema
    held = {p: {(k, n) for q, k, n in rows if q == p} for p in "abcd"}

    def named(keys):
        return set(parts_of_keys(store, "layer", schema, spark.createDataFrame(keys, "k long, n int"), ["k", "n"]))

    for p in "abcd":  # never is a part missed
        some = r.sample(sorted(held[p]), 5)
        assert {p} <= named(some) and {q for q in "abcd" if held[q] & set(some)} <= named(some)
    assert named([(70_000, 1), (-5, 2)]) == set()  # in no range
    absent = [(k, 10 + n) for k, n in r.sample(sorted(held["a"]), 400)]
    bits = spark.read.parquet(*[f"{store.root}/{f}" for f in store.parts("layer_index").values()])
    assert {tuple(x) for x in bits.groupBy("of_part").agg(F.max("keys"), F.max("blocks")).collect()} == {(p, 3000, 2) for p in "abcd"}
    wrong = sum(bool(named([key])) for key in absent[:12])
    assert wrong <= 3  # about one key in a hundred per part


def test_a_part_without_an_index_is_always_read(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, k long")
    store.publish(store.write_parts("layer", df, F.col("p"), ["k"], 2))
    batch = spark.createDataFrame([(5,)], "k long")
    assert sorted(parts_of_keys(store, "layer", batch.schema, batch, ["k"])) == ["a", "b"]
    only = df.where("p = 'a'")
    store.publish(write_index(store, "layer", only, F.col("p"), ["k"]))
    assert parts_of_keys(store, "layer", batch.schema, batch, ["k"]) == ["b"]


def test_months_without_a_key_of_the_batch_are_not_read(spark, tmp_path, table, store):
    log = RunLog(spark, str(tmp_path / "runs"))
    january = tmp_path / "store" / store.parts("core")["core/2026-01"]
    shutil.move(str(january), str(tmp_path / "away"))  # reading it would fail
    january.mkdir(parents=True)
    (january / "part-0-x_00000.c000.snappy.parquet").write_text("no parquet")
    batch = HEADER + line("05-02", "2026-02-06", 7, "2026-02-09") + line("new", "2026-03-30")
    result = load_batch(store, log, lambda: table(batch))
    assert (result.inserted_rows, result.updated_rows) == (1, 1)
    shutil.rmtree(january)
    shutil.move(str(tmp_path / "away"), str(january))
    core = {r["order_id"]: r["quantity"] for r in core_orders(store).collect()}
    assert len(core) == 61 and core["05-02"] == 7 and core["new"] == 1
    check_core(store)


def test_the_core_is_joined_where_it_lies(spark, table, store):
    changes = core_orders(store).where("line_id = 1").withColumn("updated_at", F.lit(dt.datetime(2027, 1, 1)))
    batch = spark.createDataFrame(changes.limit(30).collect(), changes.schema)

    def exchanges_on_core(df):
        """Exchanges between a scan of the core and the rest of the plan."""
        found, above = 0, []
        for text in df._jdf.queryExecution().executedPlan().toString().splitlines():
            depth = len(text) - len(text.lstrip(" :+-"))
            above = [(d, t) for d, t in above if d < depth] + [(depth, text)]
            if "FileScan" in text and "ledgerloom_read_" in text:
                assert "Bucketed: true" in text
                found += sum("Exchange" in t for _, t in above)
        return found

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        core = core_near(store, batch)
        classified = inc.classify_changes(core, batch, ORDER_LINES.key, "updated_at", [], carry=["order_date"])
        assert exchanges_on_core(classified) == 0
        merged = inc.apply_changes(core, inc.effective_changes(classified), ORDER_LINES.key)
        assert exchanges_on_core(merged) == 0 and "FullOuter" in merged._jdf.queryExecution().executedPlan().toString()
        assert exchanges_on_core(inc.upsert(core, batch, ORDER_LINES.key, "updated_at", [])) == 0
        assert merged.count() == core.count() == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_month_has_one_file_per_bucket(tmp_path, table, spark, store):
    load_batch(store, RunLog(spark, str(tmp_path / "runs")), lambda: table(HEADER + line("05-02", "2026-02-06", 7, "2026-02-09")))
    for folder in store.parts("core").values():
        buckets = [p.name.split("_")[-1] for p in (tmp_path / "store" / folder).glob("part-*")]
        assert len(buckets) == len(set(buckets)) <= ORDER_LINES.buckets


def counts(df):
    return {r["rule"]: r["violations"] for r in df.collect()}


def test_stored_checks_equal_checks_of_the_whole_core(spark, tmp_path, table, store):
    log, r = RunLog(spark, str(tmp_path / "runs")), random.Random(7)
    for i in range(5):
        day = f"2026-0{r.randint(1, 4)}-1{i}"
        lines = "".join(line(f"{r.randint(0, 25):02d}-0{r.randint(1, 3)}", day, r.randint(1, 9), f"2026-05-{i + 1:02d}") for _ in range(6))
        load_batch(store, log, lambda lines=lines: table(HEADER + lines))
        assert counts(standing_violations(store, "core", ORDER_LINES)) == counts(ORDER_LINES.table_violations(core_orders(store)))
    check_core(store)


def test_faults_that_got_into_parts_are_counted(spark, tmp_path, table):
    store = Snapshots(spark, str(tmp_path / "store"))
    month = F.date_format("order_date", "yyyy-MM")

    def put(*lines):  # writes parts past all checks of a load
        rows = ORDER_LINES.typed(table(HEADER + "".join(lines))).select(*ORDER_LINES.columns)
        written = store.write_parts("core", rows, month, ORDER_LINES.key, ORDER_LINES.buckets)
        index = write_index(store, "core", rows, month, ORDER_LINES.key)
        gone = {n.replace("core/", "core_shared/"): None for n in written}
        after = [{**store.parts(layer), **made} for layer, made in (("core", written), ("core_index", index))]
        checks = write_checks(store, "core", ORDER_LINES, rows, month, *after)
        store.publish({**gone, **written, **index, **checks})
        assert counts(standing_violations(store, "core", ORDER_LINES)) == counts(ORDER_LINES.table_violations(core_orders(store)))

    assert standing_violations(store, "core", ORDER_LINES) is not None
    put(line("A", "2026-01-05"), line("A", "2026-01-06"), line("B", "2026-01-05", -1), line("C", "2026-02-05"))
    put(line("B", "2026-03-05"), line("C", "2026-03-05"), line("A", "2026-03-05"), line("D", "2026-03-05", 0))
    assert counts(standing_violations(store, "core", ORDER_LINES))["key_unique"] == 3
    with pytest.raises(Exception, match="key_unique: 3"):
        check_core(store)
    put(line("E", "2026-01-05"))  # only C is repeated now
    put(line("F", "2026-02-05"))
    check_now = counts(standing_violations(store, "core", ORDER_LINES))
    assert check_now["key_unique"] == 0 and check_now["quantity_positive"] == 1
