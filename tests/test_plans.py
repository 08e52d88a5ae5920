"""Plans: what reaches the scan, where data is shuffled, how skew is split."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import keys, partitions, versions
from ledgerloom.operators.joins import enrich_with_status
from ledgerloom.plans import order_quality


@pytest.fixture
def lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(2000).select(
        (F.col("id") % 50).alias("key"),
        F.col("id").alias("moment"),
        F.lit("x").alias("text"),
        (F.col("id") % 7).alias("amount"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def test_filters_and_columns_reach_the_scan(lines):
    plan = partitions.plan_text(lines.filter("moment >= 100").groupBy("key").agg(F.sum("amount")))
    assert "GreaterThanOrEqual(moment,100)" in plan
    assert "ReadSchema: struct<key:bigint,moment:bigint,amount:bigint>" in plan


def test_latest_version_keeps_one_row_per_key_before_its_shuffle(lines):
    plan = partitions.plan_text(versions.latest_version(lines, ["key"], "moment", ()), "simple")
    before, _, after = plan.partition("Exchange hashpartitioning(key")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after and "Partial" in after
    assert shuffles(plan) == 1


def test_key_counts_are_reduced_before_the_shuffle(lines):
    for found in (keys.duplicate_keys(lines, ["key"]), keys.singleton_rows(lines, ["key"])):
        plan = partitions.plan_text(found, "simple")
        assert "partial_count" in plan and shuffles(plan) == 1


def test_summary_counts_a_hot_product_before_the_join(spark):
    valid = spark.range(100).select(
        F.lit("ES").alias("market"), F.lit("P1").alias("product_id"),
        F.lit(2).alias("line_amount"), F.lit(1).alias("quantity"),
    )
    history = spark.createDataFrame(
        [("ES", "P1", "a", "b", "2026-01-01 00:00:00")],
        "market string, product_id string, product_name string, category string, updated_at_raw string",
    )
    summary = order_quality.market_summary(valid, order_quality.resolve_catalogue(history))
    text = summary._jdf.queryExecution().optimizedPlan().toString()
    below_join = text[text.index("Join") :]
    assert "Aggregate [market" in below_join
    assert [tuple(r) for r in summary.collect()] == [("ES", "ENRICHED", 100, 200, 100)]


def test_a_hot_key_is_split_over_several_join_tasks(spark):
    """With the thresholds scaled down to the test data, the join is split."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        lines = spark.range(0, 40000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("key"), "id"
        )
        catalogue = spark.range(500).select(
            F.col("id").alias("key"), F.lit(1).alias("candidate_rows"), F.lit("n").alias("name")
        )
        found = enrich_with_status(lines, catalogue, ["key"], ["name"])
        assert found.count() == 40000
        found.write.format("noop").mode("overwrite").save()
        found.collect()
        assert "skew=true" in partitions.plan_text(found, "simple")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_partition_control(spark, lines):
    assert partitions.partition_count(partitions.spread(lines, 3)) == 3
    merged = partitions.merge_down(partitions.spread(lines, 6), 2)
    assert partitions.partition_count(merged) == 2
    assert "Exchange RoundRobinPartitioning(3)" in partitions.plan_text(partitions.spread(lines, 3), "simple")
    assert "Coalesce" in partitions.plan_text(merged, "simple")
    sizes = [r["row_count"] for r in partitions.rows_per_partition(partitions.spread(lines, 4)).collect()]
    assert len(sizes) == 4 and sum(sizes) == 2000 and max(sizes) - min(sizes) < 100


def test_a_task_gets_a_bounded_part_of_a_shuffle_or_of_files(spark):
    from ledgerloom.session import MOST_BYTES, configure

    kept = {name: spark.conf.get(name) for name in MOST_BYTES}
    try:
        for given, expected in (("64MB", None), ("4m", 4 * 1024 * 1024)):
            for name in MOST_BYTES:
                spark.conf.set(name, given)
            configure(spark)
            assert all(int(spark.conf.get(n).rstrip("b")) == (expected or most) for n, most in MOST_BYTES.items())
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
