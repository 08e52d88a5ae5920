import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dimensional as dim
from ledgerloom.operators.quality import RuleViolation
from ledgerloom.plans import star_queries, star_schema
from ledgerloom.sources.snapshots import Snapshots
from tests import fixed_values as fv


@pytest.fixture(scope="module")
def model(spark):
    import csv
    import io

    def make(text):
        lines = list(csv.reader(io.StringIO(text)))
        return spark.createDataFrame(lines[1:], ", ".join(f"{c} string" for c in lines[0]))

    sales = star_schema.typed_sales(make(fv.STAR_SALES))
    dims = star_schema.build_dimensions(make(fv.CUSTOMERS), make(fv.PRODUCTS), make(fv.STORES), sales)
    return sales, dims, dim.build_fact(sales, dims)


def test_dimensions(model, rows):
    _, dims, _ = model
    assert rows(dims["dim_store"]) == [
        (1, "S01", "Madrid Centro", "Madrid"),
        (2, "S02", "Málaga Centro", "Málaga"),
        (3, "S03", "Barcelona Norte", "Barcelona"),
    ]
    assert sorted(r[0] for r in dims["dim_customer"].select("customer_key").collect()) == list(range(1, 13))
    assert dims["dim_product"].columns == ["product_key", "product_id", "product_name", "category", "brand"]
    dates = dims["dim_date"].orderBy("date_key").collect()
    assert len(dates) == 10
    assert tuple(dates[0])[0] == 20260801
    assert tuple(dates[0])[2:] == (1, 8, "August", 3, 2026, 5, "Saturday", True)
    assert dates[2]["day_of_week_num"] == 0 and not dates[2]["is_weekend"]


def test_fact(model):
    _, _, fact = model
    assert fact.columns == dim.FACT_COLUMNS
    sums = fact.agg(
        F.count("*"), F.sum("quantity"), F.sum("gross_revenue"), F.sum("discount_amount"), F.sum("net_revenue")
    ).first()
    assert [float(v) for v in sums] == [48, 76, 1979.0, 92.0, 1887.0]
    first = fact.filter("order_id = 'O1001' AND product_key = 4").first()
    assert [first[c] for c in ("date_key", "customer_key", "store_key", "quantity")] == [20260801, 1, 1, 1]
    assert float(first["net_revenue"]) == 20.0


def test_reports(model, rows):
    _, dims, fact = model
    month = star_queries.monthly_revenue(fact, dims["dim_date"])
    assert rows(month.withColumn("monthly_revenue", F.col("monthly_revenue").cast("double"))) == [
        (8, "August", 2026, 1887.0)
    ]
    category = star_queries.revenue_by_category(fact, dims["dim_product"])
    assert [(r[0], float(r[1])) for r in category.collect()] == [
        ("Accessories", 417.0),
        ("Clothing", 703.0),
        ("Footwear", 767.0),
    ]
    top = star_queries.top_products_by_store(fact, dims["dim_product"], dims["dim_store"]).collect()
    assert [(r["store_name"], r["product_name"], float(r["revenue_product_store"])) for r in top] == [
        ("Barcelona Norte", "Casual Sneakers", 111.0),
        ("Barcelona Norte", "Training Shorts", 100.0),
        ("Barcelona Norte", "Slim Jeans", 80.0),
        ("Madrid Centro", "Casual Sneakers", 116.0),
        ("Madrid Centro", "Running Shoes", 115.0),
        ("Madrid Centro", "Classic Hoodie", 95.0),
        ("Málaga Centro", "Urban Backpack", 132.0),
        ("Málaga Centro", "Running Shoes", 130.0),
        ("Málaga Centro", "Casual Sneakers", 108.0),
    ]
    daily = star_queries.daily_store_revenue(fact, dims["dim_store"], dims["dim_date"])
    assert daily.count() == 29
    changes = star_queries.daily_change(daily).filter("store_name = 'Madrid Centro'").collect()
    assert [float(r["daily_revenue"]) for r in changes] == [40, 85, 76, 87, 55, 58, 70, 57, 65, 50]
    assert changes[0]["revenue_change"] is None
    assert [float(r["revenue_change"]) for r in changes[1:]] == [45, -9, 11, -32, 3, 12, -13, 8, -15]
    running = star_queries.accumulated_revenue(daily)
    totals = running.groupBy("store_name").agg(F.max_by("accumulated_revenue", "full_date"))
    assert {r[0]: float(r[1]) for r in totals.collect()} == {
        "Madrid Centro": 643.0,
        "Barcelona Norte": 549.0,
        "Málaga Centro": 695.0,
    }


def test_all_28_checks_pass_on_the_model(model):
    _, dims, fact = model
    checks = dim.model_checks(fact, dims).collect()
    assert len(checks) == 28 and all(r["violations"] == 0 for r in checks)
    dim.validate_model(fact, dims)


def failing(fact, dims):
    return {r[0]: r[1] for r in dim.model_checks(fact, dims).collect() if r[1]}


def test_checks_find_faults(model):
    sales, dims, fact = model
    first = (F.col("order_id") == "O1001") & (F.col("product_key") == 1)

    def damaged(column, value):
        return fact.withColumn(column, F.when(first, value).otherwise(F.col(column)))

    assert failing(damaged("quantity", F.lit(0)), dims) == {
        "fact_quantity_positive": 1,
        "fact_gross_consistent": 1,
    }
    assert failing(damaged("discount_amount", -F.lit(1)), dims) == {
        "fact_amounts_not_negative": 1,
        "fact_net_consistent": 1,
    }
    assert failing(damaged("order_id", F.lit(None)), dims) == {"fact_order_id_not_null": 1}
    assert failing(damaged("unit_price", F.lit(None)), dims) == {"fact_measures_not_null": 1}
    assert failing(damaged("customer_key", F.lit(99)), dims) == {"fact_customer_key_in_dim_customer": 1}
    assert failing(fact.union(fact.filter(first)), dims) == {"fact_grain_unique": 1}
    unknown = sales.withColumn(
        "product_id", F.when(F.col("order_id") == "O1003", "P999").otherwise(F.col("product_id"))
    )
    assert failing(dim.build_fact(unknown, dims), dims) == {"fact_keys_not_null": 1}
    stores = dims["dim_store"].union(dims["dim_store"].filter("store_key = 1"))
    twice = {**dims, "dim_store": stores}
    assert failing(fact, twice) == {"dim_store_store_key_unique": 1, "dim_store_store_id_unique": 1}
    with pytest.raises(RuleViolation, match="fact_grain_unique: 1"):
        dim.validate_model(fact.union(fact.filter(first)), dims)


def test_repeated_business_key_and_null_date_are_errors(spark, model):
    sales, dims, _ = model
    customers = spark.createDataFrame([("C1", "a"), ("C1", "b")], "customer_id string, name string")
    with pytest.raises(ValueError, match="customer_id=C1"):
        dim.build_dimension(customers, "customer_id", ["name"], "customer_key")
    undated = sales.withColumn("order_date", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="null order_date"):
        dim.build_date_dimension(undated).collect()
    twice = {**dims, "dim_store": dims["dim_store"].union(dims["dim_store"])}
    with pytest.raises(Exception, match="repeated key in dim_store"):
        dim.build_fact(sales, twice).collect()


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_dense_keys_over_many_ranges(spark, monkeypatch, kind):
    monkeypatch.setattr(dim, "_RANGE_ROWS", 300)
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 37 % 5000) + 10_000).cast(kind).alias("k"))
    keyed = dim.dense_key(df, "k", "n", "numbers")
    assert len(dim._range_bounds(df, "k", 5000)) == 16
    assert keyed.filter("n <> cast(k as bigint) - 9999").count() == 0 and keyed.count() == 5000
    # Computed again, from other tasks, the numbers are the same.
    again = dim.dense_key(df.repartition(3), "k", "n", "numbers")
    assert keyed.join(again, ["k", "n"]).count() == 5000


def test_the_model_needs_no_checkpoint(model):
    _, dims, fact = model
    for df in (fact, *dims.values(), dim.model_checks(fact, dims)):
        assert "Checkpoint" not in df._jdf.queryExecution().toString()


def test_revenue_is_added_only_with_its_inputs(spark):
    df = spark.createDataFrame([(2, 3)], "quantity int, unit_price int")
    assert dim.add_revenue(df).columns == ["quantity", "unit_price"]


def test_job_publishes_checked_tables_only(spark, tmp_path):
    sources = {}
    for name, text in (
        ("customers", fv.CUSTOMERS),
        ("products", fv.PRODUCTS),
        ("stores", fv.STORES),
        ("sales", fv.STAR_SALES),
    ):
        path = tmp_path / f"{name}.csv"
        path.write_text("﻿" + text, encoding="utf-8")
        sources[name] = str(path)
    store = Snapshots(spark, str(tmp_path / "star"))
    assert star_schema.run(spark, sources, store) == 1
    bad = tmp_path / "bad.csv"
    bad.write_text(fv.STAR_SALES + "O9999,2026-08-10,C001,S01,P999,1,5.0,0.0\n", encoding="utf-8")
    with pytest.raises(RuleViolation, match="fact_keys_not_null: 1"):
        star_schema.run(spark, {**sources, "sales": str(bad)}, store)
    assert store.version == 1


def test_checks_count_keys_before_they_look_them_up(model):
    _, dims, fact = model
    # Rows whose product was not found all have the key null, which would meet in one task of a join.
    unfound = fact.withColumn("product_key", F.when(F.col("quantity") > 1, F.col("product_key")))
    checks = dim.model_checks(unfound, dims)
    nulls = unfound.filter("product_key IS NULL").count()
    found = {r[0]: r[1] for r in checks.collect()}
    assert nulls and found["fact_keys_not_null"] == nulls
    assert found["fact_product_key_in_dim_product"] == 0
    text = dim._fact_checks(unfound.localCheckpoint(), dims)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in text and "LeftOuter" not in text
    joined = text[text.index("LeftAnti") :]
    assert "Aggregate [product_key" in joined and "isnotnull(product_key" in joined
