"""Dimensions with dense surrogate keys, the sales fact, and the model checks."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import calendar_attributes, date_key
from ledgerloom.operators.joins import join_many_to_one
from ledgerloom.operators.keys import require_unique
from ledgerloom.operators.quality import Rule, long_form, require_no_violations, violation_counts

FACT_COLUMNS = [
    "order_id",
    "date_key",
    "customer_key",
    "store_key",
    "product_key",
    "quantity",
    "unit_price",
    "discount_amount",
    "gross_revenue",
    "net_revenue",
]
# dimension -> (surrogate key, business key)
DIMENSION_KEYS = {
    "dim_customer": ("customer_key", "customer_id"),
    "dim_product": ("product_key", "product_id"),
    "dim_store": ("store_key", "store_id"),
    "dim_date": ("date_key", "full_date"),
}
MEASURES = FACT_COLUMNS[5:]

# Rows that one task numbers, about, and the greatest number of ranges.
_RANGE_ROWS = 1_000_000
_MOST_RANGES = 512


def _range_bounds(df: DataFrame, key: str, rows: int) -> list:
    """Keys that cut the table into ranges of about equal size: a few values, drawn once.

    They come from the keys with the smallest hashes, so the draw is repeatable.
    """
    ranges = min(_MOST_RANGES, rows // _RANGE_ROWS + 1)
    if ranges == 1:
        return []
    drawn = df.select(key).orderBy(F.xxhash64(key), key).limit(16 * ranges)
    keys = [r[0] for r in drawn.orderBy(key).collect()]
    return [keys[i * len(keys) // ranges] for i in range(1, ranges)]


def dense_key(df: DataFrame, order_by: str, name: str, what: str) -> DataFrame:
    """Number the rows 1..n in the order of a unique key, without one big task.

    The bounds of the ranges are literals, so the numbering comes out the same
    however often it is computed. Each range is numbered on its own and raised by
    the rows of the ranges before it: one row per range, hence the broadcast.
    """
    # One job counts the keys and the rows.
    counted = df.groupBy(order_by).agg(F.count("*").alias("_rows"))
    rows, most = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.max("_rows")).first()
    if rows and most > 1:
        require_unique(df, [order_by], what)  # names such a key
    bounds = _range_bounds(df, order_by, rows)
    at_most = F.array(*[F.lit(b) for b in bounds]) if bounds else None
    place = F.size(F.filter(at_most, lambda b: b <= F.col(order_by))) if bounds else F.lit(0)
    placed = df.withColumn("_range", place)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.row_number().over(Window.partitionBy("_range").orderBy(order_by))
    keyed = placed.withColumn("_position", position).join(F.broadcast(offsets), "_range")
    return keyed.select((F.col("_offset") + F.col("_position")).alias(name), *df.columns)


def build_dimension(
    df: DataFrame, business_key: str, attributes: Sequence[str], key_name: str
) -> DataFrame:
    """Entity dimension: surrogate key, business key, attributes.

    Keys run densely in business-key order. A repeated business key is an error.
    """
    entity = df.select(business_key, *attributes)
    return dense_key(entity, business_key, key_name, f"dimension keyed by {business_key}")


def build_date_dimension(sales: DataFrame, date: str = "order_date") -> DataFrame:
    """One row per date that occurs. A null date is an error when it is read."""
    day = F.col("full_date")
    observed = sales.select(F.col(date).cast("date").alias("full_date")).distinct()
    key = F.when(day.isNotNull(), date_key(day)).otherwise(
        F.raise_error(F.lit(f"null {date} in the date dimension")).cast("int")
    )
    return observed.select(
        key.alias("date_key"),
        "full_date",
        *[c.alias(name) for name, c in calendar_attributes(day).items()],
    )


def add_revenue(df: DataFrame) -> DataFrame:
    """Add gross and net revenue if their inputs are all there."""
    if not {"quantity", "unit_price", "discount_amount"} <= set(df.columns):
        return df
    gross = F.col("quantity") * F.col("unit_price")
    return df.withColumns(
        {"gross_revenue": gross, "net_revenue": gross - F.col("discount_amount")}
    )


def build_fact(
    sales: DataFrame, dims: dict[str, DataFrame], unique: Collection[str] = ()
) -> DataFrame:
    """Replace the business keys of ``sales`` by surrogate keys.

    Every lookup refuses a dimension with repeated business keys, so the row
    count cannot change; keys that are not found come out null for the model
    checks. With only some dimensions given, only their keys are looked up.
    ``unique`` names dimensions whose keys need no count, as those that ``build_dimension`` and
    ``build_date_dimension`` have just made.
    """
    fact = sales.withColumnRenamed("order_date", "full_date")
    found = set(sales.columns)
    for dim, (surrogate, business) in DIMENSION_KEYS.items():
        if dim in dims:
            lookup = dims[dim].select(business, surrogate)
            if dim in unique:
                fact = fact.join(lookup, on=[business], how="left")
            else:
                fact = join_many_to_one(fact, lookup, [business], dim)
            found.add(surrogate)
    return fact.select(*[c for c in FACT_COLUMNS if c in found])


def fact_rules() -> list[Rule]:
    """Row-level rules of the fact table. Rules over null values do not fail."""
    c = F.col

    def any_of(conditions):
        return reduce(lambda a, b: a | b, conditions)

    surrogates = [surrogate for surrogate, _ in DIMENSION_KEYS.values()]
    return [
        Rule("fact_keys_not_null", any_of([c(k).isNull() for k in surrogates])),
        Rule("fact_measures_not_null", any_of([c(m).isNull() for m in MEASURES])),
        Rule("fact_quantity_positive", c("quantity") <= 0),
        Rule("fact_amounts_not_negative", any_of([c(m) < 0 for m in MEASURES[1:]])),
        Rule("fact_gross_consistent", c("gross_revenue") != c("quantity") * c("unit_price")),
        Rule(
            "fact_net_consistent",
            c("net_revenue") != c("gross_revenue") - c("discount_amount"),
        ),
        Rule("fact_order_id_not_null", c("order_id").isNull()),
    ]


def _fact_checks(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Row rules, repeated grains, and keys without a dimension row.

    The rows of each key are counted before its dimension is joined, and null keys
    are left out of it, so neither a hot key nor the rows whose key was not found
    meet in one task.
    """
    grains = fact.groupBy("order_id", "product_key").agg(F.count("*").alias("_rows"))
    repeated = F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("fact_grain_unique")
    checks = [violation_counts(fact, fact_rules()), long_form(grains.agg(repeated), "rule", "violations")]
    for dim, (key, _) in DIMENSION_KEYS.items():
        held = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
        unknown = held.join(dims[dim].select(key), key, "left_anti")
        missing = F.coalesce(F.sum("_rows"), F.lit(0)).alias(f"fact_{key}_in_{dim}")
        checks.append(long_form(unknown.agg(missing), "rule", "violations"))
    return reduce(DataFrame.unionByName, checks)


def _dimension_checks(dim: str, table: DataFrame) -> DataFrame:
    """Repeated and null values of both keys of a dimension."""

    def check(key: str) -> DataFrame:
        counted = table.groupBy(key).agg(F.count("*").alias("_rows"))
        missing = F.col(key).isNull()
        extra = F.sum(F.when(~missing, F.col("_rows") - 1))
        nulls = F.sum(F.when(missing, F.col("_rows")))
        found = counted.agg(
            F.coalesce(extra, F.lit(0)).alias(f"{dim}_{key}_unique"),
            F.coalesce(nulls, F.lit(0)).alias(f"{dim}_{key}_not_null"),
        )
        return long_form(found, "rule", "violations")

    return reduce(DataFrame.unionByName, [check(key) for key in DIMENSION_KEYS[dim]])


def model_checks(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """All 28 checks of the star schema, as (``rule``, ``violations``).

    The fact is read once for its row rules, once for its grain and once per
    dimension with one key, each dimension three times with one column; give written tables.
    """
    checks = [_fact_checks(fact, dims)]
    checks += [_dimension_checks(dim, dims[dim]) for dim in DIMENSION_KEYS]
    return reduce(DataFrame.unionByName, checks)


def validate_model(fact: DataFrame, dims: dict[str, DataFrame]) -> None:
    """Raise with every failing check and its count; pass silently otherwise."""
    require_no_violations(model_checks(fact, dims), "star schema")
