"""Cleaning of dirty sales lines, the report on what was dropped, the summary.

A line is dropped by the first rule it fails, in this order: country missing,
quantity or price not a number, quantity not positive, price not positive, date
unreadable. Of exact copies, compared before any text is trimmed, one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import parse_mixed_date
from ledgerloom.functions.text import (
    capitalize_first,
    decimal_point,
    finite,
    strip_text,
    to_number,
    to_whole,
)
from ledgerloom.operators.keys import drop_marked_copies, row_marks
from ledgerloom.operators.quality import Rule, attrition_report, first_failure, require_columns
from ledgerloom.sources.csv import read_csv, write_csv

REQUIRED = (
    "order_id",
    "customer_id",
    "order_date",
    "product",
    "category",
    "quantity",
    "unit_price",
    "country",
)
TEXT_COLUMNS = ("customer_id", "product", "category", "country")

# Revenue is added up as an exact decimal, and what rounding to it leaves of each amount beside it, so the
# sum does not depend on order. A group with an amount beyond its range is added up as DOUBLE instead.
_MONEY, _REST = "decimal(24,6)", "decimal(20,20)"


def read_values(df: DataFrame, iso_day_first: bool = False) -> DataFrame:
    """Add each line's values, parsed once: ``_quantity``, ``_whole``, ``_price``, ``_amount``, ``_date``.

    A value that is missing, no number, or too large for its type is null. Dates cost most to read, and
    their rule is the last: ``_date`` is null too where a line fails an earlier one.
    """
    quantity, price = to_number(F.col("quantity")), to_number(decimal_point(F.col("unit_price")))
    numbers = df.withColumns({"_quantity": quantity, "_price": price})
    numbers = numbers.withColumn("_whole", to_whole(F.col("_quantity"))).withColumn(
        "_amount", finite(F.col("_whole") * F.col("_price"))
    )
    reached = first_failure(cleaning_rules()[:-1], "kept") == "kept"
    date = F.when(reached, parse_mixed_date(F.col("order_date"), iso_day_first))
    # Generated rows keep the optimizer from repeating the expressions in later steps.
    values = F.struct("_quantity", "_whole", "_price", "_amount", date.alias("_date"))
    return numbers.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array(values)))


def cleaning_rules() -> list[Rule]:
    """Conditions over the raw and the parsed columns, in the order they take effect."""
    c = F.col
    return [
        Rule("missing_country", c("country").isNull()),
        Rule("invalid_number", c("_whole").isNull() | c("_price").isNull() | c("_amount").isNull()),
        Rule("non_positive_quantity", c("_quantity") <= 0),
        Rule("non_positive_price", c("_price") <= 0),
        Rule("invalid_date", c("_date").isNull()),
    ]


def clean_sales(raw: DataFrame, iso_day_first: bool = False) -> DataFrame:
    """Clean, typed lines with ``total_amount``; other columns pass through."""
    require_columns(raw, REQUIRED)
    # Copies agree in every rule, so rows are read and filtered first; what is marked and
    # shuffled to find them are the rows that stay, with short values and marks instead of texts.
    read = read_values(raw, iso_day_first)
    good = read.filter(first_failure(cleaning_rules(), "kept") == "kept").withColumns(row_marks(raw))
    texts = {c: strip_text(F.col(c)) for c in TEXT_COLUMNS}
    for column in ("country", "category"):
        texts[column] = capitalize_first(texts[column])
    values = {
        **texts,
        "quantity": F.col("_whole"),
        "unit_price": F.col("_price"),
        "order_date": F.col("_date"),
    }
    lines = good.select(
        *[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in raw.columns],
        "_mark_a",
        "_mark_b",
        "_mark_check",
    )
    return drop_marked_copies(lines).withColumn("total_amount", F.col("quantity") * F.col("unit_price"))


def cleaning_report(raw: DataFrame, iso_day_first: bool = False) -> DataFrame:
    """Rows removed per step, and rows kept, from one pass over the raw lines."""
    require_columns(raw, REQUIRED)
    return attrition_report(
        raw, cleaning_rules(), read=lambda distinct: read_values(distinct, iso_day_first)
    )


def sales_summary(clean: DataFrame) -> DataFrame:
    """Orders, units and revenue per country and category, best revenue first.

    Lines without a country or category belong to no group.
    """
    by = ["country", "category"]
    exact = F.col("total_amount").try_cast(_MONEY)
    rest = (F.col("total_amount") - exact.cast("double")).try_cast(_REST)
    # Lines of one order are folded first, so orders are counted, not collected.
    per_order = clean.dropna(subset=by).groupBy(*by, "order_id").agg(
        F.sum("quantity").alias("_units"),
        F.try_sum(exact).alias("_exact"),
        F.sum(rest).alias("_rest"),
        F.sum("total_amount").alias("_rough"),
        F.count_if(exact.isNull()).alias("_beyond"),
    )
    total = F.try_sum("_exact").cast("double") + F.sum("_rest").cast("double")
    revenue = F.when(F.sum("_beyond") == 0, total)
    return (
        per_order.groupBy(*by)
        .agg(
            F.count("order_id").alias("number_of_orders"),
            F.sum("_units").alias("units_sold"),
            F.coalesce(revenue, F.sum("_rough")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), *by)
    )


def run(spark: SparkSession, source: str, clean_target: str, summary_target: str) -> None:
    clean = clean_sales(read_csv(spark, source))
    write_csv(clean, clean_target)
    written = spark.read.schema(clean.schema).option("header", True).csv(clean_target)
    write_csv(sales_summary(written), summary_target)
