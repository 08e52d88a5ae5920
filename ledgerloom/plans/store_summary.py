"""Store summary: keep sales with a quantity and a known product, total per store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import join_many_to_one, orphans, with_partner
from ledgerloom.operators.quality import compare_totals, require_totals_equal
from ledgerloom.sources.parquet import write_and_read


def split_null_quantity(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sales with a quantity, and sales without; a gap is never filled in."""
    return sales.filter("quantity IS NOT NULL"), sales.filter("quantity IS NULL")


def unknown_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    return orphans(split_null_quantity(sales)[0], products, ["product_id"])


def valid_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    return with_partner(split_null_quantity(sales)[0], products, ["product_id"])


def enriched_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Valid sales with their revenue and product columns."""
    revenue = F.col("quantity") * F.col("unit_price")
    valid = valid_sales(sales, products).withColumn("total_revenue", revenue)
    return join_many_to_one(valid, products, ["product_id"], "products")


def summarize(sales: DataFrame, by: list[str]) -> DataFrame:
    """Row count, quantity and revenue per group."""
    return sales.groupBy(*by).agg(
        F.count("*").alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_revenue").alias("total_revenue"),
    )


def run(spark: SparkSession, sales: DataFrame, products: DataFrame, target: str) -> DataFrame:
    """Write the summary, read it back, and compare it with the valid sales."""
    summary = write_and_read(summarize(enriched_sales(sales, products), ["store_id"]), target)
    one = F.lit(1)
    require_totals_equal(
        compare_totals(
            valid_sales(sales, products),
            {"rows": one, "quantity": F.col("quantity")},
            summary,
            {"rows": F.col("total_orders"), "quantity": F.col("total_quantity")},
        )
    )
    return summary
