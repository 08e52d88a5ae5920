"""The five reports over the star schema.

Facts are totalled per surrogate key before a dimension is joined, so the joins
see one row per key, however many sales a key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.windows import running_sum


def _revenue_by(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(F.sum("net_revenue").alias("revenue"))


def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = _revenue_by(fact, "date_key").join(dim_date, "date_key")
    return (
        per_day.groupBy("month", "month_name", "year")
        .agg(F.sum("revenue").alias("monthly_revenue"))
        .orderBy("year", "month")
    )


def revenue_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = _revenue_by(fact, "product_key").join(dim_product, "product_key")
    return (
        per_product.groupBy("category")
        .agg(F.sum("revenue").alias("revenue_by_category"))
        .orderBy("category")
    )


def top_products_by_store(
    fact: DataFrame, dim_product: DataFrame, dim_store: DataFrame, top: int = 3
) -> DataFrame:
    """Best products of each store; equal revenues are ordered by product."""
    product = ["product_name", "category", "brand"]
    totals = (
        _revenue_by(fact, "product_key", "store_key")
        .join(dim_product, "product_key")
        .join(dim_store, "store_key")
        .groupBy(*product, "store_name", "store_city")
        .agg(F.sum("revenue").alias("revenue_product_store"))
    )
    best = Window.partitionBy("store_name").orderBy(
        F.desc("revenue_product_store"), *product, "store_city"
    )
    return (
        totals.withColumn("position", F.row_number().over(best))
        .filter(F.col("position") <= top)
        .orderBy("store_name", "position")
    )


def daily_store_revenue(fact: DataFrame, dim_store: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per store and day: at most one row per store and calendar day."""
    return (
        _revenue_by(fact, "store_key", "date_key")
        .join(dim_store, "store_key")
        .join(dim_date, "date_key")
        .groupBy("store_name", "full_date")
        .agg(F.sum("revenue").alias("daily_revenue"))
    )


def daily_change(daily: DataFrame) -> DataFrame:
    """Each day beside the store's previous day with sales."""
    previous = F.lag("daily_revenue").over(
        Window.partitionBy("store_name").orderBy("full_date")
    )
    return (
        daily.withColumn("previous_day_revenue", previous)
        .withColumn("revenue_change", F.col("daily_revenue") - F.col("previous_day_revenue"))
        .orderBy("store_name", "full_date")
    )


def accumulated_revenue(daily: DataFrame) -> DataFrame:
    """Running revenue of each store, day by day."""
    running = running_sum(
        daily, ["store_name"], ["full_date"], "daily_revenue", "accumulated_revenue"
    )
    return running.orderBy("store_name", "full_date")
