"""Star schema: dimensions and fact from raw tables, checked before publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.dimensional import (
    add_revenue,
    build_date_dimension,
    build_dimension,
    build_fact,
    validate_model,
)
from ledgerloom.sources.csv import read_csv
from ledgerloom.sources.snapshots import Snapshots

# dimension -> (business key, attributes, surrogate key)
ENTITIES = {
    "dim_customer": ("customer_id", ["customer_name", "city", "country"], "customer_key"),
    "dim_product": ("product_id", ["product_name", "category", "brand"], "product_key"),
    "dim_store": ("store_id", ["store_name", "store_city"], "store_key"),
}
SALES_TYPES = {
    "order_date": "date",
    "quantity": "int",
    "unit_price": "decimal(10,2)",
    "discount_amount": "decimal(10,2)",
}


def typed_sales(raw: DataFrame) -> DataFrame:
    """Cast the sales columns that are there, strictly, and add the revenues."""
    present = {c: F.col(c).cast(t) for c, t in SALES_TYPES.items() if c in raw.columns}
    return add_revenue(raw.withColumns(present))


def build_dimensions(
    customers: DataFrame, products: DataFrame, stores: DataFrame, sales: DataFrame
) -> dict[str, DataFrame]:
    raw = {"dim_customer": customers, "dim_product": products, "dim_store": stores}
    dims = {name: build_dimension(raw[name], *spec) for name, spec in ENTITIES.items()}
    return {**dims, "dim_date": build_date_dimension(sales)}


def run(spark: SparkSession, sources: dict[str, str], store: Snapshots) -> int:
    """Read four CSV sources, write the five tables, check them, publish them.

    The checks run on the tables as written, so what is published is what was
    checked, and a failed check leaves the published model as it was.
    """
    base = store.version
    raw = {name: read_csv(spark, path, on_empty="pass") for name, path in sources.items()}
    sales = typed_sales(raw["sales"])
    folders, written = {}, {}
    dims = build_dimensions(raw["customers"], raw["products"], raw["stores"], sales)
    for name, dim in dims.items():
        folders[name], written[name] = store.write(name, dim)
    folders["fact_sales"], fact = store.write("fact_sales", build_fact(sales, written, unique=dims))
    validate_model(fact, written)
    return store.publish(folders, base)
