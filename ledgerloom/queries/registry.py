"""Named queries, each with the SQL that must give the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFunction = Callable[["Tables"], DataFrame]


class Tables:
    """The Parquet tables of one folder as attributes, each opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        setattr(self, name, table)
        return table


QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query, under its function name by default, with its SQL twin."""

    def register(function: QueryFunction) -> QueryFunction:
        QUERIES[name or function.__name__] = function
        ORACLES[name or function.__name__] = sql
        return function

    return register


def money(column: str) -> Column:
    """A stored DOUBLE amount as exact cents."""
    return F.col(column).cast("decimal(12,2)")


def as_types(df: DataFrame, **types: str) -> DataFrame:
    """Cast result columns, so both engines report the same types."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def as_source(df: DataFrame) -> DataFrame:
    """Columns as a source would hold them: made once per row.

    Expressions that stand in for raw text would otherwise be repeated inside
    every later expression that reads that text.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
