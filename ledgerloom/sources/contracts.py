"""Table contracts: columns with types, key, and rules a batch must keep."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.keys import duplicate_keys
from ledgerloom.operators.quality import (
    Rule,
    long_form,
    require_columns,
    require_no_violations,
    violation_counts,
)

_RAW = "_raw_"


@dataclass(frozen=True)
class TableContract:
    """What a table promises.

    ``checks`` maps a name to a SQL condition every row must meet; like a SQL
    CHECK, a condition that is null counts as met. ``max_lengths`` limits text.
    ``buckets`` is the number of buckets of the key that a stored table is cut into; it stays
    the same as long as the table lives.
    """

    name: str
    schema: T.StructType
    key: Sequence[str]
    required: Sequence[str]
    checks: dict[str, str]
    max_lengths: dict[str, int]
    buckets: int = 8

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def typed(self, raw: DataFrame) -> DataFrame:
        """Cast text columns to the contract's types; the raw text stays beside
        them, so that ``batch_rules`` can tell unreadable from missing."""
        require_columns(raw, self.columns)
        return raw.select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in self.schema],
            *[F.col(c).alias(_RAW + c) for c in self.columns],
        )

    def rules(self) -> list[Rule]:
        """Not-null, length and value rules of a typed table."""
        rules = [Rule(f"{c}_not_null", F.col(c).isNull()) for c in self.required]
        rules += [
            Rule(f"{c}_length", F.length(c) > longest) for c, longest in self.max_lengths.items()
        ]
        return rules + [Rule(name, ~F.expr(check)) for name, check in self.checks.items()]

    def batch_rules(self) -> list[Rule]:
        """The rules of a table, and: text that does not read as its type."""
        unreadable = [
            Rule(f"{c}_readable", F.col(c).isNull() & F.col(_RAW + c).isNotNull())
            for c in self.columns
        ]
        return unreadable + self.rules()

    def batch_violations(self, typed: DataFrame) -> DataFrame:
        return violation_counts(typed, self.batch_rules())

    def table_violations(self, table: DataFrame) -> DataFrame:
        """Rule counts of a standing table, repeated keys included."""
        repeated = duplicate_keys(table, self.key).agg(F.count("*").alias("key_unique"))
        return violation_counts(table, self.rules()).unionByName(
            long_form(repeated, "rule", "violations")
        )

    def require_batch(self, typed: DataFrame) -> DataFrame:
        """Reject the whole batch on any violation; else its contract columns."""
        require_no_violations(self.batch_violations(typed), f"batch for {self.name}")
        return typed.select(*self.columns)

    def require_table(self, table: DataFrame) -> None:
        require_no_violations(self.table_violations(table), self.name)


ORDER_LINES = TableContract(
    name="core orders",
    schema=T.StructType(
        [
            T.StructField("order_id", T.StringType()),
            T.StructField("line_id", T.IntegerType()),
            T.StructField("order_date", T.DateType()),
            T.StructField("customer_id", T.StringType()),
            T.StructField("product_id", T.StringType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("unit_price", T.DecimalType(10, 2)),
            T.StructField("updated_at", T.TimestampNTZType()),
        ]
    ),
    key=("order_id", "line_id"),
    required=(
        "order_id",
        "line_id",
        "order_date",
        "product_id",
        "quantity",
        "unit_price",
        "updated_at",
    ),
    checks={"quantity_positive": "quantity > 0", "unit_price_not_negative": "unit_price >= 0"},
    max_lengths={"order_id": 20, "customer_id": 20, "product_id": 20},
)
