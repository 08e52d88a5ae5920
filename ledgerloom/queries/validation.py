"""Raw dates and timestamps: status, error codes, valid rows, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.quality import reconcile_split, split_on_errors
from ledgerloom.plans import order_quality
from ledgerloom.queries.registry import Tables, as_source, as_types, money, query

# Orders with raw times: some missing, some in another notation, some impossible.
RAW_ORDERS = """
    SELECT o_orderkey AS order_id, o_orderpriority,
           CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
           CASE WHEN o_orderpriority = '5-LOW' THEN
                     CASE WHEN o_orderstatus <> 'F' THEN NULL ELSE 'tomorrow' END
                WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O'
                     THEN strftime(o_orderdate, '%d/%m/%Y')
                WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'
                     THEN strftime(o_orderdate, '%Y') || '-02-30'
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date_raw,
           CASE WHEN o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '5-LOW')
                     THEN 'not_a_timestamp'
                WHEN o_orderstatus = 'P' AND o_orderpriority IN ('2-HIGH', '5-LOW') THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 09:15:00' END AS updated_at_raw
    FROM orders"""


def _raw_orders(t: Tables) -> DataFrame:
    date, status, priority = (F.col(f"o_order{c}") for c in ("date", "status", "priority"))
    iso = F.date_format(date, "yyyy-MM-dd")
    rows = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        "o_orderpriority",
        money("o_totalprice").alias("amount"),
        F.when(priority == "5-LOW", F.when(status == "F", "tomorrow"))
        .when((priority == "4-NOT SPECIFIED") & (status == "O"), F.date_format(date, "dd/MM/yyyy"))
        .when(
            (priority == "3-MEDIUM") & (status == "F"),
            F.concat(F.date_format(date, "yyyy"), F.lit("-02-30")),
        )
        .otherwise(iso)
        .alias("order_date_raw"),
        F.when((status == "O") & priority.isin("1-URGENT", "5-LOW"), "not_a_timestamp")
        .when((status == "P") & priority.isin("2-HIGH", "5-LOW"), F.lit(None))
        .otherwise(F.concat(iso, F.lit(" 09:15:00")))
        .alias("updated_at_raw"),
    )
    return as_source(rows)


_SHAPE = "'[0-9]{4}-[0-9]{2}-[0-9]{2}'"

_PARSED = f"""
    SELECT *, CASE WHEN regexp_full_match(order_date_raw, {_SHAPE})
                   THEN TRY_CAST(order_date_raw AS DATE) END AS order_date,
           try_strptime(updated_at_raw, '%Y-%m-%d %H:%M:%S') AS updated_at
    FROM ({RAW_ORDERS})"""

_WITH_ERRORS = f"""
    SELECT *, concat_ws(',',
        CASE WHEN order_date_raw IS NULL THEN 'MISSING_ORDER_DATE' END,
        CASE WHEN NOT regexp_full_match(order_date_raw, {_SHAPE}) THEN 'INVALID_DATE_FORMAT' END,
        CASE WHEN order_date IS NULL AND regexp_full_match(order_date_raw, {_SHAPE})
             THEN 'INVALID_DATE_VALUE' END,
        CASE WHEN updated_at_raw IS NULL THEN 'MISSING_UPDATED_AT' END,
        CASE WHEN updated_at IS NULL AND updated_at_raw IS NOT NULL THEN 'INVALID_TIMESTAMP' END
    ) AS errors
    FROM ({_PARSED})"""


@query(f"""
    SELECT order_id, CASE
        WHEN order_date_raw IS NULL THEN 'MISSING_ORDER_DATE'
        WHEN NOT regexp_full_match(order_date_raw, {_SHAPE}) THEN 'INVALID_DATE_FORMAT'
        WHEN order_date IS NULL THEN 'INVALID_DATE_VALUE'
        WHEN updated_at IS NULL THEN 'INVALID_TIMESTAMP' ELSE 'VALID' END AS validation_status
    FROM ({_PARSED})""")
def validation_status(t: Tables) -> DataFrame:
    return order_quality.with_status(_raw_orders(t)).select("order_id", "validation_status")


def _codes(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", F.array_join("validation_errors", ","))


@query(f"SELECT order_id, order_date, errors FROM ({_WITH_ERRORS})")
def validation_errors(t: Tables) -> DataFrame:
    checked = _codes(order_quality.with_errors(_raw_orders(t)))
    return checked.select("order_id", "order_date", "errors")


@query(f"""
    SELECT order_id, order_date, CAST(updated_at AS TIMESTAMP) AS updated_at,
           CAST(amount AS DOUBLE) AS amount
    FROM ({_WITH_ERRORS}) WHERE errors = ''""")
def valid_rows(t: Tables) -> DataFrame:
    valid, _ = split_on_errors(order_quality.with_errors(_raw_orders(t)), "validation_errors")
    chosen = valid.select("order_id", "order_date", "updated_at", "amount")
    return as_types(chosen, updated_at="timestamp_ntz", amount="double")


@query(f"""
    SELECT order_id, order_date_raw, updated_at_raw, CAST(amount AS DOUBLE) AS amount, errors
    FROM ({_WITH_ERRORS}) WHERE errors <> ''""")
def quarantine_rows(t: Tables) -> DataFrame:
    _, bad = split_on_errors(order_quality.with_errors(_raw_orders(t)), "validation_errors")
    columns = ["order_id", "order_date_raw", "updated_at_raw", "amount", "errors"]
    return as_types(_codes(bad).select(*columns), amount="double")


@query(f"""
    SELECT COUNT(*) AS source_rows, COUNT(*) FILTER (errors = '') AS valid_rows,
           COUNT(*) FILTER (errors <> '') AS quarantine_rows,
           CAST(SUM(amount) AS DOUBLE) AS source_amount,
           CAST(SUM(amount) FILTER (errors = '') AS DOUBLE) AS valid_amount,
           CAST(SUM(amount) FILTER (errors <> '') AS DOUBLE) AS quarantine_amount
    FROM ({_WITH_ERRORS})""", name="reconcile_split")
def reconciled(t: Tables) -> DataFrame:
    checked = order_quality.with_errors(_raw_orders(t))
    report = reconcile_split(checked, F.size("validation_errors") == 0, ["amount"])
    return as_types(
        report, source_amount="double", valid_amount="double", quarantine_amount="double"
    )
