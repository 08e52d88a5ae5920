"""Version histories, and order lines against a versioned catalogue.

Line items serve as a version history: several rows share an (order, line) key
and the ship date tells which is newest. For the order-quality job, deliveries
up to the end of 1996 form the catalogue history of (market, product), with
monthly versions, and later deliveries are the order lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import versions
from ledgerloom.operators.windows import (
    changed,
    previous_values,
    ranked,
    running_sum,
    time_slices,
)
from ledgerloom.plans import order_quality
from ledgerloom.queries.registry import Tables, as_source, as_types, money, query

# --- line items as versions -------------------------------------------------------

_KEY = ["order_id", "line_id"]

_VERSIONS = """
    SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS product_id,
           l_suppkey AS store_id, CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
           CAST(l_shipdate AS DATE) AS updated_at
    FROM lineitem"""
_TIES = ("product_id", "store_id", "quantity", "unit_price")


def _versions(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("unit_price"),
        F.col("l_shipdate").cast("date").alias("updated_at"),
    )


def _shown(df: DataFrame) -> DataFrame:
    return as_types(df, unit_price="double")


_SHOWN = """order_id, line_id, product_id, store_id, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price, updated_at"""

_NEWEST = f"""
    SELECT *, COUNT(*) OVER (PARTITION BY order_id, line_id) AS candidate_rows
    FROM (SELECT *, MAX(updated_at) OVER (PARTITION BY order_id, line_id) AS newest
          FROM ({_VERSIONS}))
    WHERE updated_at = newest"""


@query(f"""
    SELECT {_SHOWN} FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, line_id
            ORDER BY updated_at DESC, product_id DESC, store_id DESC, quantity DESC,
                     unit_price DESC) AS n
        FROM ({_VERSIONS})) WHERE n = 1""")
def latest_version(t: Tables) -> DataFrame:
    return _shown(versions.latest_version(_versions(t), _KEY, "updated_at", _TIES))


@query(f"SELECT {_SHOWN} FROM ({_NEWEST})")
def latest_candidates(t: Tables) -> DataFrame:
    return _shown(versions.latest_candidates(_versions(t), _KEY, "updated_at"))


@query(f"""
    SELECT order_id, line_id, COUNT(*) AS candidate_rows FROM ({_NEWEST})
    GROUP BY order_id, line_id HAVING COUNT(*) > 1""")
def ambiguous_keys(t: Tables) -> DataFrame:
    resolved = versions.resolve_versions(_versions(t), _KEY, "updated_at")
    return versions.ambiguous_keys(resolved, _KEY)


@query(f"SELECT {_SHOWN} FROM ({_NEWEST}) WHERE candidate_rows = 1")
def catalog_current(t: Tables) -> DataFrame:
    resolved = versions.resolve_versions(_versions(t), _KEY, "updated_at")
    return _shown(versions.current_rows(resolved))


@query(f"SELECT {_SHOWN} FROM ({_NEWEST}) WHERE candidate_rows > 1")
def catalog_quarantine(t: Tables) -> DataFrame:
    history = _versions(t)
    resolved = versions.resolve_versions(history, _KEY, "updated_at")
    return _shown(versions.ambiguous_rows(history, resolved, _KEY, "updated_at"))


# --- windows over events -----------------------------------------------------------

# A busy user's events are cut by hour, of which a user has a bounded number.
_HOURS = time_slices("HOUR")


@query("""
    SELECT event_id, user_id,
           ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day DESC, ts, event_id)
               AS row_number,
           RANK() OVER (PARTITION BY user_id ORDER BY day DESC) AS rank,
           DENSE_RANK() OVER (PARTITION BY user_id ORDER BY day DESC) AS dense_rank
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)""")
def rank_functions(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    rows = ranked(events, ["user_id"], ["day"], ["ts", "event_id"], _HOURS[0])
    return as_types(
        rows.select("event_id", "user_id", "row_number", "rank", "dense_rank"),
        row_number="bigint",
        rank="bigint",
        dense_rank="bigint",
    )


@query("""
    SELECT event_id, user_id, event_type, previous_event_type,
           COALESCE(event_type <> previous_event_type, false) AS event_type_changed,
           COALESCE(value <> previous_value, false) AS value_changed
    FROM (SELECT *, LAG(event_type) OVER w AS previous_event_type,
                 LAG(value) OVER w AS previous_value
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def change_flags(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    rows = previous_values(
        events, ["user_id"], ["ts", "event_id"], ["event_type", "value"], _HOURS
    )
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        "previous_event_type",
        changed(F.col("event_type"), F.col("previous_event_type")).alias("event_type_changed"),
        changed(F.col("value"), F.col("previous_value")).alias("value_changed"),
    )


@query("""
    SELECT event_id, user_id, CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER (
               PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_value
    FROM events""")
def running_value(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "ts", money("value").alias("value"))
    rows = running_sum(
        events, ["user_id"], ["ts", "event_id"], "value", "running_value", _HOURS
    )
    return as_types(rows.select("event_id", "user_id", "running_value"), running_value="double")


# --- order lines against the catalogue ---------------------------------------------

_CUT = "1997-01-01"

_HISTORY = f"""
    SELECT l_returnflag || l_linestatus AS market, l_partkey AS product_id,
           p_name || ' v' || CAST(l_linenumber AS VARCHAR) AS product_name, p_type AS category,
           CASE WHEN l_linenumber = 7 AND CAST(l_discount AS DECIMAL(4,2)) = 0.10 THEN 'unknown'
                ELSE strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') || ' 10:00:00' END
               AS updated_at_raw
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE l_shipdate < TIMESTAMP '{_CUT}'"""

_LINES = f"""
    SELECT order_id, line_id, market, product_id, quantity, line_amount,
           CASE WHEN line_id = 7 THEN NULL
                WHEN line_id = 6 AND market LIKE '%O' THEN strftime(shipped, '%d/%m/%Y')
                WHEN tax = 0.08 THEN strftime(shipped, '%Y') || '-02-30'
                ELSE strftime(shipped, '%Y-%m-%d') END AS order_date_raw,
           CASE WHEN discount = 0.10 THEN 'not_a_timestamp' WHEN discount = 0.09 THEN NULL
                ELSE strftime(shipped, '%Y-%m-%d') || ' 09:15:00' END AS updated_at_raw
    FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_id,
                 l_returnflag || l_linestatus AS market, l_partkey AS product_id,
                 CAST(l_quantity AS INTEGER) AS quantity,
                 CAST(l_extendedprice AS DECIMAL(12,2)) AS line_amount,
                 CAST(l_discount AS DECIMAL(4,2)) AS discount,
                 CAST(l_tax AS DECIMAL(4,2)) AS tax, l_shipdate AS shipped,
                 ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                     ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                              l_extendedprice DESC) AS n
          FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_CUT}')
    WHERE n = 1"""


def _cut():
    return F.lit(_CUT).cast("timestamp_ntz")


def _market():
    return F.concat("l_returnflag", "l_linestatus")


def _history(t: Tables) -> DataFrame:
    old = t.lineitem.filter(F.col("l_shipdate") < _cut())
    month = F.concat(F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd"), F.lit(" 10:00:00"))
    unknown = (F.col("l_linenumber") == 7) & (F.col("l_discount").cast("decimal(4,2)") == 0.10)
    joined = old.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    rows = joined.select(
        _market().alias("market"),
        F.col("l_partkey").alias("product_id"),
        F.concat("p_name", F.lit(" v"), F.col("l_linenumber").cast("string")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(unknown, "unknown").otherwise(month).alias("updated_at_raw"),
    )
    return as_source(rows)


def _order_lines(t: Tables) -> DataFrame:
    newest = versions.latest_version(
        t.lineitem.filter(F.col("l_shipdate") >= _cut()),
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        ["l_partkey", "l_suppkey", "l_extendedprice"],
    )
    shipped, line = F.col("l_shipdate"), F.col("l_linenumber")
    discount = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    iso = F.date_format(shipped, "yyyy-MM-dd")
    rows = newest.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        _market().alias("market"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("line_amount"),
        F.when(line == 7, F.lit(None))
        .when((line == 6) & (F.col("l_linestatus") == "O"), F.date_format(shipped, "dd/MM/yyyy"))
        .when(tax == 0.08, F.concat(F.date_format(shipped, "yyyy"), F.lit("-02-30")))
        .otherwise(iso)
        .alias("order_date_raw"),
        F.when(discount == 0.10, "not_a_timestamp")
        .when(discount == 0.09, F.lit(None))
        .otherwise(F.concat(iso, F.lit(" 09:15:00")))
        .alias("updated_at_raw"),
    )
    return as_source(rows)


def _job(t: Tables) -> order_quality.OrderQuality:
    return order_quality.order_quality(_order_lines(t), _history(t))


_VALID = f"""
    SELECT * FROM ({_LINES})
    WHERE regexp_full_match(order_date_raw, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
      AND TRY_CAST(order_date_raw AS DATE) IS NOT NULL
      AND try_strptime(updated_at_raw, '%Y-%m-%d %H:%M:%S') IS NOT NULL"""

_RESOLVED = f"""
    SELECT market, product_id, COUNT(*) AS candidates, MIN(product_name) AS product_name,
           MIN(category) AS category
    FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY market, product_id
                     ORDER BY try_strptime(updated_at_raw, '%Y-%m-%d %H:%M:%S')
                     DESC NULLS LAST) AS recency
          FROM ({_HISTORY}))
    WHERE recency = 1 GROUP BY market, product_id"""

_CLASSIFIED = f"""
    SELECT v.*, CASE WHEN candidates = 1 THEN product_name END AS product_name,
           CASE WHEN candidates = 1 THEN category END AS category,
           CASE WHEN candidates > 1 THEN 'CATALOG_DUPLICATE' WHEN candidates = 1 THEN 'ENRICHED'
                ELSE 'CATALOG_MISSING' END AS enrichment_status
    FROM ({_VALID}) v LEFT JOIN ({_RESOLVED}) USING (market, product_id)"""


@query(f"""
    SELECT order_id, line_id, market, product_id, product_name, category, enrichment_status
    FROM ({_CLASSIFIED})""")
def enrichment_status(t: Tables) -> DataFrame:
    return _job(t).classified.select(
        "order_id",
        "line_id",
        "market",
        "product_id",
        "product_name",
        "category",
        "enrichment_status",
    )


@query(f"""
    SELECT market, enrichment_status, COUNT(*) AS row_count,
           CAST(SUM(line_amount) AS DOUBLE) AS total_amount,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity
    FROM ({_CLASSIFIED}) GROUP BY market, enrichment_status""")
def market_quality_summary(t: Tables) -> DataFrame:
    return as_types(_job(t).summary, total_amount="double")


@query(f"""
    WITH v AS ({_VALID}), s AS ({_CLASSIFIED})
    SELECT 'rows' AS measure, (SELECT CAST(COUNT(*) AS DOUBLE) FROM v) AS left_total,
           (SELECT CAST(COUNT(*) AS DOUBLE) FROM s) AS right_total
    UNION ALL SELECT 'amount', (SELECT CAST(SUM(line_amount) AS DOUBLE) FROM v),
           (SELECT CAST(SUM(line_amount) AS DOUBLE) FROM s)
    UNION ALL SELECT 'quantity', (SELECT CAST(SUM(quantity) AS DOUBLE) FROM v),
           (SELECT CAST(SUM(quantity) AS DOUBLE) FROM s)""")
def reconcile_summary(t: Tables) -> DataFrame:
    job = _job(t)
    return order_quality.compare_summary(job.valid, job.summary).drop("equal")


@query(f"""
    SELECT order_id, line_id FROM ({_VALID})
    WHERE (market, product_id) NOT IN (SELECT (market, product_id) FROM ({_RESOLVED}))""")
def missing_lines(t: Tables) -> DataFrame:
    """Lines an inner join with the catalogue would lose."""
    job = _job(t)
    kept = job.classified.filter("enrichment_status <> 'CATALOG_MISSING'")
    return order_quality.missing_lines(job.valid, kept).select("order_id", "line_id")
