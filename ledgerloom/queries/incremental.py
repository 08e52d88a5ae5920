"""Batches applied to a core table, rule counts, and run states.

The core holds the newest version of each (order, line) shipped before 1999.
Standing checks, the lookup and the batch rules read all lines.
The batch is everything shipped from June 1998 on: new keys, newer and equal
versions of known ones, and keys it repeats itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.operators.versions import latest_version
from ledgerloom.queries.registry import Tables, as_types, money, query
from ledgerloom.sources.contracts import ORDER_LINES
from ledgerloom.sources.run_log import FAILED, RUN_EVENTS, RUNNING, SUCCESS, run_state

_KEY = ["order_id", "line_id"]
_VERSION = "updated_at"
_TIES = ("product_id", "quantity", "unit_price")
_CORE_UNTIL, _BATCH_FROM = "1999-01-01", "1998-06-01"

_ROWS = """
    SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
           CAST(l_shipdate AS TIMESTAMP) AS updated_at, l_returnflag AS flag
    FROM lineitem"""
_LATEST = """
    SELECT * EXCLUDE (n) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, line_id ORDER BY updated_at DESC,
            product_id DESC, quantity DESC, unit_price DESC) AS n FROM ({rows}))
    WHERE n = 1"""
_CORE = _LATEST.format(rows=f"{_ROWS} WHERE l_shipdate < TIMESTAMP '{_CORE_UNTIL}'")
_EVERY = _LATEST.format(rows=_ROWS)
_RAW_BATCH = f"{_ROWS} WHERE l_shipdate >= TIMESTAMP '{_BATCH_FROM}'"
_BATCH = _LATEST.format(rows=_RAW_BATCH)


def _shipped(t: Tables, condition) -> DataFrame:
    return t.lineitem.filter(condition).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("unit_price"),
        F.col("l_shipdate").alias("updated_at"),
        F.col("l_returnflag").alias("flag"),
    )


def _core(t: Tables) -> DataFrame:
    until = F.lit(_CORE_UNTIL).cast("timestamp_ntz")
    return latest_version(_shipped(t, F.col("l_shipdate") < until), _KEY, _VERSION, _TIES)


def _raw_batch(t: Tables) -> DataFrame:
    return _shipped(t, F.col("l_shipdate") >= F.lit(_BATCH_FROM).cast("timestamp_ntz"))


def _shown(df: DataFrame) -> DataFrame:
    chosen = df.select("order_id", "line_id", "product_id", "quantity", "unit_price", "updated_at")
    return as_types(chosen, unit_price="double")


_SHOWN = """order_id, line_id, product_id, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price, updated_at"""


@query(f"""
    SELECT {_SHOWN} FROM (SELECT * FROM ({_CORE}) UNION ALL SELECT * FROM ({_RAW_BATCH}))""")
def append_batch(t: Tables) -> DataFrame:
    return _shown(inc.append_batch(_core(t), _raw_batch(t)))


_MERGED = f"""
    SELECT COALESCE(b.order_id, c.order_id) AS order_id, COALESCE(b.line_id, c.line_id) AS line_id,
           c.order_id IS NULL OR b.updated_at > c.updated_at AS use_batch, b, c
    FROM ({_CORE}) c FULL JOIN ({_BATCH}) b
      ON b.order_id = c.order_id AND b.line_id = c.line_id"""


@query(f"""
    SELECT order_id, line_id,
           CASE WHEN use_batch THEN b.product_id ELSE c.product_id END AS product_id,
           CASE WHEN use_batch THEN b.quantity ELSE c.quantity END AS quantity,
           CAST(CASE WHEN use_batch THEN b.unit_price ELSE c.unit_price END AS DOUBLE) AS unit_price,
           CASE WHEN use_batch THEN b.updated_at ELSE c.updated_at END AS updated_at
    FROM ({_MERGED})""")
def upsert_newer_wins(t: Tables) -> DataFrame:
    return _shown(inc.upsert(_core(t), _raw_batch(t), _KEY, _VERSION, _TIES))


@query(f"""
    SELECT order_id, line_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
           updated_at
    FROM (SELECT c.* FROM ({_CORE}) c LEFT JOIN ({_BATCH}) b
            ON b.order_id = c.order_id AND b.line_id = c.line_id AND b.updated_at > c.updated_at
          WHERE b.order_id IS NULL
          UNION ALL
          SELECT b.* FROM ({_BATCH}) b LEFT JOIN ({_CORE}) c
            ON b.order_id = c.order_id AND b.line_id = c.line_id
          WHERE c.order_id IS NULL OR b.updated_at > c.updated_at)""")
def two_statement_load(t: Tables) -> DataFrame:
    """Update what is newer, insert what is new: for a batch without repeated keys."""
    core, batch = _core(t), latest_version(_raw_batch(t), _KEY, _VERSION, _TIES)
    classified = inc.classify_changes(core, batch, _KEY, _VERSION, _TIES, dedup=False)
    return _shown(inc.apply_changes(core, inc.effective_changes(classified), _KEY))


_ACTION = """CASE WHEN c.order_id IS NULL THEN 'insert'
                  WHEN b.updated_at > c.updated_at THEN 'update' ELSE 'ignore' END"""


@query(f"""
    SELECT {_ACTION} AS action, COUNT(*) AS row_count
    FROM ({_BATCH}) b LEFT JOIN ({_CORE}) c
      ON b.order_id = c.order_id AND b.line_id = c.line_id GROUP BY 1""")
def upsert_actions(t: Tables) -> DataFrame:
    classified = inc.classify_changes(_core(t), _raw_batch(t), _KEY, _VERSION, _TIES)
    return inc.change_report(classified)


@query(f"SELECT 'ignore' AS action, COUNT(*) AS row_count FROM ({_BATCH})")
def upsert_idempotent(t: Tables) -> DataFrame:
    """What applying the same batch a second time does: it ignores every row."""
    batch = _raw_batch(t)
    once = inc.upsert(_core(t), batch, _KEY, _VERSION, _TIES)
    return inc.change_report(inc.classify_changes(once, batch, _KEY, _VERSION, _TIES))


@query(f"""
    SELECT c.order_id, c.line_id, c.product_id, COALESCE(b.quantity, c.quantity) AS quantity,
           CAST(c.unit_price AS DOUBLE) AS unit_price, c.updated_at
    FROM ({_CORE}) c LEFT JOIN ({_BATCH}) b
      ON b.order_id = c.order_id AND b.line_id = c.line_id""")
def update_by_key(t: Tables) -> DataFrame:
    corrections = latest_version(_raw_batch(t), _KEY, _VERSION, _TIES)
    return _shown(inc.update_by_key(_core(t), corrections, _KEY, "quantity"))


@query(f"""
    SELECT {_SHOWN} FROM ({_CORE}) c WHERE NOT EXISTS (
        SELECT 1 FROM ({_RAW_BATCH}) b
        WHERE b.flag = 'R' AND b.order_id = c.order_id AND b.line_id = c.line_id)""")
def delete_by_key(t: Tables) -> DataFrame:
    returned = _raw_batch(t).filter("flag = 'R'")
    return _shown(inc.delete_by_key(_core(t), returned, _KEY))


@query(f"""
    WITH sought AS (SELECT order_id, line_id FROM ({_EVERY})
                    ORDER BY updated_at DESC, order_id DESC, line_id DESC LIMIT 1)
    SELECT COUNT(*) AS row_count, MAX(quantity) AS max_quantity, MAX(updated_at) AS updated_at
    FROM ({_EVERY}) JOIN sought USING (order_id, line_id)""")
def point_lookup(t: Tables) -> DataFrame:
    """The key written last, looked up among the newest versions of all lines."""
    every = _shipped(t, F.lit(True))
    last = every.agg(F.max(F.struct(_VERSION, *_KEY)).alias("last")).first()["last"]
    core = latest_version(every, _KEY, _VERSION, _TIES)
    return inc.look_up(core, {c: last[c] for c in _KEY}).agg(
        F.count("*").alias("row_count"),
        F.max("quantity").alias("max_quantity"),
        F.max("updated_at").alias("updated_at"),
    )


# A batch with faults: returned seventh lines have a negative quantity, accepted
# first lines of cheap goods no price, and open third lines no date.
@query(f"""
    WITH faulty AS (
        SELECT CASE WHEN flag = 'R' AND line_id = 7 THEN -quantity ELSE quantity END AS quantity,
               CASE WHEN NOT (flag = 'A' AND line_id = 1 AND unit_price < 20000)
                    THEN unit_price END AS unit_price,
               CASE WHEN NOT (flag = 'N' AND line_id = 3) THEN updated_at END AS updated_at,
               order_id, line_id, product_id
        FROM ({_ROWS}))
    SELECT 'quantity_positive' AS rule, COUNT(*) FILTER (quantity <= 0) AS violations FROM faulty
    UNION ALL SELECT 'unit_price_not_negative', COUNT(*) FILTER (unit_price < 0) FROM faulty
    UNION ALL SELECT 'order_id_not_null', COUNT(*) FILTER (order_id IS NULL) FROM faulty
    UNION ALL SELECT 'line_id_not_null', COUNT(*) FILTER (line_id IS NULL) FROM faulty
    UNION ALL SELECT 'order_date_not_null', COUNT(*) FILTER (updated_at IS NULL) FROM faulty
    UNION ALL SELECT 'product_id_not_null', COUNT(*) FILTER (product_id IS NULL) FROM faulty
    UNION ALL SELECT 'quantity_not_null', COUNT(*) FILTER (quantity IS NULL) FROM faulty
    UNION ALL SELECT 'unit_price_not_null', COUNT(*) FILTER (unit_price IS NULL) FROM faulty
    UNION ALL SELECT 'updated_at_not_null', COUNT(*) FILTER (updated_at IS NULL) FROM faulty
    UNION ALL SELECT c || '_length', 0 FROM (VALUES ('order_id'), ('customer_id'), ('product_id')) v(c)
    UNION ALL SELECT c || '_readable', 0 FROM (VALUES ('order_id'), ('line_id'), ('order_date'),
        ('customer_id'), ('product_id'), ('quantity'), ('unit_price'), ('updated_at')) v(c)""")
def batch_violations(t: Tables) -> DataFrame:
    flag, line = F.col("flag"), F.col("line_id")
    negative = (flag == "R") & (line == 7)
    unpriced = (flag == "A") & (line == 1) & (F.col("unit_price") < 20000)
    undated = (flag == "N") & (line == 3)
    faulty = _shipped(t, F.lit(True)).withColumns(
        {
            "quantity": F.when(negative, -F.col("quantity")).otherwise(F.col("quantity")),
            "unit_price": F.when(~unpriced, F.col("unit_price")),
            "updated_at": F.when(~undated, F.col("updated_at")),
        }
    )
    texts = faulty.select(
        "order_id", "line_id", "product_id", "quantity", "unit_price", "updated_at"
    ).withColumns({"order_date": F.to_date("updated_at"), "customer_id": F.lit("C1")})
    raw = texts.select(*[F.col(c).cast("string") for c in texts.columns])
    return ORDER_LINES.batch_violations(ORDER_LINES.typed(raw))


_LINES = f"""
    SELECT CAST(order_id AS VARCHAR) AS order_id, line_id, CAST(updated_at AS DATE) AS order_date,
           CAST(product_id AS VARCHAR) AS product_id, quantity,
           CASE WHEN quantity > 45 THEN -unit_price ELSE unit_price END AS unit_price, updated_at
    FROM ({_ROWS})"""


@query(f"""
    SELECT 'quantity_positive' AS rule, COUNT(*) FILTER (quantity <= 0) AS violations FROM ({_LINES})
    UNION ALL SELECT 'unit_price_not_negative', COUNT(*) FILTER (unit_price < 0) FROM ({_LINES})
    UNION ALL SELECT 'key_unique', COUNT(*) FROM (
        SELECT 1 FROM ({_LINES}) GROUP BY order_id, line_id HAVING COUNT(*) > 1)
    UNION ALL SELECT c || '_not_null', 0 FROM (VALUES ('order_id'), ('line_id'), ('order_date'),
        ('product_id'), ('quantity'), ('unit_price'), ('updated_at')) v(c)
    UNION ALL SELECT c || '_length', 0 FROM (VALUES ('order_id'), ('customer_id'), ('product_id')) v(c)""")
def rule_violation_counts(t: Tables) -> DataFrame:
    """The contract's standing checks over all lines, repeated keys included; bulk lines carry a credit."""
    price = F.col("unit_price")
    lines = _shipped(t, F.lit(True)).select(
        F.col("order_id").cast("string").alias("order_id"),
        "line_id",
        F.to_date("updated_at").alias("order_date"),
        F.lit("C1").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        "quantity",
        F.when(F.col("quantity") > 45, -price).otherwise(price).alias("unit_price"),
        "updated_at",
    )
    return ORDER_LINES.table_violations(lines)


@query(f"""
    SELECT user_id AS run_id, ts AS event_at,
           CASE event_type WHEN 'error' THEN '{FAILED}' WHEN 'purchase' THEN '{SUCCESS}'
                ELSE '{RUNNING}' END AS status
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
          FROM events)
    WHERE n = 1""", name="run_state")
def newest_run_state(t: Tables) -> DataFrame:
    """User events read as run events: a run is as its newest event says."""
    kind = F.col("event_type")
    status = F.when(kind == "error", FAILED).when(kind == "purchase", SUCCESS).otherwise(RUNNING)
    events = t.events.select(
        F.col("user_id").alias("run_id"),
        F.col("ts").alias("event_at"),
        status.alias("status"),
        "event_id",
    )
    return run_state(events, version="event_at", ties=["event_id"]).drop("event_id")


@query(f"""
    WITH log AS (
        SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS started_at,
               CASE WHEN event_type IN ('error', 'purchase', 'view') THEN ts END AS finished_at,
               CASE event_type WHEN 'error' THEN '{FAILED}' WHEN 'purchase' THEN '{SUCCESS}'
                    WHEN 'signup' THEN NULL WHEN 'click' THEN '{RUNNING}'
                    ELSE 'a status that is far too long' END AS status
        FROM events)
    SELECT 'status_known' AS rule, COUNT(*) FILTER (status NOT IN ('{RUNNING}', '{SUCCESS}', '{FAILED}'))
               AS violations FROM log
    UNION ALL SELECT 'finished_if_closed',
        COUNT(*) FILTER ((status = '{RUNNING}') <> (finished_at IS NULL)) FROM log
    UNION ALL SELECT 'status_not_null', COUNT(*) FILTER (status IS NULL) FROM log
    UNION ALL SELECT 'status_length', COUNT(*) FILTER (length(status) > 20) FROM log
    UNION ALL SELECT 'run_id_not_null', COUNT(*) FILTER (run_id IS NULL) FROM log
    UNION ALL SELECT 'started_at_not_null', COUNT(*) FILTER (started_at IS NULL) FROM log
    UNION ALL SELECT 'key_unique', COUNT(*) FROM (SELECT 1 FROM log GROUP BY run_id HAVING COUNT(*) > 1)
    UNION ALL SELECT r, 0 FROM (VALUES ('event_number_not_null'), ('rows_not_negative')) v(r)""")
def run_log_violations(t: Tables) -> DataFrame:
    """User events read as a run log with faults: unknown and missing states, and open runs that are finished."""
    kind = F.col("event_type")
    status = F.when(kind == "error", FAILED).when(kind == "purchase", SUCCESS).when(kind == "click", RUNNING)
    log = t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.lit(1).alias("event_number"),
        F.col("ts").alias("started_at"),
        F.when(kind.isin("error", "purchase", "view"), F.col("ts")).alias("finished_at"),
        status.when(kind != "signup", "a status that is far too long").alias("status"),
        F.lit(0).cast("long").alias("staged_rows"),
        F.lit(0).cast("long").alias("affected_rows"),
    )
    return RUN_EVENTS.table_violations(log)
