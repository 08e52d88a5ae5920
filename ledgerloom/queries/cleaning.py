"""Text, number and date clean-up, and the sales cleaning job, on dirty text.

The tables are clean, so dirt is put in by conditions on natural columns, the
same way on the Spark and the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import parse_mixed_date
from ledgerloom.functions.text import (
    capitalize_first,
    decimal_point,
    strip_text,
    to_number,
    to_whole,
)
from ledgerloom.plans import sales_cleaning
from ledgerloom.queries.registry import Tables, as_source, query

# --- single functions ----------------------------------------------------------

_DIRTY_PARTS = """
    SELECT p_partkey,
           CASE WHEN p_size <= 10 THEN '  ' || p_name || ' '
                WHEN p_size <= 20 THEN chr(9) || upper(p_name) || chr(10)
                WHEN p_size <= 30 THEN lower(p_type) || ' ' || upper(p_name)
                WHEN p_size <= 40 THEN '   ' ELSE p_name END AS raw_text
    FROM part"""


def _dirty_parts(t: Tables) -> DataFrame:
    name, size = F.col("p_name"), F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.when(size <= 10, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(size <= 20, F.concat(F.lit("\t"), F.upper(name), F.lit("\n")))
        .when(size <= 30, F.concat(F.lower("p_type"), F.lit(" "), F.upper(name)))
        .when(size <= 40, F.lit("   "))
        .otherwise(name)
        .alias("raw_text"),
    )


@query(rf"""
    SELECT p_partkey, stripped,
           upper(substr(stripped, 1, 1)) || lower(substr(stripped, 2)) AS capitalized
    FROM (SELECT p_partkey, regexp_replace(raw_text, '^\s+|\s+$', '', 'g') AS stripped
          FROM ({_DIRTY_PARTS}))""")
def clean_text(t: Tables) -> DataFrame:
    stripped = strip_text(F.col("raw_text"))
    return _dirty_parts(t).select(
        "p_partkey", stripped.alias("stripped"), capitalize_first(stripped).alias("capitalized")
    )


_DIRTY_NUMBERS = """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber WHEN 7 THEN 'two' WHEN 6 THEN NULL
                WHEN 5 THEN CASE WHEN l_linestatus = 'F' THEN '1e400' ELSE '1d' END
                WHEN 4 THEN CASE WHEN l_linestatus = 'F' THEN '1e30' ELSE 'nan' END WHEN 3 THEN ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.9 '
                WHEN 2 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'e1'
                ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS raw_quantity,
           CASE WHEN l_returnflag = 'A'
                THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',')
                WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'inf'
                ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS raw_price
    FROM lineitem"""


def _dirty_numbers(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast("int").cast("string")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    line, closed = F.col("l_linenumber"), F.col("l_linestatus") == "F"
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(line == 7, "two")
        .when(line == 6, F.lit(None))
        .when(line == 5, F.when(closed, "1e400").otherwise("1d"))
        .when(line == 4, F.when(closed, "1e30").otherwise("nan"))
        .when(line == 3, F.concat(F.lit(" "), quantity, F.lit(".9 ")))
        .when(line == 2, F.concat(quantity, F.lit("e1")))
        .otherwise(quantity)
        .alias("raw_quantity"),
        F.when(F.col("l_returnflag") == "A", F.replace(price, F.lit("."), F.lit(",")))
        .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "inf")
        .otherwise(price)
        .alias("raw_price"),
    )
    return as_source(rows)


# A number as the SQL side reads it: digits, point, exponent, nothing else, and finite.
def _sql_number(text: str) -> str:
    parsed = f"TRY_CAST(trim({text}) AS DOUBLE)"
    return (
        f"CASE WHEN regexp_full_match(trim({text}), "
        r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') "
        f"AND isfinite({parsed}) THEN {parsed} END"
    )


# The whole part; null beyond the range of a BIGINT.
def _sql_whole(number: str) -> str:
    return f"TRY_CAST(trunc({number}) AS BIGINT)"


@query(f"""
    SELECT l_orderkey, l_linenumber, quantity, {_sql_whole("quantity")} AS whole_quantity,
           {_sql_number("replace(raw_price, ',', '.')")} AS price
    FROM (SELECT *, {_sql_number("raw_quantity")} AS quantity FROM ({_DIRTY_NUMBERS}))""")
def parse_numbers(t: Tables) -> DataFrame:
    quantity = to_number(F.col("raw_quantity"))
    return _dirty_numbers(t).select(
        "l_orderkey",
        "l_linenumber",
        quantity.alias("quantity"),
        to_whole(quantity).alias("whole_quantity"),
        to_number(decimal_point(F.col("raw_price"))).alias("price"),
    )


# Notation of each (priority, status): as SQL and Spark write it; None stands for a constant.
_NOTATIONS = {
    ("1-URGENT", "F"): ("%Y-%m-%d", "yyyy-MM-dd"),
    ("1-URGENT", "O"): (" %Y-%m-%d ", "' 'yyyy-MM-dd' '"),
    ("1-URGENT", "P"): ("%Y-%m-%dT10:00:00Z", "yyyy-MM-dd'T10:00:00Z'"),
    ("2-HIGH", "F"): ("%Y/%m/%d", "yyyy/MM/dd"),
    ("2-HIGH", "O"): ("%d/%m/%y", "dd/MM/yy"),
    ("2-HIGH", "P"): ("%Y-%m-%d 10:00 PM", "yyyy-MM-dd' 10:00 PM'"),
    ("3-MEDIUM", "F"): ("%d-%m-%Y", "dd-MM-yyyy"),
    ("3-MEDIUM", "O"): ("%d-%b-%y", "dd-MMM-yy"),
    ("3-MEDIUM", "P"): ("%d %B %Y", "dd MMMM yyyy"),
    ("4-NOT SPECIFIED", "F"): ("%m/%d/%Y", "MM/dd/yyyy"),
    ("4-NOT SPECIFIED", "O"): ("%A, %d %B %Y", "EEEE, dd MMMM yyyy"),
    ("4-NOT SPECIFIED", "P"): ("%Y-%m", "yyyy-MM"),
    ("5-LOW", "F"): ("%Y-02-30", "yyyy'-02-30'"),
    ("5-LOW", "O"): ("%b %Y", "MMM yyyy"),
}
# Further notations by the remainder of the customer key, for orders that are not urgent.
_MORE_NOTATIONS = {
    1: ("%-dth %B %Y", "d'th 'MMMM yyyy"),
    2: ("%B %-dth, %Y", "MMMM d'th, 'yyyy"),
    3: ("%b-%-d-%y", "MMM-d-yy"),
    4: ("%Y-%b-%d", "yyyy-MMM-dd"),
    5: ("%-m/%Y", "M/yyyy"),
    6: ("%Y", "yyyy"),
    7: ("%Y%m%dT1000", "yyyyMMdd'T1000'"),
    8: ("%Y-%m-%d 10", "yyyy-MM-dd' 10'"),
    9: ("%d %b %Y 10:00 EST", "dd MMM yyyy' 10:00 EST'"),
    10: ("%a %b %-d 10:00:00 %Y", "EEE MMM d' 10:00:00 'yyyy"),
}
_NO_DATE = "not_a_date"

_DIRTY_DATES = "SELECT o_orderkey, CASE {more} {cases} ELSE '{other}' END AS raw_date FROM orders".format(
    other=_NO_DATE,
    more=" ".join(
        f"WHEN o_orderpriority <> '1-URGENT' AND o_custkey % 16 = {k} THEN strftime(o_orderdate, '{sql}')"
        for k, (sql, _) in _MORE_NOTATIONS.items()
    ),
    cases=" ".join(
        f"WHEN o_orderpriority = '{p}' AND o_orderstatus = '{s}' THEN strftime(o_orderdate, '{sql}')"
        for (p, s), (sql, _) in _NOTATIONS.items()
    ),
)


def _dirty_dates(t: Tables) -> DataFrame:
    date, priority, status = (F.col(f"o_order{c}") for c in ("date", "priority", "status"))
    raw = F.lit(_NO_DATE)
    for (p, s), (_, spark) in _NOTATIONS.items():
        raw = F.when((priority == p) & (status == s), F.date_format(date, spark)).otherwise(raw)
    for k, (_, spark) in _MORE_NOTATIONS.items():
        raw = F.when((priority != "1-URGENT") & (F.col("o_custkey") % 16 == k), F.date_format(date, spark)).otherwise(raw)
    return as_source(t.orders.select("o_orderkey", raw.alias("raw_date")))


def _sql_date(text: str, *formats: str) -> str:
    """The first notation that fits; a year of two digits would pass for one of four."""
    tries = ", ".join(f"try_strptime({text}, '{f}')" for f in formats)
    short = f"regexp_full_match({text}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}')"
    return f"CAST(CASE WHEN {short} THEN try_strptime({text}, '%d/%m/%y') ELSE COALESCE({tries}) END AS DATE)"


_DAY_FIRST = ("%d-%m-%Y", "%d/%m/%Y", "%m-%d-%Y", "%m/%d/%Y", "%d-%b-%y", "%d %B %Y")
_DAY_FIRST += ("%A, %d %B %Y", "%b %Y", "%dth %B %Y", "%B %dth, %Y", "%b-%d-%y", "%Y-%b-%d", "%m/%Y", "%Y")
_DAY_FIRST += ("%Y%m%dT%H%M", "%d %b %Y %H:%M EST", "%a %b %d %H:%M:%S %Y")
_YEAR_MONTH_DAY = ("%Y-%m-%d", "%Y/%m/%d", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %I:%M %p", "%Y-%m-%d %H", "%Y-%m")
_YEAR_DAY_MONTH = ("%Y-%d-%m", "%Y/%d/%m", "%Y-%d-%mT%H:%M:%SZ", "%Y-%d-%m %I:%M %p", "%Y-%d-%m %H")


@query(f"""
    SELECT o_orderkey, {_sql_date("trim(raw_date)", *_YEAR_MONTH_DAY, *_DAY_FIRST)} AS order_date,
           {_sql_date("trim(raw_date)", *_YEAR_DAY_MONTH, *_YEAR_MONTH_DAY, *_DAY_FIRST)}
               AS order_date_swapped
    FROM ({_DIRTY_DATES})""")
def parse_dates_mixed(t: Tables) -> DataFrame:
    raw = F.col("raw_date")
    return _dirty_dates(t).select(
        "o_orderkey",
        parse_mixed_date(raw).alias("order_date"),
        parse_mixed_date(raw, iso_day_first=True).alias("order_date_swapped"),
    )


@query("""
    SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE)
               AS order_date,
           CAST(strptime(strftime(o_orderdate, '%Y-%m-%d') || ' 10:30:00', '%Y-%m-%d %H:%M:%S')
               AS TIMESTAMP) AS updated_at
    FROM orders""")
def strict_dates(t: Tables) -> DataFrame:
    # The strict readings: one bad text fails the query.
    written = F.date_format("o_orderdate", "dd/MM/yyyy")
    stamped = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:30:00"))
    return t.orders.select(
        "o_orderkey",
        F.to_date(written, "dd/MM/yyyy").alias("order_date"),
        F.to_timestamp_ntz(stamped, F.lit("yyyy-MM-dd HH:mm:ss")).alias("updated_at"),
    )


# --- the cleaning job ------------------------------------------------------------

# Returned lines arrive twice. Every column is text.
_DIRTY_SALES_ONCE = """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
                ELSE ' ' || CAST(c_custkey AS VARCHAR) END AS customer_id,
           CASE WHEN p_type = 'PROMO' AND o_orderstatus = 'P' THEN 'not_a_date'
                WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d/%m/%y')
                ELSE strftime(o_orderdate, '%d %B %Y') END AS order_date,
           '  ' || p_name || ' ' AS product,
           CASE WHEN p_size > 45 THEN NULL WHEN l_linestatus = 'F' THEN lower(p_type)
                ELSE ' ' || p_type || ' ' END AS category,
           CASE l_linenumber WHEN 7 THEN 'two' WHEN 6 THEN '1e30' WHEN 5 THEN '-1' WHEN 4 THEN '0'
                WHEN 3 THEN '0.5' WHEN 2 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.9'
                ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
           CASE WHEN l_returnflag = 'A'
                THEN replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',')
                WHEN p_size = 1 THEN '0.00' WHEN p_size = 2 THEN 'nan' WHEN p_size = 3 THEN '1e400'
                WHEN p_size = 4 THEN NULL
                ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
           CASE o_orderpriority WHEN '1-URGENT' THEN ' ' || lower(n_name) || ' '
                WHEN '3-MEDIUM' THEN chr(9) || n_name WHEN '5-LOW' THEN NULL
                WHEN '4-NOT SPECIFIED' THEN '  ' ELSE n_name END AS country,
           l_returnflag
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey"""

_SALES_COLUMNS = "order_id, customer_id, order_date, product, category, quantity, unit_price, country"

_DIRTY_SALES = f"""
    SELECT {_SALES_COLUMNS} FROM ({_DIRTY_SALES_ONCE})
    UNION ALL
    SELECT {_SALES_COLUMNS} FROM ({_DIRTY_SALES_ONCE}) WHERE l_returnflag = 'R'"""


def _dirty_sales(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    lines = lines.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    lines = lines.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    lines = lines.join(t.part, F.col("p_partkey") == F.col("l_partkey"))

    date, status, priority = (F.col(f"o_order{c}") for c in ("date", "status", "priority"))
    line, size = F.col("l_linenumber"), F.col("p_size")
    whole = F.col("l_quantity").cast("int").cast("string")
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    segment, returned = F.col("c_mktsegment"), F.col("l_returnflag")
    text = F.lit
    once = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(segment != "FURNITURE", F.concat(text(" "), F.col("c_custkey").cast("string")))
        .alias("customer_id"),
        F.when((F.col("p_type") == "PROMO") & (status == "P"), "not_a_date")
        .when(status == "F", F.date_format(date, "yyyy-MM-dd"))
        .when(status == "O", F.date_format(date, "dd/MM/yy"))
        .otherwise(F.date_format(date, "dd MMMM yyyy"))
        .alias("order_date"),
        F.concat(text("  "), "p_name", text(" ")).alias("product"),
        F.when(size > 45, F.lit(None))
        .when(F.col("l_linestatus") == "F", F.lower("p_type"))
        .otherwise(F.concat(text(" "), "p_type", text(" ")))
        .alias("category"),
        F.when(line == 7, "two")
        .when(line == 6, "1e30")
        .when(line == 5, "-1")
        .when(line == 4, "0")
        .when(line == 3, "0.5")
        .when(line == 2, F.concat(whole, text(".9")))
        .otherwise(whole)
        .alias("quantity"),
        F.when(returned == "A", F.replace(price, text("."), text(",")))
        .when(size == 1, "0.00")
        .when(size == 2, "nan")
        .when(size == 3, "1e400")
        .when(size == 4, F.lit(None))
        .otherwise(price)
        .alias("unit_price"),
        F.when(priority == "1-URGENT", F.concat(text(" "), F.lower("n_name"), text(" ")))
        .when(priority == "3-MEDIUM", F.concat(text("\t"), "n_name"))
        .when(priority == "5-LOW", F.lit(None))
        .when(priority == "4-NOT SPECIFIED", "  ")
        .otherwise(F.col("n_name"))
        .alias("country"),
        "l_returnflag",
    )
    # The second delivery is made on each row: the joins run once.
    line = F.struct(*sales_cleaning.REQUIRED)
    deliveries = F.when(returned == "R", F.array(line, line)).otherwise(F.array(line))
    return once.select(F.inline(deliveries))


def _sql_strip(column: str) -> str:
    return rf"regexp_replace({column}, '^\s+|\s+$', '', 'g')"


def _sql_capital(column: str) -> str:
    bare = _sql_strip(column)
    return f"upper(substr({bare}, 1, 1)) || lower(substr({bare}, 2))"


_READ_SALES = f"""
    SELECT *, {_sql_number("quantity")} AS q,
           {_sql_number("replace(unit_price, ',', '.')")} AS p,
           {_sql_date("order_date", *_YEAR_MONTH_DAY, *_DAY_FIRST)} AS d"""

_CLEAN_SALES = f"""
    SELECT order_id, {_sql_strip("customer_id")} AS customer_id, d AS order_date,
           {_sql_strip("product")} AS product, {_sql_capital("category")} AS category,
           {_sql_whole("q")} AS quantity, p AS unit_price,
           {_sql_capital("country")} AS country, {_sql_whole("q")} * p AS total_amount
    FROM ({_READ_SALES} FROM (SELECT DISTINCT * FROM ({_DIRTY_SALES})))
    WHERE country IS NOT NULL AND q > 0 AND p > 0 AND d IS NOT NULL AND {_sql_whole("q")} IS NOT NULL"""


@query(_CLEAN_SALES, name="sales_cleaning")
def cleaned(t: Tables) -> DataFrame:
    return sales_cleaning.clean_sales(_dirty_sales(t))


@query(f"""
    WITH copies AS (SELECT *, COUNT(*) AS n FROM ({_DIRTY_SALES}) GROUP BY ALL),
    steps AS (
        SELECT CASE WHEN country IS NULL THEN 'missing_country'
                    WHEN {_sql_whole("q")} IS NULL OR p IS NULL THEN 'invalid_number'
                    WHEN q <= 0 THEN 'non_positive_quantity'
                    WHEN p <= 0 THEN 'non_positive_price'
                    WHEN d IS NULL THEN 'invalid_date' ELSE 'kept' END AS step
        FROM ({_READ_SALES} FROM copies))
    SELECT step, COUNT(*) AS row_count FROM steps GROUP BY step
    UNION ALL SELECT 'exact_duplicate', CAST(SUM(n - 1) AS BIGINT) FROM copies""")
def attrition_report(t: Tables) -> DataFrame:
    return sales_cleaning.cleaning_report(_dirty_sales(t))


@query(f"""
    SELECT country, category, COUNT(DISTINCT order_id) AS number_of_orders,
           CAST(SUM(quantity) AS BIGINT) AS units_sold,
           CAST(SUM(CAST(total_amount AS DECIMAL(24,6))) AS DOUBLE)
               + CAST(SUM(CAST(total_amount - CAST(CAST(total_amount AS DECIMAL(24,6)) AS DOUBLE)
                               AS DECIMAL(38,20))) AS DOUBLE) AS total_revenue
    FROM ({_CLEAN_SALES}) WHERE category IS NOT NULL GROUP BY country, category
    ORDER BY total_revenue DESC, country, category""")
def sales_summary(t: Tables) -> DataFrame:
    return sales_cleaning.sales_summary(sales_cleaning.clean_sales(_dirty_sales(t)))
