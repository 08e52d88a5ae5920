"""The star schema built from the order tables, its checks and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dimensional import (
    DIMENSION_KEYS,
    add_revenue,
    build_date_dimension,
    build_dimension,
    build_fact,
    model_checks,
)
from ledgerloom.operators.versions import latest_version
from ledgerloom.plans import star_queries, star_schema
from ledgerloom.queries.registry import Tables, as_types, money, query
from ledgerloom.sources.scratch import written

# --- raw tables ----------------------------------------------------------------

# A fact row is one product of one order; repeated lines keep the newest.
_SALES = """
    SELECT order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
           store_id, product_id, quantity, unit_price,
           CAST(quantity * unit_price * discount AS DECIMAL(18,2)) AS discount_amount,
           quantity * unit_price AS gross,
           quantity * unit_price
               - CAST(quantity * unit_price * discount AS DECIMAL(18,2)) AS net
    FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS store_id,
                 CAST(l_quantity AS INTEGER) AS quantity,
                 CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
                 CAST(l_discount AS DECIMAL(4,2)) AS discount, {position} AS n
          FROM lineitem)
    JOIN orders ON o_orderkey = order_id WHERE n = 1"""
_NEWEST = """ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_partkey
                     ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC,
                              l_extendedprice DESC)"""
_GRAIN_SALES = _SALES.format(position=_NEWEST)
_ALL_SALES = _SALES.format(position="1")


def _sales(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    if lines is None:
        ties = ["l_linenumber", "l_suppkey", "l_extendedprice"]
        lines = latest_version(t.lineitem, ["l_orderkey", "l_partkey"], "l_shipdate", ties)
    quantity, price = F.col("l_quantity").cast("int"), money("l_extendedprice")
    discount = quantity * price * F.col("l_discount").cast("decimal(4,2)")
    rows = lines.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        discount.cast("decimal(18,2)").alias("discount_amount"),
    )
    return add_revenue(rows)


def _customers(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
    )


def _products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
    )


def _stores(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("store_city"),
    )


_SOURCES = {"dim_customer": _customers, "dim_product": _products, "dim_store": _stores}


def _dimension(t: Tables, name: str) -> DataFrame:
    return build_dimension(_SOURCES[name](t), *star_schema.ENTITIES[name])


def _dates(t: Tables) -> DataFrame:
    """Dates of all sales: of the orders that have a line."""
    sold = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return build_date_dimension(sold, "o_orderdate")


def _dimensions(t: Tables, *names: str) -> dict[str, DataFrame]:
    """The dimensions as written tables, as the job has them when it builds the fact."""
    names = names or tuple(DIMENSION_KEYS)
    dims = {name: _dates(t) if name == "dim_date" else _dimension(t, name) for name in names}
    return {name: written(dim, name) for name, dim in dims.items()}


def _model(t: Tables, *names: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact with its dimensions; a report names the ones it uses."""
    dims = _dimensions(t, *names)
    return build_fact(_sales(t), dims, unique=dims), dims


# --- dimensions and fact ---------------------------------------------------------


@query("""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key,
           c_custkey AS customer_id, c_name AS customer_name, n_name AS city, r_name AS country
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def dim_customer(t: Tables) -> DataFrame:
    return _dimension(t, "dim_customer")


@query("""
    SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) AS product_key, p_partkey AS product_id,
           p_name AS product_name, p_type AS category, p_brand AS brand
    FROM part""")
def dim_product(t: Tables) -> DataFrame:
    return _dimension(t, "dim_product")


@query("""
    SELECT ROW_NUMBER() OVER (ORDER BY s_suppkey) AS store_key, s_suppkey AS store_id,
           s_name AS store_name, n_name AS store_city
    FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def dim_store(t: Tables) -> DataFrame:
    return _dimension(t, "dim_store")


@query("""
    SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
           CAST(day(full_date) AS INTEGER) AS day, CAST(month(full_date) AS INTEGER) AS month,
           monthname(full_date) AS month_name, CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(year(full_date) AS INTEGER) AS year,
           CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week_num,
           dayname(full_date) AS day_of_week_name, isodow(full_date) >= 6 AS is_weekend
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""")
def dim_date(t: Tables) -> DataFrame:
    return _dates(t)


_FACT = f"""
    SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
           c.key AS customer_key, s.key AS store_key, p.key AS product_key, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price,
           CAST(discount_amount AS DOUBLE) AS discount_amount,
           CAST(gross AS DOUBLE) AS gross_revenue, CAST(net AS DOUBLE) AS net_revenue
    FROM ({_GRAIN_SALES}) f
    JOIN (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS key FROM customer) c
      ON c_custkey = customer_id
    JOIN (SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS key FROM supplier) s
      ON s_suppkey = store_id
    JOIN (SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS key FROM part) p
      ON p_partkey = product_id"""


@query(_FACT)
def fact_sales(t: Tables) -> DataFrame:
    fact, _ = _model(t)
    return as_types(
        fact,
        unit_price="double",
        discount_amount="double",
        gross_revenue="double",
        net_revenue="double",
    )


# --- model checks -----------------------------------------------------------------

_DIMENSION_SQL = {
    "dim_customer": "SELECT c_custkey + 1 AS customer_key, c_custkey AS customer_id FROM customer",
    "dim_product": "SELECT p_partkey + 1 AS product_key, p_partkey AS product_id FROM part {listed}",
    "dim_store": "SELECT s_suppkey + 1 AS store_key, s_suppkey AS store_id FROM supplier",
    "dim_date": """SELECT DISTINCT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
                   order_date AS full_date FROM sales""",
}


def _checks_sql(sales: str, listed: str = "", damage: str = "") -> str:
    """The 28 counts, over sales whose surrogate keys are looked up plainly."""
    fact_checks = {
        "fact_keys_not_null": "customer_key IS NULL OR product_key IS NULL "
        "OR store_key IS NULL OR date_key IS NULL",
        "fact_measures_not_null": "quantity IS NULL OR unit_price IS NULL "
        "OR discount_amount IS NULL OR gross IS NULL OR net IS NULL",
        "fact_quantity_positive": "quantity <= 0",
        "fact_amounts_not_negative": "unit_price < 0 OR discount_amount < 0 OR gross < 0 OR net < 0",
        "fact_gross_consistent": "gross <> quantity * unit_price",
        "fact_net_consistent": "net <> gross - discount_amount",
        "fact_order_id_not_null": "order_id IS NULL",
    }
    ctes = [f"sales AS ({sales})"]
    counts = [
        f"SELECT '{name}' AS rule, COUNT(*) FILTER ({fails}) AS violations FROM fact"
        for name, fails in fact_checks.items()
    ]
    counts.append(
        "SELECT 'fact_grain_unique', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM "
        "(SELECT COUNT(*) AS n FROM fact GROUP BY order_id, product_key)"
    )
    for dim, (surrogate, business) in DIMENSION_KEYS.items():
        ctes.append(f"{dim} AS ({_DIMENSION_SQL[dim].format(listed=listed)})")
        counts.append(
            f"SELECT 'fact_{surrogate}_in_{dim}', COUNT(*) FROM fact f WHERE {surrogate} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{surrogate} = f.{surrogate})"
        )
        for key in (surrogate, business):
            counts.append(
                f"SELECT '{dim}_{key}_unique', COUNT({key}) - COUNT(DISTINCT {key}) FROM {dim}"
            )
            counts.append(
                f"SELECT '{dim}_{key}_not_null', COUNT(*) FILTER ({key} IS NULL) FROM {dim}"
            )
    ctes.append(
        "fact AS (SELECT sales.*, customer_key, product_key, store_key, date_key FROM sales "
        "LEFT JOIN dim_customer USING (customer_id) LEFT JOIN dim_product USING (product_id) "
        "LEFT JOIN dim_store USING (store_id) LEFT JOIN dim_date ON full_date = order_date)"
    )
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(counts)}"


@query(_checks_sql(_GRAIN_SALES))
def star_model_checks(t: Tables) -> DataFrame:
    fact, dims = _model(t)
    return model_checks(written(fact, "fact_sales"), dims)


# A candidate model with faults: repeated grain, products that left the list,
# returned lines booked with a negative quantity.
_FAULTY_SALES = f"""
    SELECT * REPLACE (CASE WHEN unit_price < 2000 THEN -quantity ELSE quantity END AS quantity)
    FROM ({_ALL_SALES})"""


@query(_checks_sql(_FAULTY_SALES, listed="WHERE p_size <= 40"))
def star_model_faults(t: Tables) -> DataFrame:
    sales = _sales(t, t.lineitem)
    cheap = F.col("unit_price") < 2000
    faulty = sales.withColumn(
        "quantity", F.when(cheap, -F.col("quantity")).otherwise(F.col("quantity"))
    )
    dims = _dimensions(t)
    dims["dim_product"] = dims["dim_product"].join(
        t.part.filter("p_size <= 40").select(F.col("p_partkey").alias("product_id")),
        "product_id",
        "left_semi",
    )
    # Keys of the shortened dimension are still unique.
    return model_checks(written(build_fact(faulty, dims, unique=dims), "fact_sales"), dims)


# --- reports ------------------------------------------------------------------------


@query(f"""
    SELECT CAST(month(order_date) AS INTEGER) AS month, monthname(order_date) AS month_name,
           CAST(year(order_date) AS INTEGER) AS year,
           CAST(SUM(net) AS DOUBLE) AS monthly_revenue
    FROM ({_GRAIN_SALES}) GROUP BY 1, 2, 3 ORDER BY year, month""")
def monthly_revenue(t: Tables) -> DataFrame:
    fact, dims = _model(t, "dim_date")
    return as_types(
        star_queries.monthly_revenue(fact, dims["dim_date"]), monthly_revenue="double"
    )


@query(f"""
    SELECT p_type AS category, CAST(SUM(net) AS DOUBLE) AS revenue_by_category
    FROM ({_GRAIN_SALES}) JOIN part ON p_partkey = product_id GROUP BY p_type ORDER BY p_type""")
def revenue_by_category(t: Tables) -> DataFrame:
    fact, dims = _model(t, "dim_product")
    report = star_queries.revenue_by_category(fact, dims["dim_product"])
    return as_types(report, revenue_by_category="double")


@query(f"""
    WITH totals AS (
        SELECT p_name AS product_name, p_type AS category, p_brand AS brand,
               s_name AS store_name, n_name AS store_city, SUM(net) AS revenue
        FROM ({_GRAIN_SALES}) JOIN part ON p_partkey = product_id
        JOIN supplier ON s_suppkey = store_id JOIN nation ON n_nationkey = s_nationkey
        GROUP BY ALL),
    placed AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY store_name
            ORDER BY revenue DESC, product_name, category, brand, store_city) AS position
        FROM totals)
    SELECT product_name, category, brand, store_name, store_city,
           CAST(revenue AS DOUBLE) AS revenue_product_store, position
    FROM placed WHERE position <= 3 ORDER BY store_name, position""")
def top3_per_group(t: Tables) -> DataFrame:
    fact, dims = _model(t, "dim_product", "dim_store")
    best = star_queries.top_products_by_store(fact, dims["dim_product"], dims["dim_store"])
    return as_types(best, revenue_product_store="double", position="bigint")


_DAILY = f"""
    SELECT s_name AS store_name, order_date AS full_date, SUM(net) AS daily
    FROM ({_GRAIN_SALES}) JOIN supplier ON s_suppkey = store_id GROUP BY s_name, order_date"""


def _daily(t: Tables) -> DataFrame:
    fact, dims = _model(t, "dim_store", "dim_date")
    return star_queries.daily_store_revenue(fact, dims["dim_store"], dims["dim_date"])


@query(f"""
    SELECT store_name, full_date, CAST(daily AS DOUBLE) AS daily_revenue,
           CAST(LAG(daily) OVER w AS DOUBLE) AS previous_day_revenue,
           CAST(daily - LAG(daily) OVER w AS DOUBLE) AS revenue_change
    FROM ({_DAILY}) WINDOW w AS (PARTITION BY store_name ORDER BY full_date)
    ORDER BY store_name, full_date""")
def daily_change(t: Tables) -> DataFrame:
    return as_types(
        star_queries.daily_change(_daily(t)),
        daily_revenue="double",
        previous_day_revenue="double",
        revenue_change="double",
    )


@query(f"""
    SELECT store_name, full_date, CAST(daily AS DOUBLE) AS daily_revenue,
           CAST(SUM(daily) OVER (PARTITION BY store_name ORDER BY full_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS accumulated_revenue
    FROM ({_DAILY}) ORDER BY store_name, full_date""")
def running_total(t: Tables) -> DataFrame:
    running = star_queries.accumulated_revenue(_daily(t))
    return as_types(running, daily_revenue="double", accumulated_revenue="double")
