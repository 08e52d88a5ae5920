"""Filters, joins and aggregates over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import enrich_with_status, fanout_report, orphans, with_partner
from ledgerloom.operators.keys import (
    drop_exact_copies,
    duplicate_keys,
    rows_per_key,
    singleton_keys,
    singleton_rows,
)
from ledgerloom.operators.quality import Rule, first_failure
from ledgerloom.plans import store_summary as stores
from ledgerloom.plans.line_amount import add_line_amount
from ledgerloom.queries.registry import Tables, as_types, money, query

# --- order lines: order, product, quantity, unit price, discount --------------

_LINES = """
    SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS product_id,
           l_suppkey AS store_id, CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
           CAST(l_discount AS DECIMAL(4,2)) AS discount, l_returnflag, l_linestatus
    FROM lineitem"""


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("unit_price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        "l_returnflag",
        "l_linestatus",
    )


# Lines with gaps: no quantity on every seventh line of an order, no product on
# returned lines with the top tax rate. Stand-ins for missing source values.
_GAPPY = """
    SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_suppkey AS store_id,
           CASE WHEN l_returnflag = 'R' AND CAST(l_tax AS DECIMAL(4,2)) = 0.08
                THEN NULL ELSE l_partkey END AS product_id,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
    FROM lineitem"""


def _gappy_lines(t: Tables) -> DataFrame:
    returned = (F.col("l_returnflag") == "R") & (F.col("l_tax").cast("decimal(4,2)") == 0.08)
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_suppkey").alias("store_id"),
        F.when(~returned, F.col("l_partkey")).alias("product_id"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int")).alias("quantity"),
        money("l_extendedprice").alias("unit_price"),
    )


def _customer_totals(t: Tables) -> DataFrame:
    """Lines folded per order, then per customer: joins see one row per key."""
    gross = F.col("quantity") * F.col("unit_price")
    per_order = _lines(t).groupBy(F.col("order_id").alias("o_orderkey")).agg(
        F.count("*").alias("lines"),
        F.sum(gross).alias("gross"),
        F.sum(gross * (1 - F.col("discount"))).alias("net"),
    )
    return (
        per_order.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").alias("orders"),
            *[F.sum(c).alias(c) for c in ("lines", "gross", "net")],
        )
    )


def _country_totals(t: Tables) -> DataFrame:
    """Customers, orders, lines, gross and net sales per country."""
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    per_nation = (
        _customer_totals(t)
        .join(customers, "c_custkey")
        .groupBy("n_nationkey")
        .agg(
            F.count("*").alias("customers"),
            *[F.sum(c).alias(c) for c in ("orders", "lines", "gross", "net")],
        )
    )
    return (
        per_nation.join(t.nation, "n_nationkey")
        .groupBy(F.col("n_name").alias("country"))
        .agg(*[F.sum(c).alias(c) for c in ("customers", "orders", "lines", "gross", "net")])
    )


_COUNTRY_LINES = f"""
    SELECT n_name AS country, li.* FROM ({_LINES}) li
    JOIN orders ON o_orderkey = li.order_id
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey"""


@query(f"""
    SELECT country, CAST(SUM(quantity * unit_price) AS DOUBLE) AS total_sales
    FROM ({_COUNTRY_LINES}) GROUP BY country""")
def sales_by_country(t: Tables) -> DataFrame:
    return _country_totals(t).select("country", F.col("gross").cast("double").alias("total_sales"))


@query(f"""
    SELECT country FROM ({_COUNTRY_LINES}) GROUP BY country
    HAVING SUM(quantity * unit_price) > 3000000000""")
def countries_over_threshold(t: Tables) -> DataFrame:
    return _country_totals(t).filter(F.col("gross") > 3_000_000_000).select("country")


@query(f"""
    SELECT country, CAST(SUM(quantity * unit_price * (1 - discount)) AS DOUBLE) AS real_sales
    FROM ({_COUNTRY_LINES}) GROUP BY country HAVING COUNT(order_id) >= 100
    ORDER BY real_sales DESC""")
def real_sales_by_country(t: Tables) -> DataFrame:
    kept = _country_totals(t).filter("lines >= 100")
    sales = kept.select("country", F.col("net").cast("double").alias("real_sales"))
    return sales.orderBy(F.desc("real_sales"), "country")


@query(f"""
    SELECT p_type AS product_category, COUNT(order_id) AS number_of_orders,
           CAST(SUM(quantity) AS BIGINT) AS units_sold,
           CAST(SUM(quantity * unit_price) AS DOUBLE) AS gross_sales,
           CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS average_unit_price
    FROM ({_LINES}) JOIN part ON p_partkey = product_id
    GROUP BY p_type ORDER BY gross_sales DESC""")
def category_summary(t: Tables) -> DataFrame:
    gross = F.col("quantity") * F.col("unit_price")
    per_product = _lines(t).groupBy(F.col("product_id").alias("p_partkey")).agg(
        F.count("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum(gross).alias("gross"),
        F.sum("unit_price").alias("prices"),
        F.count("unit_price").alias("priced"),
    )
    return (
        per_product.join(t.part.select("p_partkey", "p_type"), "p_partkey")
        .groupBy(F.col("p_type").alias("product_category"))
        .agg(
            F.sum("orders").alias("number_of_orders"),
            F.sum("units").alias("units_sold"),
            F.sum("gross").cast("double").alias("gross_sales"),
            (F.sum("prices").cast("double") / F.sum("priced")).alias("average_unit_price"),
        )
        .orderBy(F.desc("gross_sales"), "product_category")
    )


@query(f"""
    SELECT order_id,
           CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS average_unit_price,
           CAST(SUM(quantity * unit_price) AS DOUBLE) / COUNT(quantity * unit_price)
               AS average_money_spent
    FROM ({_LINES}) GROUP BY order_id""")
def avg_per_order(t: Tables) -> DataFrame:
    # An average as sum over count: the sum is exact, whatever the row order.
    gross = F.col("quantity") * F.col("unit_price")

    def average(value):
        return F.sum(value).cast("double") / F.count(value)

    return _lines(t).groupBy("order_id").agg(
        average(F.col("unit_price")).alias("average_unit_price"),
        average(gross).alias("average_money_spent"),
    )


@query(f"""
    SELECT COUNT(DISTINCT o_orderkey) AS number_of_orders,
           CAST(SUM(quantity * unit_price) AS DOUBLE) AS total_sales
    FROM orders JOIN ({_LINES}) ON order_id = o_orderkey
    WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1997-01-01'
      AND o_orderdate < DATE '1998-01-01'""")
def orders_in_year(t: Tables) -> DataFrame:
    # Bounds of the column's own type reach the Parquet scan as pushed filters.
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1998-01-01"))
    wanted = t.orders.filter(
        (F.col("o_orderstatus") == "F")
        & (F.col("o_orderdate") >= start)
        & (F.col("o_orderdate") < end)
    )
    per_order = _lines(t).groupBy(F.col("order_id").alias("o_orderkey")).agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("gross")
    )
    return per_order.join(wanted.select("o_orderkey"), "o_orderkey").agg(
        F.countDistinct("o_orderkey").alias("number_of_orders"),
        F.sum("gross").cast("double").alias("total_sales"),
    )


# --- customers and orders -----------------------------------------------------


def _completed_orders(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'F'")


@query("""
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
           c_name AS customer_name, n_name AS country
    FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey""")
def orders_with_customer(t: Tables) -> DataFrame:
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("country"),
    )


@query("""
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS country,
           o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F')
      ON c_custkey = o_custkey""")
def customers_all_orders(t: Tables) -> DataFrame:
    on = F.col("c_custkey") == F.col("o_custkey")
    # Matched orders keep the fact on the left, where a hot customer can be
    # split; customers without orders are added by an anti join.
    matched = _completed_orders(t).join(t.customer, on).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("country"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    idle = _idle_customers(t).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("country"),
    )
    return matched.unionByName(idle, allowMissingColumns=True)


def _idle_customers(t: Tables) -> DataFrame:
    # Distinct customers of the orders: a hot customer is one row on this side.
    buyers = _completed_orders(t).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.join(buyers, "c_custkey", "left_anti")


@query("""
    SELECT c_custkey AS customer_id, c_name AS customer_name
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F')
      ON c_custkey = o_custkey
    WHERE o_orderkey IS NULL""")
def customers_without_orders(t: Tables) -> DataFrame:
    return _idle_customers(t).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


@query(f"""
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
           c_name AS customer_name,
           CAST(SUM(quantity * unit_price) AS DOUBLE) AS total_order_amount
    FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN ({_LINES}) ON order_id = o_orderkey
    GROUP BY o_orderkey, o_orderdate, c_name""")
def order_totals(t: Tables) -> DataFrame:
    # The lines are totalled to one row per order before anything is joined.
    totals = _lines(t).groupBy(F.col("order_id").alias("o_orderkey")).agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("total")
    )
    orders = t.orders.select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("c_custkey"))
    customers = t.customer.select("c_custkey", "c_name")
    return (
        totals.join(orders, "o_orderkey")
        .join(customers, "c_custkey")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("c_name").alias("customer_name"),
            F.col("total").cast("double").alias("total_order_amount"),
        )
    )


@query(f"""
    SELECT n_name AS country, COUNT(DISTINCT c_custkey) AS number_of_customers,
           COUNT(DISTINCT o_orderkey) AS number_of_orders,
           CAST(SUM(quantity * unit_price) AS DOUBLE) AS total_revenue
    FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN ({_LINES}) ON order_id = o_orderkey
    JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_name ORDER BY total_revenue DESC""")
def revenue_by_country(t: Tables) -> DataFrame:
    # Folding per order and per customer turns both distinct counts into sums.
    return (
        _country_totals(t)
        .select(
            "country",
            F.col("customers").alias("number_of_customers"),
            F.col("orders").alias("number_of_orders"),
            F.col("gross").cast("double").alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )


# --- projections, conditions, nulls -------------------------------------------


@query(f"""
    SELECT order_id, line_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
           CAST(quantity * unit_price AS DOUBLE) AS total_amount
    FROM ({_GAPPY}) WHERE unit_price > 5000""")
def line_amount(t: Tables) -> DataFrame:
    priced = add_line_amount(_gappy_lines(t)).filter("unit_price > 5000")
    chosen = priced.select("order_id", "line_id", "quantity", "unit_price", "total_amount")
    return as_types(chosen, unit_price="double", total_amount="double")


@query(f"""
    SELECT order_id, line_id, quantity, CAST(unit_price AS DOUBLE) AS price,
           CASE WHEN unit_price >= 50000 THEN 'high' ELSE 'low' END AS price_category
    FROM ({_GAPPY})""")
def project_final(t: Tables) -> DataFrame:
    category = F.when(F.col("unit_price") >= 50000, "high").otherwise("low")
    renamed = _gappy_lines(t).withColumn("price_category", category)
    renamed = renamed.withColumnRenamed("unit_price", "price").drop("product_id", "store_id")
    return as_types(renamed, price="double")


@query(f"""
    SELECT order_id, line_id,
           CASE WHEN unit_price >= 50000 THEN 'high' ELSE 'low' END AS price_category,
           CASE WHEN quantity >= 25 THEN 'high' WHEN quantity IS NULL THEN 'missing'
                ELSE 'low' END AS quantity_category
    FROM ({_GAPPY})""")
def price_category(t: Tables) -> DataFrame:
    high_price = [Rule("high", F.col("unit_price") >= 50000)]
    quantities = [Rule("high", F.col("quantity") >= 25), Rule("missing", F.col("quantity").isNull())]
    return _gappy_lines(t).select(
        "order_id",
        "line_id",
        first_failure(high_price, otherwise="low").alias("price_category"),
        first_failure(quantities, otherwise="low").alias("quantity_category"),
    )


@query(f"""
    SELECT order_id, line_id, product_id, COALESCE(quantity, 0) AS quantity FROM ({_GAPPY})""")
def fill_nulls(t: Tables) -> DataFrame:
    return _gappy_lines(t).na.fill({"quantity": 0}).select(
        "order_id", "line_id", "product_id", "quantity"
    )


@query(f"""
    SELECT CASE WHEN quantity IS NULL THEN 'without_quantity' ELSE 'with_quantity' END AS part,
           COUNT(*) AS row_count, COUNT(product_id) AS with_product,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity
    FROM ({_GAPPY}) GROUP BY 1""")
def null_split(t: Tables) -> DataFrame:
    with_quantity, without = stores.split_null_quantity(_gappy_lines(t))

    def counts(df: DataFrame, part: str) -> DataFrame:
        return df.groupBy(F.lit(part).alias("part")).agg(
            F.count("*").alias("row_count"),
            F.count("product_id").alias("with_product"),
            F.sum("quantity").alias("total_quantity"),
        )

    return counts(with_quantity, "with_quantity").unionByName(counts(without, "without_quantity"))


@query(f"""
    SELECT order_id, line_id, product_id, quantity,
           CAST(quantity * unit_price AS DOUBLE) AS total_amount,
           CASE WHEN quantity IS NULL OR product_id IS NULL THEN 'invalid' ELSE 'valid' END
               AS data_quality_status
    FROM ({_GAPPY})""")
def quality_status(t: Tables) -> DataFrame:
    missing = F.col("quantity").isNull() | F.col("product_id").isNull()
    status = first_failure([Rule("invalid", missing)], otherwise="valid")
    rows = add_line_amount(_gappy_lines(t)).withColumn("data_quality_status", status)
    return as_types(rows, total_amount="double").select(
        "order_id", "line_id", "product_id", "quantity", "total_amount", "data_quality_status"
    )


# --- copies and keys ----------------------------------------------------------


@query(f"""
    SELECT DISTINCT order_id, line_id, product_id, store_id, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price
    FROM (SELECT * FROM ({_LINES}) UNION ALL
          SELECT * FROM ({_LINES}) WHERE l_returnflag = 'R')""")
def drop_exact_duplicates(t: Tables) -> DataFrame:
    lines = _lines(t)
    redelivered = lines.unionByName(lines.filter("l_returnflag = 'R'"))
    rows = redelivered.select(
        "order_id", "line_id", "product_id", "store_id", "quantity", "unit_price"
    )
    return as_types(drop_exact_copies(rows), unit_price="double")


@query("""
    SELECT l_orderkey AS order_id, l_linenumber AS line_id, COUNT(*) AS row_count
    FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""", name="duplicate_keys")
def duplicate_line_keys(t: Tables) -> DataFrame:
    return duplicate_keys(_lines(t), ["order_id", "line_id"])


@query("""
    SELECT l_orderkey AS order_id, l_linenumber AS line_id
    FROM lineitem GROUP BY ALL HAVING COUNT(*) = 1""", name="singleton_keys")
def singleton_line_keys(t: Tables) -> DataFrame:
    return singleton_keys(_lines(t), ["order_id", "line_id"])


@query(f"""
    SELECT order_id, line_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY order_id, line_id) AS n FROM ({_LINES}))
    WHERE n = 1""", name="singleton_rows")
def singleton_line_rows(t: Tables) -> DataFrame:
    rows = _lines(t).select("order_id", "line_id", "product_id", "quantity", "unit_price")
    return as_types(singleton_rows(rows, ["order_id", "line_id"]), unit_price="double")


# --- sales against a product list that lacks some products ---------------------

_LISTED = "SELECT p_partkey AS product_id, p_name AS product_name FROM part WHERE p_size <= 40"


def _listed_products(t: Tables) -> DataFrame:
    return t.part.filter("p_size <= 40").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )


_VALID_SALES = f"""
    SELECT s.*, p.product_name, quantity * unit_price AS revenue
    FROM ({_GAPPY}) s JOIN ({_LISTED}) p USING (product_id) WHERE quantity IS NOT NULL"""


@query(f"""
    SELECT order_id, line_id, product_id, quantity FROM ({_GAPPY})
    WHERE quantity IS NOT NULL
      AND (product_id IS NULL OR product_id NOT IN (SELECT product_id FROM ({_LISTED})))""")
def orphan_rows(t: Tables) -> DataFrame:
    sales = stores.unknown_products(_gappy_lines(t), _listed_products(t))
    return sales.select("order_id", "line_id", "product_id", "quantity")


@query(f"""
    SELECT order_id, line_id, product_id, quantity FROM ({_GAPPY})
    WHERE quantity IS NOT NULL AND product_id IN (SELECT product_id FROM ({_LISTED}))""")
def semi_valid_rows(t: Tables) -> DataFrame:
    sales = stores.valid_sales(_gappy_lines(t), _listed_products(t))
    return sales.select("order_id", "line_id", "product_id", "quantity")


@query(f"""
    SELECT order_id, line_id, product_id, product_name, CAST(revenue AS DOUBLE) AS total_revenue
    FROM ({_VALID_SALES})""")
def enrich_left(t: Tables) -> DataFrame:
    rows = stores.enriched_sales(_gappy_lines(t), _listed_products(t))
    chosen = rows.select("order_id", "line_id", "product_id", "product_name", "total_revenue")
    return as_types(chosen, total_revenue="double")


@query(f"""
    SELECT store_id, COUNT(*) AS total_orders, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
           CAST(SUM(revenue) AS DOUBLE) AS total_revenue
    FROM ({_VALID_SALES}) GROUP BY store_id""")
def store_summary(t: Tables) -> DataFrame:
    # The product name plays no part in the totals, so only valid_sales is needed.
    valid = stores.valid_sales(_gappy_lines(t), _listed_products(t))
    summary = stores.summarize(add_line_amount(valid, "total_revenue"), ["store_id"])
    return as_types(summary, total_revenue="double")


@query(f"""
    SELECT store_id, product_id, COUNT(*) AS total_orders,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity,
           CAST(SUM(revenue) AS DOUBLE) AS total_revenue
    FROM ({_VALID_SALES}) GROUP BY store_id, product_id""")
def store_product_summary(t: Tables) -> DataFrame:
    valid = stores.valid_sales(_gappy_lines(t), _listed_products(t))
    by = ["store_id", "product_id"]
    return as_types(
        stores.summarize(add_line_amount(valid, "total_revenue"), by), total_revenue="double"
    )


@query("""
    SELECT (SELECT COUNT(*) FROM lineitem) AS rows_before,
           (SELECT COUNT(*) FROM (
                SELECT p_name FROM lineitem JOIN part ON p_partkey = l_partkey) s
            LEFT JOIN part d ON d.p_name = s.p_name) AS rows_after,
           (SELECT COUNT(*) FROM (
                SELECT p_name FROM part GROUP BY p_name HAVING COUNT(*) > 1)) AS repeated_keys""")
def join_fanout(t: Tables) -> DataFrame:
    # Product names repeat: joining sales on the name multiplies them.
    named = t.part.select("p_partkey", "p_name")
    sales = t.lineitem.select(F.col("l_partkey").alias("p_partkey")).join(named, "p_partkey")
    return fanout_report(sales, t.part, ["p_name"])


@query(f"""
    WITH names AS (SELECT p_name, COUNT(*) AS n, MIN(p_type) AS category FROM part GROUP BY p_name),
    sales AS (SELECT li.order_id, li.line_id, p_name
              FROM ({_LINES}) li JOIN part ON p_partkey = product_id)
    SELECT order_id, line_id, sales.p_name AS product_name,
           CASE WHEN n = 1 THEN category END AS p_type,
           CASE WHEN n > 1 THEN 'CATALOG_DUPLICATE' WHEN n = 1 THEN 'ENRICHED'
                ELSE 'CATALOG_MISSING' END AS enrichment_status
    FROM sales LEFT JOIN names ON names.p_name = sales.p_name""")
def name_contract(t: Tables) -> DataFrame:
    """Enrichment against a list whose key repeats, without versions."""
    named = t.part.select(F.col("p_partkey").alias("product_id"), "p_name")
    sales = _lines(t).join(named, "product_id").select("order_id", "line_id", "p_name")
    catalogue = rows_per_key(t.part.select("p_name", "p_type"), ["p_name"])
    rows = enrich_with_status(sales, catalogue, ["p_name"], ["p_type"])
    return rows.withColumnRenamed("p_name", "product_name")
