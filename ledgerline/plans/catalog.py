"""Registered queries: key -> (spark callable, DuckDB oracle SQL or None).

Each callable takes (spark, sf_dir) and returns a lazy DataFrame over the
whole supplied tables.  Every computed column carries the same alias in the
callable and in its oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.operators import aggregate as agg
from ledgerline.operators import joins, reconcile, windows
from ledgerline.plans.oracle import (DOCS_LABELS, S_CUSTOMERS, S_ITEMS, S_ORDERS, SALES,
                                     round2, with_)
from ledgerline.sources import bindings as b
from ledgerline.sources import raw_views as R

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}

# --- fixed parameters of the bound queries (money in cents) -----------------
REGION_FILTER = "AMERICA"
LINE_HIGH_ABOVE, LINE_MEDIUM_FROM = 1_000_000, 200_000          # C01 / C02
CUSTOMER_HIGH_FROM, CUSTOMER_MEDIUM_FROM = 120_000_000, 80_000_000  # C03
REGION_LOW_BELOW = 29_000_000_000                                # P06 / C08
# ---------------------------------------------------------------------------


def register(key: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = (fn, oracle)
        return fn
    return deco


S = with_(SALES)
REV = "quantity * price"


def grouped(keys: str, *measures: str) -> str:
    """Subquery: the given measures of ``sales`` per key."""
    return f"(SELECT {keys}, {', '.join(measures)} FROM sales GROUP BY {keys})"


def money(name: str) -> str:
    return f"CAST(SUM({REV}) AS BIGINT) AS {name}"


ROWS = "COUNT(*) AS order_count"
PER_PRODUCT = grouped("product", money("total_revenue"))
PER_CUSTOMER = grouped("customer_id, region", money("total_revenue"), ROWS)
PER_DAY = grouped("order_date", money("daily_revenue"))


# ------------------------------------------------------------ aggregation --

@register("agg_region", S + f"""SELECT region, CAST(SUM({REV}) AS BIGINT) AS total_revenue,
  COUNT(*) AS order_count FROM sales GROUP BY region""")
def q_agg_region(spark, d):
    return agg.by_region(b.order_facts(spark, d))


@register("agg_total", S + f"""SELECT CAST(SUM({REV}) AS BIGINT) AS total_revenue,
  COUNT(*) AS total_orders FROM sales""")
def q_agg_total(spark, d):
    return agg.total(b.order_facts(spark, d))


@register("agg_avg", S + f"""SELECT AVG({REV}) AS avg_order_value,
  CAST(SUM({REV}) AS DOUBLE) / COUNT(*) AS avg_order_value_manual FROM sales""")
def q_agg_avg(spark, d):
    return agg.average(b.order_facts(spark, d))


@register("agg_product", S + f"""SELECT product, CAST(SUM({REV}) AS BIGINT) AS total_revenue,
  CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold, COUNT(*) AS order_count
  FROM sales GROUP BY product""")
def q_agg_product(spark, d):
    return agg.by_product(b.product_facts(spark, d))


@register("agg_region_multi", S + f"""SELECT region AS Region,
  CAST(SUM({REV}) AS BIGINT) AS Total_Revenue, CAST(SUM(quantity) AS BIGINT) AS Total_Quantity
  FROM sales GROUP BY region""")
def q_agg_region_multi(spark, d):
    return agg.by_region_multi(b.order_facts(spark, d))


@register("agg_daily", S + f"""SELECT order_date, CAST(SUM({REV}) AS BIGINT) AS daily_revenue,
  COUNT(*) AS daily_orders FROM sales GROUP BY order_date""")
def q_agg_daily(spark, d):
    return agg.daily(b.order_facts(spark, d))


@register("agg_filtered", S + f"""SELECT region, CAST(SUM({REV}) AS BIGINT) AS total_revenue
  FROM sales WHERE region = '{REGION_FILTER}' GROUP BY region""")
def q_agg_filtered(spark, d):
    return agg.filtered_region(b.order_facts(spark, d), REGION_FILTER)


@register("agg_customer_region", S + f"""SELECT customer_id, region,
  CAST(SUM({REV}) AS BIGINT) AS total_revenue, COUNT(*) AS order_count
  FROM sales GROUP BY customer_id, region""")
def q_agg_customer_region(spark, d):
    return agg.customer_region(b.order_facts(spark, d))


@register("agg_region_avg", S + f"""SELECT *, CAST(total_revenue AS DOUBLE) / order_count
  AS avg_order_value FROM {grouped("region", money("total_revenue"), ROWS)}""")
def q_agg_region_avg(spark, d):
    return agg.region_average(b.order_facts(spark, d))


@register("agg_daily_customers", S + f"""SELECT order_date,
  CAST(SUM({REV}) AS BIGINT) AS daily_revenue,
  COUNT(DISTINCT customer_id) AS unique_customers FROM sales GROUP BY order_date""")
def q_agg_daily_customers(spark, d):
    return agg.daily_customers(b.order_facts(spark, d))


@register("agg_items_ratio", with_(S_ORDERS, S_ITEMS) + """SELECT
  'Orders to Order Items' AS relationship, COUNT(DISTINCT o.order_id) AS orders,
  COUNT(oi.order_id) AS order_items,
  CAST(COUNT(oi.order_id) AS DOUBLE) / COUNT(DISTINCT o.order_id) AS avg_items_per_order
  FROM s_orders o JOIN s_items oi ON o.order_id = oi.order_id""")
def q_agg_items_ratio(spark, d):
    return agg.items_ratio(b.orders(spark, d), b.order_items(spark, d))


@register("agg_order_items", with_(S_ORDERS, S_ITEMS) + """SELECT o.order_id,
  COUNT(*) AS item_count, CAST(SUM(oi.quantity * oi.price) AS BIGINT) AS order_revenue
  FROM s_orders o JOIN s_items oi ON o.order_id = oi.order_id GROUP BY o.order_id""")
def q_agg_order_items(spark, d):
    return agg.order_items_summary(b.orders(spark, d), b.order_items(spark, d))


@register("agg_skip_missing", with_(DOCS_LABELS) + """SELECT source,
  CAST(COALESCE(SUM(toxic), 0) AS BIGINT) AS total_toxic
  FROM docs_labels WHERE source IS NOT NULL GROUP BY source""")
def q_agg_skip_missing(spark, d):
    return agg.skip_missing(b.docs_labels(spark, d), "source", "toxic", "total_toxic") \
        .select("source", F.col("total_toxic").cast("bigint").alias("total_toxic"))


@register("rep_summary", S + f""", g AS (
  SELECT region, CAST(SUM({REV}) AS BIGINT) AS total_revenue, COUNT(*) AS order_count
  FROM sales GROUP BY region)
SELECT CAST(COALESCE(SUM(order_count), 0) AS BIGINT) AS record_count,
  SUM(total_revenue) / SUM(order_count) AS mean_per_record,
  COUNT(*) AS group_count, CAST(COALESCE(SUM(total_revenue), 0) AS BIGINT) AS total,
  AVG(total_revenue) AS mean_per_group,
  arg_min(region, (-total_revenue, region)) AS best_group,
  MAX(total_revenue) AS best_value,
  format('{{:,.2f}}', CAST(COALESCE(SUM(total_revenue), 0) AS DOUBLE)) AS total_text FROM g""")
def q_rep_summary(spark, d):
    return agg.pipeline_summary(agg.by_region(b.order_facts(spark, d)), "region",
                                "total_revenue", "order_count")


# ------------------------------------------------------------- projection --

@register("proj_star", S + "SELECT * FROM sales")
def q_proj_star(spark, d):
    return b.sales(spark, d).orderBy("order_date", "order_id")


@register("proj_subset", S + "SELECT order_id, product, quantity, price FROM sales")
def q_proj_subset(spark, d):
    return b.sales(spark, d).select("order_id", "product", "quantity", "price")


@register("proj_revenue", S + f"SELECT *, {REV} AS revenue FROM sales")
def q_proj_revenue(spark, d):
    return agg.with_revenue(b.sales(spark, d))


@register("proj_rename", with_(S_CUSTOMERS) + """SELECT customer_id AS Customer_ID,
  customer_name AS Customer_Name, region AS Region FROM s_customers""")
def q_proj_rename(spark, d):
    return b.customers(spark, d).toDF("Customer_ID", "Customer_Name", "Region")


@register("filt_and", S + f"SELECT * FROM sales WHERE region = '{REGION_FILTER}' AND quantity > 1")
def q_filt_and(spark, d):
    s = b.sales(spark, d)
    return s.where((F.col("region") == REGION_FILTER) & (F.col("quantity") > 1))


@register("filt_threshold", S + f"""SELECT * FROM (SELECT region AS Region,
  CAST(SUM({REV}) AS BIGINT) AS Total_Revenue, CAST(SUM(quantity) AS BIGINT) AS Total_Quantity
  FROM sales GROUP BY region) WHERE Total_Revenue < {REGION_LOW_BELOW}""")
def q_filt_threshold(spark, d):
    return agg.by_region_multi(b.order_facts(spark, d)).where(
        F.col("Total_Revenue") < F.lit(REGION_LOW_BELOW))


@register("filt_null", with_(DOCS_LABELS) + """SELECT doc_id, lang, source FROM docs_labels
  WHERE quality IS NULL""")
def q_filt_null(spark, d):
    return b.docs_labels(spark, d).where(F.col("quality").isNull()) \
        .select("doc_id", "lang", "source")


@register("proj_bool_check", S + f"""SELECT order_id, quantity, price,
  {REV} AS calculated_revenue, ({REV}) = ({REV}) AS validation_check FROM sales""")
def q_proj_bool_check(spark, d):
    return reconcile.row_check(b.sales(spark, d))


@register("lim_verify5", S + f"""SELECT order_id, quantity, price, {REV} AS calculated_revenue
  FROM sales ORDER BY order_id, product, quantity, price LIMIT 5""")
def q_lim_verify5(spark, d):
    return (b.sales(spark, d).orderBy("order_id", "product", "quantity", "price").limit(5)
            .select("order_id", "quantity", "price", agg.revenue().alias("calculated_revenue")))


@register("top2_products", S + f"""SELECT product, CAST(SUM({REV}) AS BIGINT) AS total_revenue
  FROM sales GROUP BY product ORDER BY total_revenue DESC, product LIMIT 2""")
def q_top2_products(spark, d):
    return (windows.product_revenue(b.product_facts(spark, d))
            .orderBy(F.desc("total_revenue"), "product").limit(2))


@register("top_region", S + f"""SELECT region AS Region, CAST(SUM({REV}) AS BIGINT) AS Total_Revenue,
  CAST(SUM(quantity) AS BIGINT) AS Total_Quantity FROM sales GROUP BY region
  ORDER BY Total_Revenue DESC, Region LIMIT 1""")
def q_top_region(spark, d):
    return agg.by_region_multi(b.order_facts(spark, d)).limit(1)


@register("set_union_all", with_(S_CUSTOMERS, S_ORDERS, S_ITEMS) + """
  SELECT 'Customers' AS table_name, COUNT(*) AS row_count FROM s_customers
  UNION ALL SELECT 'Orders', COUNT(*) FROM s_orders
  UNION ALL SELECT 'Order Items', COUNT(*) FROM s_items""")
def q_set_union_all(spark, d):
    return reconcile.labelled_counts({"Customers": b.customers(spark, d),
                                      "Orders": b.orders(spark, d),
                                      "Order Items": b.order_items(spark, d)})


@register("subq_scalar", S + """SELECT (SELECT COUNT(*) FROM sales) AS total_rows,
  (SELECT CAST(SUM(c) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM sales GROUP BY region))
  AS aggregated_rows""")
def q_subq_scalar(spark, d):
    return reconcile.group_loss(b.sales(spark, d), "region").drop("rows_match")


# ------------------------------------------------------------------ joins --

@register("join_two", with_(S_ORDERS, S_CUSTOMERS) + """SELECT o.order_id, o.order_date,
  c.customer_id, c.customer_name, c.region
  FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id""")
def q_join_two(spark, d):
    return joins.orders_customers(b.orders(spark, d), b.customers(spark, d))


@register("join_three", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + """SELECT o.order_id,
  o.order_date, c.customer_name, c.region, oi.product, oi.quantity, oi.price,
  oi.quantity * oi.price AS revenue
  FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
  JOIN s_items oi ON o.order_id = oi.order_id""")
def q_join_three(spark, d):
    return joins.orders_customers_items(b.orders(spark, d), b.customers(spark, d),
                                        b.order_items(spark, d))


@register("anti_orders", with_(S_ORDERS, S_CUSTOMERS) + """SELECT o.order_id, o.customer_id,
  o.order_date FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id
  WHERE c.customer_id IS NULL""")
def q_anti_orders(spark, d):
    return joins.orders_without_customer(b.orders(spark, d), b.customers(spark, d))


@register("anti_customers", with_(S_ORDERS, S_CUSTOMERS) + """SELECT c.customer_id,
  c.customer_name, c.region FROM s_customers c
  LEFT JOIN s_orders o ON c.customer_id = o.customer_id WHERE o.order_id IS NULL""")
def q_anti_customers(spark, d):
    return joins.customers_without_order(b.customers(spark, d), b.orders(spark, d))


@register("anti_orders_faulted", with_(R.FAULT_ORDERS_CTE, S_CUSTOMERS) + """SELECT o.order_id,
  o.customer_id, o.order_date FROM fault_orders o LEFT JOIN s_customers c
  ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL""")
def q_anti_orders_faulted(spark, d):
    return joins.orders_without_customer(R.fault_orders(spark, d), b.customers(spark, d))


RECENT_FROM = "1998-01-01"


@register("anti_customers_recent", with_(S_ORDERS, S_CUSTOMERS) + f"""SELECT c.customer_id,
  c.customer_name, c.region FROM s_customers c WHERE NOT EXISTS (SELECT 1 FROM s_orders o
  WHERE o.customer_id = c.customer_id AND o.order_date >= DATE '{RECENT_FROM}')""")
def q_anti_customers_recent(spark, d):
    """Customers without an order since a day."""
    recent = b.orders(spark, d).where(F.col("order_date") >= F.lit(RECENT_FROM).cast("date"))
    return joins.customers_without_order(b.customers(spark, d), recent)


@register("anti_orders_items", with_(S_ORDERS, S_ITEMS) + """SELECT o.order_id, o.customer_id,
  o.order_date FROM s_orders o WHERE NOT EXISTS
  (SELECT 1 FROM s_items oi WHERE oi.order_id = o.order_id)""")
def q_anti_orders_items(spark, d):
    return joins.orders_without_items(b.orders(spark, d), b.order_items(spark, d))


@register("cross_preview", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + """, o AS (
  SELECT order_id FROM s_orders ORDER BY order_id LIMIT 20),
 c AS (SELECT customer_name FROM s_customers ORDER BY customer_name LIMIT 20),
 i AS (SELECT product, quantity, price FROM s_items ORDER BY product, quantity, price LIMIT 20)
SELECT o.order_id, c.customer_name, i.product FROM o, c, i
ORDER BY o.order_id, c.customer_name, i.product, i.quantity, i.price LIMIT 20""")
def q_cross_preview(spark, d):
    """First 20 rows of orders x customers x order_items (the comma join)
    in (order_id, customer_name, product, quantity, price) order, without
    forming the product.  The oracle states the same fact in SQL (the first
    20 rows of the ordered product only use each factor's first 20 rows);
    a brute-force product on the reference fixture tests it too."""
    return joins.cross_preview([(b.orders(spark, d), ["order_id"]),
                                (b.customers(spark, d), ["customer_name"]),
                                (b.order_items(spark, d), ["product", "quantity", "price"])],
                               20).select("order_id", "customer_name", "product")


@register("cross_count", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + """SELECT
  CAST((SELECT COUNT(*) FROM s_orders)::HUGEINT * (SELECT COUNT(*) FROM s_customers)
  * (SELECT COUNT(*) FROM s_items) AS DECIMAL(38,0)) AS cartesian_product_rows""")
def q_cross_count(spark, d):
    return joins.cross_count(b.orders(spark, d), b.customers(spark, d), b.order_items(spark, d))


@register("join_region_revenue", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + """SELECT c.region,
  CAST(SUM(oi.quantity * oi.price) AS BIGINT) AS total_revenue
  FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
  JOIN s_items oi ON o.order_id = oi.order_id GROUP BY c.region""")
def q_join_region_revenue(spark, d):
    return joins.region_revenue(b.orders(spark, d), b.customers(spark, d),
                                b.order_items(spark, d))


# --------------------------------------------------------- reconciliation --

JOIN3 = """s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
  JOIN s_items oi ON o.order_id = oi.order_id"""


def _joined(spark, d):
    return b.orders(spark, d).join(b.customers(spark, d).select("customer_id"), "customer_id") \
        .join(b.order_items(spark, d), "order_id")


@register("rec_group_loss", S + """SELECT (SELECT COUNT(*) FROM sales) AS total_rows,
  (SELECT CAST(SUM(c) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM sales GROUP BY region))
  AS aggregated_rows, (SELECT COUNT(*) FROM sales) = (SELECT SUM(c) FROM
  (SELECT COUNT(*) AS c FROM sales GROUP BY region)) AS rows_match""")
def q_rec_group_loss(spark, d):
    return reconcile.group_loss(b.sales(spark, d), "region")


@register("rec_join_rows", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + f"""
  SELECT 'Order Items (source)' AS source, COUNT(*) AS row_count FROM s_items
  UNION ALL SELECT 'After 3-table join', COUNT(*) FROM {JOIN3}""")
def q_rec_join_rows(spark, d):
    return reconcile.labelled_counts({"Order Items (source)": b.order_items(spark, d),
                                      "After 3-table join": _joined(spark, d)},
                                     label="source")


@register("rec_join_revenue", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + f"""
  SELECT 'Direct from order_items' AS source, CAST(SUM(quantity * price) AS BIGINT)
  AS total_revenue FROM s_items
  UNION ALL SELECT 'From joined tables', CAST(SUM(oi.quantity * oi.price) AS BIGINT)
  FROM {JOIN3}""")
def q_rec_join_revenue(spark, d):
    return reconcile.labelled_sums({"Direct from order_items": b.order_items(spark, d),
                                    "From joined tables": _joined(spark, d)})


@register("rec_fanout", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + f"""SELECT
  CAST((SELECT COUNT(*) FROM s_orders)::HUGEINT * (SELECT COUNT(*) FROM s_customers)
  * (SELECT COUNT(*) FROM s_items) AS DECIMAL(38,0)) AS cartesian_product_rows,
  (SELECT COUNT(*) FROM {JOIN3}) AS joined_rows,
  (SELECT COUNT(*) FROM s_items) AS order_items_rows,
  (SELECT COUNT(*) FROM {JOIN3}) = (SELECT COUNT(*) FROM s_items) AS join_preserves_rows""")
def q_rec_fanout(spark, d):
    return reconcile.fanout(b.orders(spark, d), b.customers(spark, d),
                            b.order_items(spark, d), _joined(spark, d))


@register("dup_keys", S + """SELECT order_id, COUNT(*) AS occurrence_count FROM sales
  GROUP BY order_id HAVING COUNT(*) > 1""")
def q_dup_keys(spark, d):
    return reconcile.duplicate_keys(b.sales(spark, d), "order_id")


@register("chk_unique", with_(S_CUSTOMERS) + """SELECT customer_id, COUNT(*) AS occurrence_count
  FROM s_customers GROUP BY customer_id HAVING COUNT(*) > 1""")
def q_chk_unique(spark, d):
    return reconcile.duplicate_keys(b.customers(spark, d), "customer_id")


@register("chk_not_null", with_(S_ORDERS) + "SELECT * FROM s_orders WHERE order_id IS NULL")
def q_chk_not_null(spark, d):
    return reconcile.null_keys(b.orders(spark, d), "order_id")


@register("chk_fk", with_(S_ORDERS, S_ITEMS) + """SELECT oi.* FROM s_items oi
  WHERE oi.order_id IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM s_orders o WHERE o.order_id = oi.order_id)""")
def q_chk_fk(spark, d):
    return reconcile.orphans(b.order_items(spark, d), b.orders(spark, d), "order_id")


_FAULTED = with_(R.FAULT_ORDERS_CTE, S_ITEMS)


@register("chk_unique_faulted", _FAULTED + """SELECT order_id, COUNT(*) AS occurrence_count
  FROM fault_orders GROUP BY order_id HAVING COUNT(*) > 1""")
def q_chk_unique_faulted(spark, d):
    return reconcile.duplicate_keys(R.fault_orders(spark, d), "order_id")


@register("chk_not_null_faulted", _FAULTED + "SELECT * FROM fault_orders WHERE order_id IS NULL")
def q_chk_not_null_faulted(spark, d):
    return reconcile.null_keys(R.fault_orders(spark, d), "order_id")


@register("chk_fk_faulted", _FAULTED + """SELECT oi.* FROM s_items oi WHERE oi.order_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM fault_orders o WHERE o.order_id = oi.order_id)""")
def q_chk_fk_faulted(spark, d):
    return reconcile.orphans(b.order_items(spark, d), R.fault_orders(spark, d), "order_id")


@register("rec_allclose", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + f""", a AS (
  SELECT order_id, SUM(quantity * price) / 100.0 AS x FROM s_items GROUP BY order_id),
 bb AS (SELECT o.order_id, SUM(oi.quantity * oi.price) / 100.0 AS y FROM {JOIN3}
  GROUP BY o.order_id),
 j AS (SELECT CAST(a.x AS DOUBLE) AS x, CAST(bb.y AS DOUBLE) AS y
  FROM a FULL OUTER JOIN bb ON a.order_id = bb.order_id),
 t AS (SELECT COALESCE((x = y OR abs(x - y) <= 1e-8 + 1e-5 * abs(y))
  AND NOT isnan(x) AND NOT isnan(y), false) AS ok FROM j)
SELECT COUNT(*) AS rows_compared, COUNT(*) FILTER (WHERE NOT ok) AS rows_different,
  bool_and(ok) AS all_close FROM t""")
def q_rec_allclose(spark, d):
    items = b.order_items(spark, d)
    direct = items.groupBy("order_id").agg((F.sum(agg.revenue()) / 100.0).alias("x"))
    joined = _joined(spark, d).groupBy("order_id").agg((F.sum(agg.revenue()) / 100.0).alias("y"))
    return reconcile.allclose(direct, joined, "order_id", "x", "y")


@register("rec_row_check", with_(S_ORDERS, S_CUSTOMERS, S_ITEMS) + f""", a AS (
  SELECT order_id, CAST(SUM(quantity * price) AS BIGINT) AS expected_revenue
  FROM s_items GROUP BY order_id),
 bb AS (SELECT o.order_id, CAST(SUM(oi.quantity * oi.price) AS BIGINT) AS actual_revenue
  FROM {JOIN3} GROUP BY o.order_id)
SELECT COALESCE(a.order_id, bb.order_id) AS order_id, expected_revenue, actual_revenue,
  expected_revenue IS NOT DISTINCT FROM actual_revenue AS revenue_matches
FROM a FULL OUTER JOIN bb ON a.order_id = bb.order_id""")
def q_rec_row_check(spark, d):
    return reconcile.order_revenue_check(b.order_items(spark, d), _joined(spark, d))


# ---------------------------------------------------------------- windows --

@register("win_rank_rownum", S + f"""SELECT product, total_revenue,
  CAST(RANK() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS revenue_rank,
  CAST(ROW_NUMBER() OVER (ORDER BY total_revenue DESC, product) AS BIGINT) AS row_number_rank
  FROM {PER_PRODUCT}""")
def q_win_rank_rownum(spark, d):
    return windows.rank_products(b.product_facts(spark, d))


@register("win_rank_compare", S + f"""SELECT product, total_revenue,
  CAST(RANK() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS rank_value,
  CAST(DENSE_RANK() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS dense_rank_value,
  CAST(ROW_NUMBER() OVER (ORDER BY total_revenue DESC, product) AS BIGINT) AS row_number_value
  FROM {PER_PRODUCT}""")
def q_win_rank_compare(spark, d):
    return windows.rank_compare(b.product_facts(spark, d))


@register("win_rank_region", S + f"""SELECT customer_id, region, total_revenue,
  CAST(RANK() OVER (PARTITION BY region ORDER BY total_revenue DESC) AS BIGINT)
  AS rank_in_region FROM {PER_CUSTOMER}""")
def q_win_rank_region(spark, d):
    return windows.rank_in_region(b.order_facts(spark, d))


@register("win_top2_region", S + f"""SELECT * FROM (SELECT customer_id, region,
  total_revenue, order_count,
  CAST(RANK() OVER (PARTITION BY region ORDER BY total_revenue DESC) AS BIGINT)
  AS rank_in_region FROM {PER_CUSTOMER}) WHERE rank_in_region <= 2""")
def q_win_top2_region(spark, d):
    return windows.top2_customers_per_region(b.order_facts(spark, d))


@register("win_top3_products", S + f"""SELECT * FROM (SELECT product, total_revenue,
  CAST(RANK() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS revenue_rank
  FROM {PER_PRODUCT}) WHERE revenue_rank <= 3""")
def q_win_top3_products(spark, d):
    return windows.top3_products(b.product_facts(spark, d))


@register("win_top_customer", S + f"""SELECT region, customer_id AS top_customer,
  total_revenue, order_count,
  CASE WHEN total_revenue >= {CUSTOMER_HIGH_FROM} THEN 'HIGH_VALUE'
       WHEN total_revenue >= {CUSTOMER_MEDIUM_FROM} THEN 'MEDIUM_VALUE'
       ELSE 'LOW_VALUE' END AS customer_segment
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY total_revenue DESC,
        customer_id) AS rn FROM {PER_CUSTOMER}) WHERE rn = 1""")
def q_win_top_customer(spark, d):
    return windows.top_customer_per_region(b.order_facts(spark, d), CUSTOMER_HIGH_FROM,
                                           CUSTOMER_MEDIUM_FROM)


LAG = "LAG(daily_revenue, 1) OVER (ORDER BY order_date)"


@register("ts_lag", S + f"""SELECT order_date, daily_revenue, {LAG} AS previous_day_revenue
  FROM {PER_DAY}""")
def q_ts_lag(spark, d):
    return windows.lag_daily(b.order_facts(spark, d))


@register("ts_trend_stable", S + f"""SELECT order_date, daily_revenue,
  {LAG} AS previous_day_revenue, daily_revenue - {LAG} AS day_over_day_change,
  CASE WHEN daily_revenue > {LAG} THEN 'GROWTH' WHEN daily_revenue < {LAG} THEN 'DECLINE'
  ELSE 'STABLE' END AS trend FROM {PER_DAY}""")
def q_ts_trend_stable(spark, d):
    return windows.trend_stable(b.order_facts(spark, d))


@register("ts_pct_change", S + f"""SELECT order_date, daily_revenue, previous_day_revenue,
  {round2("(daily_revenue - previous_day_revenue) / NULLIF(previous_day_revenue, 0) * 100")}
  AS percent_change FROM (SELECT *, {LAG} AS previous_day_revenue FROM {PER_DAY})
  WHERE previous_day_revenue IS NOT NULL""")
def q_ts_pct_change(spark, d):
    return windows.pct_change(b.order_facts(spark, d))


@register("ts_trend_na", S + f"""SELECT order_date, daily_revenue, previous_day_revenue, day_over_day_change,
  {round2("day_over_day_change / NULLIF(previous_day_revenue, 0) * 100")} AS percent_change,
  CASE WHEN day_over_day_change > 0 THEN '↑ GROWTH' WHEN day_over_day_change < 0
  THEN '↓ DECLINE' WHEN day_over_day_change = 0 THEN '→ STABLE' ELSE 'N/A' END AS trend
  FROM (SELECT *, {LAG} AS previous_day_revenue, daily_revenue - {LAG} AS day_over_day_change
  FROM {PER_DAY})""")
def q_ts_trend_na(spark, d):
    return windows.trend_na(b.order_facts(spark, d))


@register("ts_rolling7", S + f"""SELECT order_date, daily_revenue,
  AVG(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
  AS rolling_7day_avg FROM {PER_DAY}""")
def q_ts_rolling7(spark, d):
    return windows.rolling7(b.order_facts(spark, d))


@register("ts_daily_full", S + f"""SELECT *, daily_revenue - prev_day_revenue
  AS day_over_day_change, CASE WHEN daily_revenue > prev_day_revenue THEN 'GROWTH'
  WHEN daily_revenue < prev_day_revenue THEN 'DECLINE' ELSE 'STABLE' END AS trend
  FROM (SELECT *, {LAG} AS prev_day_revenue FROM {grouped("order_date", money("daily_revenue"),
                                                         "COUNT(DISTINCT customer_id) AS unique_customers")})""")
def q_ts_daily_full(spark, d):
    return windows.daily_full(b.order_facts(spark, d))


# ------------------------------------------------------------------ rules --

@register("rule_value_class", S + f"""SELECT order_id, quantity, price, {REV} AS revenue,
  CASE WHEN {REV} > {LINE_HIGH_ABOVE} THEN 'HIGH_VALUE' WHEN {REV} >= {LINE_MEDIUM_FROM}
  THEN 'MEDIUM_VALUE' ELSE 'LOW_VALUE' END AS category FROM sales""")
def q_rule_value_class(spark, d):
    s = agg.with_revenue(b.valued_lines(spark, d))
    return s.select("order_id", "quantity", "price", "revenue",
                    rules.value_class("revenue", LINE_HIGH_ABOVE, LINE_MEDIUM_FROM)
                    .alias("category"))


@register("rule_short_class", S + f"""SELECT order_id, {REV} AS revenue,
  CASE WHEN {REV} > {LINE_HIGH_ABOVE} THEN 'HIGH' WHEN {REV} >= {LINE_MEDIUM_FROM}
  THEN 'MEDIUM' ELSE 'LOW' END AS category FROM sales""")
def q_rule_short_class(spark, d):
    s = agg.with_revenue(b.valued_lines(spark, d))
    return s.select("order_id", "revenue",
                    rules.value_class("revenue", LINE_HIGH_ABOVE, LINE_MEDIUM_FROM,
                                      rules.SHORT_LABELS).alias("category"))


@register("rule_segment", S + f"""SELECT customer_id, region, total_revenue,
  CASE WHEN total_revenue >= {CUSTOMER_HIGH_FROM} THEN 'HIGH_VALUE'
       WHEN total_revenue >= {CUSTOMER_MEDIUM_FROM} THEN 'MEDIUM_VALUE'
       ELSE 'LOW_VALUE' END AS customer_segment FROM {PER_CUSTOMER}""")
def q_rule_segment(spark, d):
    t = agg.customer_region(b.order_facts(spark, d))
    return t.select("customer_id", "region", "total_revenue",
                    rules.segment("total_revenue", CUSTOMER_HIGH_FROM, CUSTOMER_MEDIUM_FROM)
                    .alias("customer_segment"))


@register("rep_low_regions", S + f"""SELECT region AS Region,
  CAST(SUM({REV}) AS BIGINT) AS Total_Revenue, CAST(SUM(quantity) AS BIGINT) AS Total_Quantity,
  SUM({REV}) < {REGION_LOW_BELOW} AS low_performing FROM sales GROUP BY region""")
def q_rep_low_regions(spark, d):
    """Quarantine split: one small aggregate, flagged; the two outputs are
    the two filters on the flag."""
    return agg.by_region_multi(b.order_facts(spark, d)).withColumn(
        "low_performing", F.col("Total_Revenue") < F.lit(REGION_LOW_BELOW))
