"""Registered queries: end-to-end jobs, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import joins
from ledgerline.operators import quality as Q
from ledgerline.plans import jobs
from ledgerline.plans.catalog import (LINE_HIGH_ABOVE, LINE_MEDIUM_FROM, REGION_FILTER,
                                      REGION_LOW_BELOW)
from ledgerline.plans.catalog_quality import CLEAN_USERS_SQL, REPORT_SQL
from ledgerline.plans.oracle import S_CUSTOMERS, S_ITEMS, S_ORDERS, SALES, with_
from ledgerline.session import scratch_path
from ledgerline.sources import bindings as b
from ledgerline.sources import csv as C
from ledgerline.sources import publish
from ledgerline.sources import raw_views as R
from ledgerline.sources import sinks
from ledgerline.sources.tables import read_table

REGISTRY: dict = {}


def register(key, oracle):
    def deco(fn):
        REGISTRY[key] = (fn, oracle)
        return fn
    return deco


S = with_(SALES)
REV = "quantity * price"


# -------------------------------------------------------------------- jobs --

@register("job_clean_sales", S + f"""SELECT DISTINCT * FROM sales
  WHERE region = '{REGION_FILTER}' AND quantity > 1 AND quantity IS NOT NULL""")
def q_job_clean_sales(spark, d):
    return jobs.clean_sales_data(b.sales(spark, d), REGION_FILTER, 1)


for _k, _g in (("product", "product"), ("region", "region")):
    def _mk(g):
        def fn(spark, d):
            return jobs.sales_analytics(b.sales(spark, d))[g]
        return fn
    register(f"job_sales_analytics_{_k}", S + f"""SELECT {_g},
      CAST(COALESCE(SUM({REV}), 0) AS BIGINT) AS total_revenue FROM sales GROUP BY {_g}""")(
        _mk(_k))


@register("job_sales_analytics_top", S + f"""SELECT product,
  CAST(COALESCE(SUM({REV}), 0) AS BIGINT) AS total_revenue FROM sales GROUP BY product
  ORDER BY total_revenue DESC, product LIMIT 2""")
def q_job_sales_analytics_top(spark, d):
    return jobs.sales_analytics(b.sales(spark, d))["top"]


@register("job_sales_analytics_totals", S + f"""SELECT
  CAST(COALESCE(SUM({REV}), 0) AS BIGINT) AS total_revenue,
  AVG({REV}) AS average_order_value FROM sales""")
def q_job_sales_analytics_totals(spark, d):
    return jobs.sales_analytics(b.sales(spark, d))["totals"]


_REGIONAL = S + f""", c AS (SELECT DISTINCT * FROM sales WHERE quantity IS NOT NULL),
 g AS (SELECT region AS Region, CAST(COALESCE(SUM({REV}), 0) AS BIGINT) AS Total_Revenue,
  CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS Total_Quantity FROM c GROUP BY region)
"""


@register("job_regional", _REGIONAL + "SELECT * FROM g")
def q_job_regional(spark, d):
    return jobs.regional_sales(b.sales(spark, d), REGION_LOW_BELOW)["summary"]


@register("job_regional_low", _REGIONAL + f"SELECT * FROM g WHERE Total_Revenue < {REGION_LOW_BELOW}")
def q_job_regional_low(spark, d):
    return jobs.regional_sales(b.sales(spark, d), REGION_LOW_BELOW)["low"]


_CA = S + f""", c AS (SELECT DISTINCT * FROM sales), c2 AS (SELECT *, {REV} AS revenue
  FROM c WHERE quantity IS NOT NULL)
"""


@register("job_clean_aggregate_clean", _CA + "SELECT * FROM c2")
def q_job_clean_aggregate_clean(spark, d):
    return jobs.clean_and_aggregate(b.sales(spark, d))["clean"]


@register("job_clean_aggregate_product", _CA + """SELECT product,
  CAST(COALESCE(SUM(revenue), 0) AS BIGINT) AS total_revenue FROM c2 GROUP BY product""")
def q_job_clean_aggregate_product(spark, d):
    return jobs.clean_and_aggregate(b.sales(spark, d))["product"]


@register("job_clean_aggregate_region", _CA + """SELECT region,
  CAST(COALESCE(SUM(revenue), 0) AS BIGINT) AS total_revenue FROM c2 GROUP BY region""")
def q_job_clean_aggregate_region(spark, d):
    return jobs.clean_and_aggregate(b.sales(spark, d))["region"]


@register("job_rules_arrays", with_(S_ITEMS) + f"""SELECT order_id, price, quantity,
  {REV} AS revenue, CASE WHEN {REV} > {LINE_HIGH_ABOVE} THEN 'HIGH_VALUE'
  WHEN {REV} >= {LINE_MEDIUM_FROM} THEN 'MEDIUM_VALUE' ELSE 'LOW_VALUE' END AS category
  FROM s_items""")
def q_job_rules_arrays(spark, d):
    """The array rules over lines: no table holds arrays of prices, so each
    line gives arrays of one element, and no line moves to make them."""
    arrays = b.order_items(spark, d).select(
        "order_id", F.array("price").alias("prices"), F.array("quantity").alias("quantities"))
    return jobs.vectorized_rules(arrays, LINE_HIGH_ABOVE, LINE_MEDIUM_FROM, keep=["order_id"])


ARRAY_HIGH_ABOVE, ARRAY_MEDIUM_FROM = 6000, 1000


@register("job_rules_array_table", f"""WITH a AS (SELECT vec_id,
  list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 10000) AS BIGINT)) AS prices,
  list_transform(embedding, lambda x, i: CAST((i - 1) % 7 + 1 AS BIGINT)) AS quantities FROM embeddings),
 r AS (SELECT vec_id, list_transform(prices, lambda p, i: p * quantities[i]) AS revenue FROM a),
 c AS (SELECT *, list_transform(revenue, lambda r: CASE WHEN r > {ARRAY_HIGH_ABOVE} THEN 'HIGH_VALUE'
  WHEN r >= {ARRAY_MEDIUM_FROM} THEN 'MEDIUM_VALUE' ELSE 'LOW_VALUE' END) AS category FROM r)
SELECT vec_id, array_to_string(revenue, ';') AS revenue, array_to_string(category, ';') AS category,
  CAST(len(revenue) AS INTEGER) AS items, CAST(list_sum(revenue) AS BIGINT) AS total_revenue,
  CAST(len(list_filter(category, lambda c: c = 'HIGH_VALUE')) AS INTEGER) AS high_items FROM c""")
def q_job_rules_array_table(spark, d):
    """The array kernels over a table's arrays, written as CSV and read back."""
    e = read_table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 10000)).alias("prices"),
        F.transform("embedding", lambda x, i: (i % 7 + 1).cast("bigint")).alias("quantities"))
    out = jobs.array_rules(e, "prices", "quantities", ARRAY_HIGH_ABOVE, ARRAY_MEDIUM_FROM).drop("prices", "quantities")
    path = jobs.array_rules_csv(out, scratch_path(spark, "array_rules"))
    return spark.read.schema("vec_id bigint, revenue string, category string, items int, total_revenue bigint, "
                             "high_items int").option("header", True).csv(path)


@register("job_rules_transactions", S + f"""SELECT order_id AS transaction_id, {REV} AS revenue,
  CASE WHEN {REV} > {LINE_HIGH_ABOVE} THEN 'HIGH' WHEN {REV} >= {LINE_MEDIUM_FROM}
  THEN 'MEDIUM' ELSE 'LOW' END AS category FROM sales""")
def q_job_rules_transactions(spark, d):
    t = b.sales(spark, d).select(F.col("order_id").alias("transaction_id"), "price", "quantity")
    return jobs.business_rules_engine(t, LINE_HIGH_ABOVE, LINE_MEDIUM_FROM)


@register("job_rules_distribution", S + f"""SELECT CASE WHEN {REV} > {LINE_HIGH_ABOVE} THEN 'HIGH'
  WHEN {REV} >= {LINE_MEDIUM_FROM} THEN 'MEDIUM' ELSE 'LOW' END AS category,
  COUNT(*) AS count, CAST(COALESCE(SUM({REV}), 0) AS BIGINT) AS total_revenue
  FROM sales GROUP BY 1""")
def q_job_rules_distribution(spark, d):
    t = b.sales(spark, d).select(F.col("order_id").alias("transaction_id"), "price", "quantity")
    return jobs.category_distribution(
        jobs.business_rules_engine(t, LINE_HIGH_ABOVE, LINE_MEDIUM_FROM))


# ------------------------------------------------------- jobs, file to file --
# Each query writes an ordered CSV export of a whole table, runs the job on the
# files, and reads the published outputs back with the position of every row.

def _export(df, name):
    return sinks.write_csv(df, scratch_path(df.sparkSession, name))


def _published(spark, folder, output, schema):
    rows = spark.read.schema(schema).option("header", True).csv(publish.published(spark, folder)[output])
    return C.with_row_ordinal(rows, "row_number")


_FILE_COLUMNS = ["order_id", "region", "product", "quantity", "price"]
_FILE_SCHEMA = "order_id BIGINT, region STRING, product STRING, quantity BIGINT, price BIGINT"


@register("job_clean_users_file", with_(R.USERS_CTE) + f"""SELECT
  row_number() OVER (ORDER BY CAST(id AS BIGINT)) AS row_number, * FROM ({CLEAN_USERS_SQL})""")
def q_job_clean_users_file(spark, d):
    """The users file cleaned into a file that keeps the order of its rows."""
    src = _export(R.users_raw(spark, d).orderBy(F.col("id").cast("bigint")), "users_csv")
    out = scratch_path(spark, "clean_users_out")
    jobs.run_clean_users(spark, src, out)
    return _published(spark, out, "clean_users", "id STRING, name STRING, age STRING, email STRING")


@register("job_clean_sales_file", S + f"""SELECT
  row_number() OVER (ORDER BY order_id, region, product, quantity, price) AS row_number, * FROM (
  SELECT DISTINCT order_id, region, product, quantity, price FROM sales
  WHERE region = '{REGION_FILTER}' AND quantity > 1)""")
def q_job_clean_sales_file(spark, d):
    """The sales file filtered and without repeated rows, in its own order."""
    src = _export(b.sales(spark, d).select(*_FILE_COLUMNS).orderBy(*_FILE_COLUMNS), "sales_file")
    out = scratch_path(spark, "clean_sales_out")
    jobs.run_clean_sales(spark, src, out, REGION_FILTER, 1, _FILE_SCHEMA)
    return _published(spark, out, "clean_sales", _FILE_SCHEMA)


@register("job_sales_analytics_files", S + f""", p AS (SELECT product AS key,
  CAST(SUM({REV}) AS BIGINT) AS total_revenue FROM sales GROUP BY product)
SELECT 'revenue_per_product' AS output, * FROM p
UNION ALL SELECT 'revenue_per_region', region, CAST(SUM({REV}) AS BIGINT) FROM sales GROUP BY region
UNION ALL SELECT 'top_products', * FROM (SELECT * FROM p ORDER BY total_revenue DESC, key LIMIT 2)""")
def q_job_sales_analytics_files(spark, d):
    """The three files of the sales analytics job, one under another."""
    src = _export(b.sales(spark, d).select(*_FILE_COLUMNS), "sales_file")
    out = scratch_path(spark, "sales_analytics_out")
    jobs.run_sales_analytics(spark, src, out, 2, _FILE_SCHEMA)
    parts = [spark.read.schema("key STRING, total_revenue BIGINT").option("header", True).csv(path)
             .select(F.lit(name).alias("output"), "key", "total_revenue")
             for name, path in publish.published(spark, out).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("job_rules_file", S + f"""SELECT row_number() OVER (ORDER BY order_id, price, quantity) AS row_number,
  order_id AS transaction_id, {REV} AS revenue, CASE WHEN {REV} > {LINE_HIGH_ABOVE} THEN 'HIGH'
  WHEN {REV} >= {LINE_MEDIUM_FROM} THEN 'MEDIUM' ELSE 'LOW' END AS category FROM sales""")
def q_job_rules_file(spark, d):
    """The rule engine from file to file, in the order of the input."""
    t = b.sales(spark, d).select(F.col("order_id").alias("transaction_id"), "price", "quantity")
    src = _export(t.orderBy("transaction_id", "price", "quantity"), "transactions_csv")
    out = scratch_path(spark, "business_rules_out")
    jobs.run_business_rules(spark, src, out, LINE_HIGH_ABOVE, LINE_MEDIUM_FROM,
                            "transaction_id BIGINT, price BIGINT, quantity BIGINT")
    return _published(spark, out, "classified_transactions", "transaction_id BIGINT, revenue BIGINT, category STRING")


def _txn_report(spark, d):
    return Q.quality_report(R.txn_raw(spark, d), R.TXN_COLUMNS, "row_id", "txn_raw", f"{d}/orders.parquet")


@register("dq_report", REPORT_SQL)
def q_dq_report(spark, d):
    """The nested report of the transaction view in long form."""
    return Q.report_lines(_txn_report(spark, d))


# ---------------------------------------------------------- sources, sinks --

def _sales_csv(spark, d):
    """sales written as a header CSV folder under the shared checkpoint
    folder, afresh for each call, so the export is never older than its
    tables."""
    return sinks.write_csv(b.sales(spark, d), scratch_path(spark, "sales_csv"))


@register("src_csv_typed", S + """SELECT *, false AS malformed, 0 AS bad_cells FROM sales""")
def q_src_csv_typed(spark, d):
    path = _sales_csv(spark, d)
    return C.read_csv_typed(spark, path, b.sales(spark, d).schema)


@register("src_csv_raw", S + """SELECT CAST(order_id AS VARCHAR) AS order_id,
  CAST(order_date AS VARCHAR) AS order_date, CAST(customer_id AS VARCHAR) AS customer_id,
  region, product, CAST(quantity AS VARCHAR) AS quantity, CAST(price AS VARCHAR) AS price,
  false AS malformed FROM sales""")
def q_src_csv_raw(spark, d):
    return C.read_csv_raw(spark, _sales_csv(spark, d))


def _audit(spark, d):
    """(path, audit) of the sales CSV export, whose header has a quoted name
    with a comma, an empty file, and a path that does not exist."""
    path = sinks.write_csv(b.sales(spark, d).withColumnRenamed("price", "price, in cents"),
                           scratch_path(spark, "sales_csv"))
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [st.getPath().toString() for st in fs.listStatus(hp)
             if st.getPath().getName().endswith(".csv")]
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/zero_bytes.csv")).close()
    return path, C.load_audit(spark, parts + [f"{path}/zero_bytes.csv", f"{path}/missing_file.csv"])


@register("src_load_audit", S + """SELECT 'part' AS file, true AS success, CAST(NULL AS VARCHAR) AS error,
  CAST(COUNT(*) AS BIGINT) AS row_count,
  'order_id|order_date|customer_id|region|product|quantity|price, in cents' AS columns FROM sales
  UNION ALL SELECT 'zero_bytes.csv', false, 'File is empty: zero_bytes.csv', NULL, NULL
  UNION ALL SELECT 'missing_file.csv', false, 'File not found: missing_file.csv', NULL, NULL""")
def q_src_load_audit(spark, d):
    """Load status of the part files of the sales CSV export (summed up,
    since their names and number vary) and of two paths that do not load."""
    path, audit = _audit(spark, d)
    name = F.element_at(F.split("file_path", "/"), -1)
    file = F.when(name.startswith("part-"), F.lit("part")).otherwise(name)
    error = F.regexp_replace("error", "(: ).*/", "$1")
    return (audit.groupBy(file.alias("file"), "success", error.alias("error"),
                          F.array_join("columns", "|").alias("columns"))
            .agg(F.sum("row_count").alias("row_count"))
            .select("file", "success", "error", "row_count", "columns"))


@register("src_load_audit_totals", S + """SELECT CAST(COUNT(*) AS BIGINT) AS rows_loaded,
  CAST(1 AS BIGINT) AS files_not_found FROM sales""")
def q_src_load_audit_totals(spark, d):
    """The audit of the sales CSV export summed up: rows over the files that
    loaded (= sales rows) and the files not found (the one missing path)."""
    _, a = _audit(spark, d)
    return a.agg(F.coalesce(F.sum(F.when(F.col("success"), F.col("row_count"))), F.lit(0))
                 .cast("bigint").alias("rows_loaded"),
                 F.count_if(F.col("error").startswith("File not found")).alias("files_not_found"))


@register("src_arrays_zip", """SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos,
  CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""")
def q_src_arrays_zip(spark, d):
    e = read_table(spark, d, "embeddings").select(
        "vec_id", F.sequence(F.lit(1), F.size("embedding")).cast("array<bigint>").alias("pos"),
        F.col("embedding").cast("array<double>").alias("value"))
    return jobs.zip_arrays(e, {"pos": "pos", "value": "value"}, keep=["vec_id"])


@register("sink_csv", S + f"""SELECT region AS Region, CAST(SUM({REV}) AS BIGINT) AS Total_Revenue,
  CAST(SUM(quantity) AS BIGINT) AS Total_Quantity FROM sales GROUP BY region""")
def q_sink_csv(spark, d):
    """Region summary written as header CSV and read back: the read-back
    frame must equal the summary."""
    from ledgerline.operators import aggregate as agg
    summ = agg.by_region_multi(b.order_facts(spark, d))
    path = sinks.write_csv(summ, scratch_path(spark, "regional_summary"))
    return sinks.read_back_csv(summ, path)


@register("sink_csv_empty", with_(S_ORDERS, S_CUSTOMERS) + """SELECT o.order_id, o.customer_id,
  o.order_date FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id
  WHERE c.customer_id IS NULL""")
def q_sink_csv_empty(spark, d):
    """Orders without a customer (empty on these tables) written and read
    back: a header-only file, zero rows."""
    empty = joins.orders_without_customer(b.orders(spark, d), b.customers(spark, d))
    path = sinks.write_csv(empty, scratch_path(spark, "orders_without_customer"))
    return sinks.read_back_csv(empty, path)


@register("sink_json_report", REPORT_SQL)
def q_sink_json_report(spark, d):
    """The transaction quality report written as indented JSON, read back
    and put in long form."""
    rep = _txn_report(spark, d)
    path = sinks.report_path(scratch_path(spark, "reports"), "txn_raw")
    sinks.write_json_report(rep, path)
    return Q.report_lines(sinks.read_json_report(rep, path))
