"""The reference's relations bound to the supplied tables.

| relation    | built from                                             |
|-------------|--------------------------------------------------------|
| sales       | lineitem x orders x customer x nation x region x part  |
| customers   | customer x nation x region                             |
| orders      | orders                                                 |
| order_items | lineitem x part                                        |

Money is integer cents (``price = round(p_retailprice * 100)``) so every sum
is exact and independent of the order Spark adds rows in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import read_table


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> region name."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "region")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers(customer_id, customer_name, region); customers whose nation
    has no region are dropped, as by the inner join."""
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"), "c_nationkey")
    nr = nation_regions(spark, sf_dir)
    return (c.join(nr, c.c_nationkey == nr.n_nationkey)
            .select("customer_id", "customer_name", "region"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders(order_id, customer_id, order_date DATE)."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part key -> (product, price in cents)."""
    return read_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_type").alias("product"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items(order_id, product, quantity, price)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"))
    p = products(spark, sf_dir)
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select("order_id", "product", "quantity", "price"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sales(order_id, order_date, customer_id, region, product, quantity,
    price): the reference's line-grain fact table.

    Orders meet customers first, at order grain, then lines meet that on the
    order key, then parts: where nothing fits a broadcast, line rows are
    shuffled twice (order key, part key) instead of three times."""
    o = orders(spark, sf_dir)
    c = customers(spark, sf_dir).select("customer_id", "region")
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"))
    p = products(spark, sf_dir)
    cols = ["order_id", "order_date", "customer_id", "region", "product", "quantity", "price"]
    return (li.join(o.join(c, "customer_id"), "order_id")
            .join(p, F.col("l_partkey") == p.p_partkey).select(*cols))


def docs_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents left join labels: natural missing values (unlabelled
    documents have NULL quality and toxic)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic")


# --------------------------------------------------- pre-aggregated facts --
# Sums and counts over an inner join can be taken below the join: for each
# row of the other side, the pre-aggregated group of its key contributes
# exactly what the matching rows would have.  So the line measures are
# summed per order (or per part) first, and only order-grain (part-grain)
# rows travel through the remaining joins.  Columns: _revenue, _lines,
# _quantity (see ``ledgerline.operators.aggregate.measures``).

def _line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"))
    p = products(spark, sf_dir).select("p_partkey", "price", "product")
    return li.join(p, li.l_partkey == p.p_partkey)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines: (order_id, order_date, customer_id,
    region, _revenue, _lines, _valued, _quantity).  Equal, for any SUM / COUNT /
    COUNT DISTINCT of order, customer, date or region attributes, to the
    same aggregate over ``sales``."""
    per_order = (_line_measures(spark, sf_dir).groupBy("order_id")
                 .agg(F.sum(F.col("quantity") * F.col("price")).alias("_revenue"),
                      F.count(F.lit(1)).alias("_lines"),
                      F.count(F.col("quantity") * F.col("price")).alias("_valued"),
                      F.sum("quantity").alias("_quantity")))
    o = orders(spark, sf_dir)
    c = customers(spark, sf_dir).select("customer_id", "region")
    return (per_order.join(o, "order_id").join(c, "customer_id")
            .select("order_id", "order_date", "customer_id", "region",
                    "_revenue", "_lines", "_valued", "_quantity"))


def valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the orders whose customer, nation and region exist."""
    c = customers(spark, sf_dir).select("customer_id")
    return orders(spark, sf_dir).select("order_id", "customer_id") \
        .join(c, "customer_id", "left_semi").select("order_id")


def valued_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, quantity, price) of every row of ``sales``: of the orders
    and customers only their existence matters, so lines meet the valid
    orders' keys in a semi join, then the parts."""
    return order_items(spark, sf_dir).select("order_id", "quantity", "price") \
        .join(valid_orders(spark, sf_dir), "order_id", "left_semi")


def product_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part with lines in ``sales``: (product, _revenue, _lines,
    _valued, _quantity).

    Lines are kept when their order, customer, nation and region exist (a
    semi join on order key), then summed per part key before the part join:
    a part's price is one value, so its revenue is price x (sum of
    quantities), exact in cents.  Line rows are shuffled twice (order key,
    then part key with a map-side partial sum), and only part-grain rows
    meet the part table."""
    o = orders(spark, sf_dir).select("order_id", "customer_id")
    c = customers(spark, sf_dir).select("customer_id")
    valid = o.join(c, "customer_id").select("order_id")
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"))
    per_part = (li.join(valid, "order_id", "left_semi").groupBy("l_partkey")
                .agg(F.sum("quantity").alias("_q"), F.count(F.lit(1)).alias("_lines"),
                     F.count("quantity").alias("_nq")))
    p = products(spark, sf_dir)
    return (per_part.join(p, per_part.l_partkey == p.p_partkey)
            .select("product", (F.col("_q") * F.col("price")).alias("_revenue"), "_lines",
                    F.when(F.col("price").isNotNull(), F.col("_nq")).otherwise(0).alias("_valued"),
                    F.col("_q").alias("_quantity")))
