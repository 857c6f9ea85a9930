"""Equi joins, anti joins and join-count checks.

No hints on the large sides: the planner broadcasts only from statistics
and AQE only from measured runtime sizes.  Anti joins are written as
``left_anti`` (Catalyst keeps ``LEFT JOIN ... WHERE right.key IS NULL`` as
an outer join plus a filter).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import aggregate as agg


def orders_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return (orders.join(customers.select("customer_id", "customer_name", "region"),
                        "customer_id")
            .select("order_id", "order_date", "customer_id", "customer_name", "region"))


def orders_customers_items(orders: DataFrame, customers: DataFrame,
                           items: DataFrame) -> DataFrame:
    """Line-grain three-table join with row revenue."""
    oc = orders.join(customers.select("customer_id", "customer_name", "region"), "customer_id")
    return (oc.join(items, "order_id")
            .select("order_id", "order_date", "customer_name", "region", "product",
                    "quantity", "price", agg.revenue().alias("revenue"))
            .orderBy("order_id", "product", "quantity", "price"))


def orders_without_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers.select("customer_id"), "customer_id", "left_anti") \
        .select("order_id", "customer_id", "order_date")


def customers_without_order(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return customers.join(orders.select("customer_id"), "customer_id", "left_anti") \
        .select("customer_id", "customer_name", "region")


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items.select("order_id"), "order_id", "left_anti") \
        .select("order_id", "customer_id", "order_date")


def cross_count(*frames: DataFrame) -> DataFrame:
    """Row count of the cartesian product, from the factor counts: the same
    number without forming a single pair.  One global aggregate per factor;
    the one-row results are combined in one projection."""
    from ledgerline.operators.reconcile import one_row, product_of_counts
    out = one_row({f"n{i}": f.agg(F.count(F.lit(1))) for i, f in enumerate(frames)})
    return out.select(product_of_counts(*out.columns).alias("cartesian_product_rows"))


def region_revenue(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per region over the three-table join.  Items are summed per
    order first (valid for SUM over an inner join), so the line-grain data is
    shuffled once, narrow, instead of through two joins."""
    per_order = items.groupBy("order_id").agg(F.sum(agg.revenue()).alias("rev"))
    per_customer = (orders.select("order_id", "customer_id").join(per_order, "order_id")
                    .groupBy("customer_id").agg(F.sum("rev").alias("rev")))
    return (per_customer.join(customers.select("customer_id", "region"), "customer_id")
            .groupBy("region").agg(F.sum("rev").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "region"))


def cross_preview(frames: list[tuple[DataFrame, list[str]]], n: int = 20) -> DataFrame:
    """The first ``n`` rows, in lexicographic order of the given sort
    columns, of the cartesian product of the frames (the comma-join preview)
    without forming the product: a row among the first n of the product can
    only use an element ranked <= n in every factor.  So each factor is cut
    to its top n (distributed top-k), gathered as an array of at most n
    structs, and the arrays are exploded one after another: at most n^k
    rows, however big the tables are, and no join of any kind."""
    arrays = []
    for i, (f, cols) in enumerate(frames):
        top = f.select(*cols).orderBy(*cols).limit(n)
        arrays.append(top.agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(f"a{i}")))
    from ledgerline.operators.quality import _side_by_side
    out = _side_by_side(*arrays)
    for i in range(len(frames)):
        out = out.withColumn(f"e{i}", F.explode(f"a{i}")).drop(f"a{i}")
    out = out.select(*[F.col(f"e{i}.{c}").alias(c) for i, (_, cols) in enumerate(frames)
                       for c in cols])
    order = [c for _, cols in frames for c in cols]
    return out.orderBy(*order).limit(n)
