"""Revenue aggregates.  Every group-by here is a hash aggregate with a
map-side partial phase, so a hot key is collapsed before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def revenue(quantity: str = "quantity", price: str = "price") -> Column:
    """Row revenue; BIGINT before multiplying (INT*INT overflows under ANSI)."""
    return F.col(quantity).cast("bigint") * F.col(price).cast("bigint")


def measures(df: DataFrame) -> tuple[Column, Column, Column]:
    """(revenue sum, row count, quantity sum) aggregate expressions.  A
    line-grain frame sums ``quantity * price`` and counts rows; a
    pre-aggregated fact frame (columns _revenue, _lines, _quantity) sums
    those.  Both give the same numbers and types."""
    if "_lines" in df.columns:
        return F.sum("_revenue"), F.sum("_lines"), F.sum("_quantity")
    return F.sum(revenue()), F.count(F.lit(1)), F.sum("quantity")


def with_revenue(df: DataFrame, name: str = "revenue", quantity: str = "quantity",
                 price: str = "price") -> DataFrame:
    """Adds the row revenue.  Fractional columns (typed CSV files) keep their
    fractions; the others multiply as BIGINT."""
    kinds = dict(df.dtypes)
    if any(kinds[c] in ("float", "double") or kinds[c].startswith("decimal") for c in (quantity, price)):
        return df.withColumn(name, F.col(quantity) * F.col(price))
    return df.withColumn(name, revenue(quantity, price))


def total(df: DataFrame) -> DataFrame:
    """SUM(quantity*price) AS total_revenue, COUNT(*) AS total_orders."""
    rev, cnt, _ = measures(df)
    return df.agg(rev.alias("total_revenue"), cnt.alias("total_orders"))


def average(df: DataFrame) -> DataFrame:
    """Average order value, as AVG and as SUM/COUNT."""
    rev, cnt, _ = measures(df)
    # AVG skips rows whose revenue is NULL; SUM / COUNT(*) does not.
    valued = F.sum("_valued") if "_valued" in df.columns else F.count(revenue())
    return df.agg(F.try_divide(rev, valued).alias("avg_order_value"),
                  F.try_divide(rev, cnt).alias("avg_order_value_manual"))


def by_region(df: DataFrame) -> DataFrame:
    rev, cnt, _ = measures(df)
    return (df.groupBy("region")
            .agg(rev.alias("total_revenue"), cnt.alias("order_count"))
            .orderBy(F.desc("total_revenue"), "region"))


def by_product(df: DataFrame) -> DataFrame:
    rev, cnt, qty = measures(df)
    return (df.groupBy("product")
            .agg(rev.alias("total_revenue"), qty.alias("total_quantity_sold"),
                 cnt.alias("order_count"))
            .orderBy(F.desc("total_revenue"), "product"))


def by_region_multi(df: DataFrame) -> DataFrame:
    """Region summary with the reference's renamed columns."""
    rev, _, qty = measures(df)
    return (df.groupBy("region")
            .agg(rev.alias("Total_Revenue"), qty.alias("Total_Quantity"))
            .withColumnRenamed("region", "Region")
            .orderBy(F.desc("Total_Revenue"), "Region"))


def daily(df: DataFrame) -> DataFrame:
    rev, cnt, _ = measures(df)
    return (df.groupBy("order_date")
            .agg(rev.alias("daily_revenue"), cnt.alias("daily_orders"))
            .orderBy("order_date"))


def filtered_region(df: DataFrame, region: str) -> DataFrame:
    """Filter then group."""
    rev, _, _ = measures(df)
    return (df.where(F.col("region") == region).groupBy("region")
            .agg(rev.alias("total_revenue")))


def customer_region(df: DataFrame) -> DataFrame:
    rev, cnt, _ = measures(df)
    return (df.groupBy("customer_id", "region")
            .agg(rev.alias("total_revenue"), cnt.alias("order_count")))


def region_average(df: DataFrame) -> DataFrame:
    """Average order value per region from the region aggregate."""
    return (by_region(df)
            .withColumn("avg_order_value", F.col("total_revenue") / F.col("order_count"))
            .orderBy(F.desc("total_revenue"), "region"))


def daily_customers(df: DataFrame) -> DataFrame:
    """Daily revenue and exact distinct customers per day."""
    rev, _, _ = measures(df)
    return (df.groupBy("order_date")
            .agg(rev.alias("daily_revenue"),
                 F.count_distinct("customer_id").alias("unique_customers"))
            .orderBy("order_date"))


def items_ratio(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, items and items per order over the inner join."""
    j = orders.select("order_id").join(items.select("order_id"), "order_id")
    return j.agg(F.lit("Orders to Order Items").alias("relationship"),
                 F.count_distinct("order_id").alias("orders"),
                 F.count("order_id").alias("order_items"),
                 F.try_divide(F.count("order_id"), F.count_distinct("order_id"))
                 .alias("avg_items_per_order"))


def order_items_summary(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item count and revenue per order.  Items are pre-aggregated per order
    before the join (same result for SUM/COUNT, one order-grain shuffle)."""
    per_order = (items.groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("item_count"),
                      F.sum(revenue()).alias("order_revenue")))
    return (orders.select("order_id").join(per_order, "order_id")
            .orderBy("order_id"))


def skip_missing(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """pandas ``groupby(key)[value].sum()``: missing values skipped, a group
    of only missing values sums to 0, rows with a missing key form no group."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.coalesce(F.sum(value), F.lit(0)).alias(name))
            .orderBy(key))


def pipeline_summary(grouped: DataFrame, key: str, value: str,
                     count: str | None = None) -> DataFrame:
    """One summary row over a grouped frame in a single aggregate: group
    count, total, mean per group, best group (ties: smallest key); with a
    per-group row ``count`` also the record count and the mean per record."""
    v, k = F.col(value), F.col(key)
    order = F.when(v.isNotNull(), F.struct((-v).alias("neg"), k.alias("k")))
    per_record = []
    if count:
        per_record = [F.coalesce(F.sum(count), F.lit(0)).alias("record_count"),
                      F.try_divide(F.sum(v), F.sum(count)).alias("mean_per_record")]
    return grouped.agg(
        *per_record,
        F.count(F.lit(1)).alias("group_count"),
        F.coalesce(F.sum(v), F.lit(0)).alias("total"),
        F.avg(v).alias("mean_per_group"),
        F.min_by(k, order).alias("best_group"),
        F.max(v).alias("best_value"),
        F.format_number(F.coalesce(F.sum(v), F.lit(0)), 2).alias("total_text"))
