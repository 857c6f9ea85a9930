"""Ranking, LAG, percent change and rolling windows.

Unpartitioned windows (``Window.orderBy`` only) move their input into one
task.  They are applied here only to aggregates whose size is bounded by a
domain, not by data volume: the daily aggregate (one row per calendar day)
and the product aggregate (one row per product type).  Ranking inside a
group whose size grows with the data (customers of a region) goes through
``rank_within``, which never puts a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.operators import aggregate as agg
from ledgerline.session import checkpoint_dir, materialise


# ---------------------------------------------------------------- ranking --

def product_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product").agg(agg.measures(sales)[0].alias("total_revenue"))


def rank_products(sales: DataFrame) -> DataFrame:
    """RANK and ROW_NUMBER of products by revenue (ties: product name)."""
    w = Window.orderBy(F.desc("total_revenue"))
    w_rn = Window.orderBy(F.desc("total_revenue"), "product")
    return (product_revenue(sales)
            .select("product", "total_revenue",
                    F.rank().over(w).cast("bigint").alias("revenue_rank"),
                    F.row_number().over(w_rn).cast("bigint").alias("row_number_rank")))


def rank_compare(sales: DataFrame) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER side by side.  The product aggregate
    is one row per product type (a bounded domain), so a window without
    partition is the right plan."""
    pr = product_revenue(sales)
    w = Window.orderBy(F.desc("total_revenue"))
    w_rn = Window.orderBy(F.desc("total_revenue"), "product")
    return pr.select("product", "total_revenue",
                     F.rank().over(w).cast("bigint").alias("rank_value"),
                     F.dense_rank().over(w).cast("bigint").alias("dense_rank_value"),
                     F.row_number().over(w_rn).cast("bigint").alias("row_number_value"))


def value_positions(values: DataFrame, group_cols: list[str], order_col: str,
                    weight: str, descending: bool = False,
                    partitions: int | None = None) -> DataFrame:
    """For rows that are one distinct (group, value) each with a weight
    (a row count), the interval [start, end) that the value's rows take in
    the group's sorted order, for groups of any size.

    The rows are range-partitioned on (group, value), so each task holds a
    contiguous slice of the sort order and a large group spans many tasks.
    The slice id is stored and the slicing checkpointed into the shared
    checkpoint folder (fixed, survives lost executors).  A running sum
    inside each (slice, group) plus the totals of the group's earlier slices
    (one row per slice and group) give the interval."""
    spark = values.sparkSession
    checkpoint_dir(spark)
    v = F.col(order_col)
    ordered = v.desc() if descending else v.asc()
    keys = [*[F.col(c) for c in group_cols], ordered]
    # without an explicit count AQE may merge adjacent range partitions of
    # small data: slices stay contiguous in sort order, and the checkpoint
    # fixes the slice ids whatever their number
    ranged = (values.repartitionByRange(partitions, *keys) if partitions
              else values.repartitionByRange(*keys))
    sliced = ranged.withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True)
    in_slice = Window.partitionBy("_slice", *group_cols).orderBy(ordered).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumn("_run", F.sum(weight).over(in_slice))
    totals = sliced.groupBy("_slice", *group_cols).agg(F.sum(weight).alias("_tot"))
    earlier = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(earlier), F.lit(0)))
    # null-safe on the group columns: a NULL group is a group, as in a window
    offs = offsets.select("_slice", *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)],
                          "_off")
    cond = [local["_slice"] == offs["_slice"]] + \
        [local[c].eqNullSafe(offs[f"_g{i}"]) for i, c in enumerate(group_cols)]
    return (local.join(offs, cond)
            .select(*[local[c] for c in group_cols], local[order_col], local[weight],
                    (F.col("_off") + F.col("_run") - local[weight]).alias("start"),
                    (F.col("_off") + F.col("_run")).alias("end")))


def rank_within(df: DataFrame, group_cols: list[str], order_col: str,
                descending: bool = True, out: str = "rank", dense: bool = False,
                partitions: int | None = None) -> DataFrame:
    """RANK() (or DENSE_RANK()) OVER (PARTITION BY group ORDER BY order_col)
    for groups of any size: ties collapse first (one row per (group, value)
    with its row count, a partial aggregate, so a hot value costs nothing
    extra); ``value_positions`` places each value; rank = start + 1 (dense:
    weight 1 per value); the rank joins back to the rows on (group, value)."""
    weight = F.lit(1).cast("bigint") if dense else F.count(F.lit(1))
    values = df.groupBy(*group_cols, order_col).agg(weight.alias("_n"))
    pos = value_positions(values, group_cols, order_col, "_n", descending, partitions)
    ranked = pos.select(*group_cols, order_col, (F.col("start") + 1).cast("bigint").alias(out))
    # NULL order values form one tie, last for DESC / first for ASC, as RANK does
    keys = [*group_cols, order_col]
    return (df.join(ranked, [df[c].eqNullSafe(ranked[c]) for c in keys], "inner")
            .select(df["*"], ranked[out]))


def rank_in_region(sales: DataFrame) -> DataFrame:
    """Customers ranked by revenue within their region, all rows.  A region
    holds a fifth of all customers, so the rank goes through ``rank_within``,
    which reads its input twice: the totals are written once, so the fact
    joins run once."""
    totals = materialise(sales.groupBy("customer_id", "region").agg(
        agg.measures(sales)[0].alias("total_revenue")), "customer_totals")
    return (rank_within(totals, ["region"], "total_revenue", out="rank_in_region")
            .select("customer_id", "region", "total_revenue", "rank_in_region")
            .orderBy("region", "rank_in_region", "customer_id"))


def top_rank_per_group(df: DataFrame, group_cols: list[str], order_col: str, k: int,
                       out: str = "rank") -> DataFrame:
    """Rows with RANK() <= k per group (ties kept).  Catalyst plans the
    filter as WindowGroupLimit, which also runs a partial limit before the
    shuffle, so each task sends at most k rows (plus ties) per group."""
    w = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy(F.desc(order_col))
    return (df.withColumn(out, F.rank().over(w).cast("bigint"))
            .where(F.col(out) <= k))


def top2_customers_per_region(sales: DataFrame, k: int = 2) -> DataFrame:
    totals = agg.customer_region(sales)
    return (top_rank_per_group(totals, ["region"], "total_revenue", k, "rank_in_region")
            .select("customer_id", "region", "total_revenue", "order_count", "rank_in_region")
            .orderBy("region", "rank_in_region", "customer_id"))


def top3_products(sales: DataFrame, k: int = 3) -> DataFrame:
    return (top_rank_per_group(product_revenue(sales), [], "total_revenue", k, "revenue_rank")
            .select("product", "total_revenue", "revenue_rank")
            .orderBy("revenue_rank", "product"))


def top_customer_per_region(sales: DataFrame, high: float = rules.SEGMENT_HIGH_FROM,
                            medium: float = rules.SEGMENT_MEDIUM_FROM) -> DataFrame:
    """ROW_NUMBER() = 1 per region (ties: smallest customer_id), written as
    one aggregate: ``min_by`` over (-revenue, customer_id) merges partial
    results, so a region with a third of all customers is no hot task."""
    totals = agg.customer_region(sales)
    # ascending (revenue is NULL, -revenue, id) = revenue DESC NULLS LAST, id ASC
    order = F.struct(F.col("total_revenue").isNull().alias("n"),
                     (-F.col("total_revenue")).alias("r"), F.col("customer_id").alias("c"))
    best = F.min_by(F.struct("customer_id", "total_revenue", "order_count"), order)
    return (totals.groupBy("region").agg(best.alias("b"))
            .select("region", F.col("b.customer_id").alias("top_customer"),
                    F.col("b.total_revenue").alias("total_revenue"),
                    F.col("b.order_count").alias("order_count"))
            .withColumn("customer_segment", rules.segment("total_revenue", high, medium))
            .orderBy("region"))


# ------------------------------------------------------------ time series --

def daily_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("order_date").agg(agg.measures(sales)[0].alias("daily_revenue"))


def _by_day():
    return Window.orderBy("order_date")


def _pct(change: Column, prev: Column) -> Column:
    """round(change / prev * 100, 2); NULL when prev is NULL or 0."""
    return F.round(F.try_divide(change, prev) * 100, 2)


def with_previous(daily: DataFrame, value: str = "daily_revenue") -> DataFrame:
    """One LAG column, reused by every expression that needs it.  The daily
    series has one row per calendar day, a bounded domain, so the window
    over it is the plan."""
    return (daily.withColumn("previous_day_revenue", F.lag(value, 1).over(_by_day()))
            .withColumn("day_over_day_change", F.col(value) - F.col("previous_day_revenue")))


def lag_daily(sales: DataFrame) -> DataFrame:
    return (with_previous(daily_revenue(sales))
            .select("order_date", "daily_revenue", "previous_day_revenue")
            .orderBy("order_date"))


def trend_stable(sales: DataFrame) -> DataFrame:
    return (with_previous(daily_revenue(sales))
            .withColumn("trend", rules.trend_stable("day_over_day_change"))
            .orderBy("order_date"))


def pct_change(sales: DataFrame) -> DataFrame:
    """Percent change, first day removed."""
    return (with_previous(daily_revenue(sales))
            .where(F.col("previous_day_revenue").isNotNull())
            .select("order_date", "daily_revenue", "previous_day_revenue",
                    _pct(F.col("day_over_day_change"), F.col("previous_day_revenue"))
                    .alias("percent_change"))
            .orderBy("order_date"))


def trend_na(sales: DataFrame) -> DataFrame:
    """Percent change with arrow trend; the first day is kept as N/A."""
    return (with_previous(daily_revenue(sales))
            .withColumn("percent_change",
                        _pct(F.col("day_over_day_change"), F.col("previous_day_revenue")))
            .withColumn("trend", rules.trend_arrow("day_over_day_change"))
            .select("order_date", "daily_revenue", "previous_day_revenue",
                    "day_over_day_change", "percent_change", "trend")
            .orderBy("order_date"))


def rolling7(sales: DataFrame) -> DataFrame:
    """AVG over the current and 6 preceding ROWS (7 rows, not 7 days)."""
    w = _by_day().rowsBetween(-6, 0)
    return (daily_revenue(sales).withColumn("rolling_7day_avg", F.avg("daily_revenue").over(w))
            .orderBy("order_date"))


def daily_full(sales: DataFrame) -> DataFrame:
    """Daily revenue, distinct customers, previous day, change, trend."""
    return (with_previous(agg.daily_customers(sales))
            .withColumnRenamed("previous_day_revenue", "prev_day_revenue")
            .withColumn("trend", rules.trend_stable("day_over_day_change"))
            .select("order_date", "daily_revenue", "unique_customers", "prev_day_revenue",
                    "day_over_day_change", "trend")
            .orderBy("order_date"))
