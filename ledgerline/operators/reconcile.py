"""Reconciliation checks: counts and measures before and after a step,
key checks (unique, not null, foreign key), numeric agreement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import aggregate as agg


def labelled_counts(frames: dict[str, DataFrame], label: str = "table_name",
                    value: str = "row_count") -> DataFrame:
    """UNION ALL of one labelled COUNT(*) per frame."""
    parts = [f.agg(F.lit(name).alias(label), F.count(F.lit(1)).alias(value))
             for name, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def labelled_sums(frames: dict[str, DataFrame], label: str = "source",
                  value: str = "total_revenue") -> DataFrame:
    parts = [f.agg(F.lit(name).alias(label), F.sum(agg.revenue()).alias(value))
             for name, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def one_row(parts: dict[str, DataFrame]) -> DataFrame:
    """Side-by-side scalars from one-row, one-column frames: a UNION ALL
    then one conditional aggregate, so no join of any kind is planned."""
    tagged = [f.select(F.lit(n).alias("_k"), F.col(f.columns[0]).cast("bigint").alias("_v"))
              for n, f in parts.items()]
    u = reduce(DataFrame.unionByName, tagged)
    return u.agg(*[F.max(F.when(F.col("_k") == n, F.col("_v"))).alias(n) for n in parts])


def product_of_counts(*names: str) -> Column:
    """Product of count columns as DECIMAL(38,0): three tables of 10^9 rows
    pass the BIGINT range; beyond 38 digits ANSI mode raises an error."""
    wide = [F.col(n).cast("decimal(38,0)") for n in names]
    return reduce(lambda a, b: (a * b).cast("decimal(38,0)"), wide)


def group_loss(df: DataFrame, key: str) -> DataFrame:
    """Row count vs the sum of per-group counts, with a match flag."""
    per_group = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    return (one_row({"total_rows": df.agg(F.count(F.lit(1))),
                     "aggregated_rows": per_group.agg(F.sum("c"))})
            .withColumn("rows_match", F.col("total_rows") == F.col("aggregated_rows")))


def fanout(orders: DataFrame, customers: DataFrame, items: DataFrame,
           joined: DataFrame) -> DataFrame:
    """Cartesian row count (from factor counts) against the keyed join."""
    out = one_row({n: f.agg(F.count(F.lit(1))) for f, n in
                   ((orders, "orders"), (customers, "customers"), (items, "items"),
                    (joined, "joined_rows"))})
    return out.select(
        product_of_counts("orders", "customers", "items").alias("cartesian_product_rows"),
        "joined_rows", F.col("items").alias("order_items_rows"),
        (F.col("joined_rows") == F.col("items")).alias("join_preserves_rows"))


def order_revenue_check(items: DataFrame, joined: DataFrame) -> DataFrame:
    """Revenue per order straight from the items beside that of the joined
    rows.  A full outer join: an order that one side lost is listed, with
    ``revenue_matches`` false."""
    def total(df, name):
        return df.groupBy("order_id").agg(F.sum(agg.revenue()).alias(name))
    return (total(items, "expected_revenue")
            .join(total(joined, "actual_revenue"), "order_id", "full_outer")
            .withColumn("revenue_matches",
                        F.col("expected_revenue").eqNullSafe(F.col("actual_revenue"))))


def duplicate_keys(df: DataFrame, key: str, name: str = "occurrence_count") -> DataFrame:
    """Keys that occur more than once, with their count (GROUP BY ... HAVING)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
            .where(F.col(name) > 1).orderBy(key))


def null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNull())


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (foreign-key check)."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def allclose(a: DataFrame, b: DataFrame, key: str, col_a: str, col_b: str,
             rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """``numpy.allclose`` over every row, paired by key with a full outer
    join: |a - b| <= atol + rtol * |b|, exact equality (equal infinities),
    NaN and a row missing on one side fail."""
    j = a.select(key, F.col(col_a).alias("_a")).join(
        b.select(key, F.col(col_b).alias("_b")), key, "full_outer")
    x, y = F.col("_a"), F.col("_b")
    ok = F.coalesce(((x == y) | (F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y)))
                    & ~F.isnan(x) & ~F.isnan(y), F.lit(False))
    return j.agg(F.count(F.lit(1)).alias("rows_compared"),
                 F.count_if(~ok).alias("rows_different"),
                 F.bool_and(ok).alias("all_close"))


def row_check(df: DataFrame) -> DataFrame:
    """Stored revenue beside the recomputed one, with the comparison."""
    return df.select("order_id", "quantity", "price",
                     agg.revenue().alias("calculated_revenue"),
                     (agg.revenue() == agg.revenue()).alias("validation_check"))
