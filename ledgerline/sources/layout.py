"""Physical layout for repeated joins: bucketed copies of the fact tables.

Every query that joins lines to orders shuffles both on the order key.  A
one-time rewrite of ``lineitem`` and ``orders`` bucketed (and sorted) by
order key into the same number of buckets lets Spark join them bucket by
bucket with no exchange at all, however large they are.  The copies are
external tables whose files live under the shared checkpoint folder (a
cluster names it; nothing machine-local), registered in the session
catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path
from ledgerline.sources.tables import read_table

DATABASE = "ledgerline"


def bucket_by_order(spark: SparkSession, sf_dir: str, buckets: int,
                    database: str = DATABASE) -> dict[str, str]:
    """Write lineitem (by l_orderkey) and orders (by o_orderkey) bucketed and
    sorted into ``buckets`` buckets; returns the table names."""
    if not spark.catalog.databaseExists(database):
        # located under the shared checkpoint folder, not the local working dir
        spark.sql(f"CREATE DATABASE {database} LOCATION "
                  f"'{scratch_path(spark, 'catalog-' + database)}'")
    out = {}
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        table = f"{database}.{name}_by_order"
        (read_table(spark, sf_dir, name).write.mode("overwrite")
         .option("path", scratch_path(spark, f"bucketed-{name}"))
         .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
        out[name] = table
    return out


def lines_with_orders(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """lineitem x orders on order key from the bucketed copies: a
    bucket-to-bucket sort-merge join, no shuffle of either side."""
    li = spark.table(tables["lineitem"])
    o = spark.table(tables["orders"])
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
