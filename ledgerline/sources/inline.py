"""Inline rows and the random sales generator (library only: these take
made-up input, so no registered query is built on them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values: the generator's ranges (upper bounds exclusive) ----------
PRICE_LOW, PRICE_HIGH = 100, 10000
QUANTITY_LOW, QUANTITY_HIGH = 1, 10
# ---------------------------------------------------------------------------


def values(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """``INSERT INTO t VALUES ...``: literal rows with an explicit schema.
    Dates must be ``datetime.date`` values (text is not cast, as ANSI store
    assignment rejects it)."""
    return spark.createDataFrame(rows, schema)


def random_sales(spark: SparkSession, n: int, seed: int = 42,
                 partitions: int | None = None) -> DataFrame:
    """n rows of (id, price, quantity), price uniform in [100, 10000),
    quantity in [1, 10).  Generated in parallel by ``range``; the seed makes
    a rerun (or a recomputed partition) give the same rows."""
    r = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    return r.select(
        "id",
        (F.floor(F.rand(seed) * (PRICE_HIGH - PRICE_LOW)) + PRICE_LOW).cast("bigint").alias("price"),
        (F.floor(F.rand(seed + 1) * (QUANTITY_HIGH - QUANTITY_LOW)) + QUANTITY_LOW)
        .cast("bigint").alias("quantity"))
