"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied Parquet tables; projection and filters given later
    are pushed into this scan by Catalyst.  Nothing is remembered between
    calls, so a rewritten table is read as it is now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
