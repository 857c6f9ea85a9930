"""Sinks: CSV with header, JSON report."""

from __future__ import annotations

import datetime as dt
import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_NAME = "quality_report_{file}_{stamp}.json"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header + rows, column order kept.  The target is a folder of part
    files written in parallel; an empty frame still writes a header-only
    part file, so a downstream reader sees the columns.  Blanks around a
    value are kept (the writer would trim them)."""
    (df.write.mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def read_back_csv(df_schema_source: DataFrame, path: str) -> DataFrame:
    spark = df_schema_source.sparkSession
    return spark.read.schema(df_schema_source.schema).option("header", True).csv(path)


def report_path(folder: str, file_name: str, now: dt.datetime | None = None) -> str:
    stamp = (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    return posixpath.join(folder, REPORT_NAME.format(file=file_name, stamp=stamp))


def write_json_report(report: DataFrame, path: str) -> str | None:
    """Indented JSON of a one-row report (UTF-8 text kept as is).  A report
    whose ``status`` is 'error', or an empty one, is not written (returns
    None).  The report is computed once: its text is one small row, which the
    driver hands on to the writer."""
    cols = report.columns
    keep = report
    if "status" in cols:
        keep = keep.where(F.coalesce(F.col("status") != "error", F.lit(True)))
    row = keep.select(F.to_json(F.struct(*[F.col(c) for c in cols if c != "status"]),
                                {"pretty": "true"}).alias("value")).first()
    if row is None:
        return None
    report.sparkSession.createDataFrame([row], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json_report(report: DataFrame, path: str) -> DataFrame:
    """A written report, read back with the columns of ``report``."""
    return report.sparkSession.read.schema(report.schema).option("multiLine", True).json(path)
