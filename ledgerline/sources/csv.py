"""CSV sources: typed read, text read, and a load audit over many files.

Spark's CSV reader skips blank lines (so the leading blank line of the
reference's sample files is harmless), splits large files across tasks,
and in PERMISSIVE mode keeps a malformed row (too few / too many fields)
and sets the corrupt-record column instead of failing the job.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

# --- fixed values: pandas' default NA words ---------------------------------
PANDAS_NA_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                   "n/a", "nan", "null"]
# --- fixed values: load-audit messages, in the order they are tested --------
AUDIT_NOT_FOUND = "File not found: {path}"
AUDIT_EMPTY = "File is empty: {path}"
AUDIT_PERMISSION = "Permission denied: {path}"
AUDIT_UNREADABLE = "Unexpected error: could not read {path}"
AUDIT_ENCODING = "File encoding error: {path}"
AUDIT_NO_HEADERS = "CSV file has no headers"
AUDIT_NO_ROWS = "CSV file has headers but no data rows"
# ---------------------------------------------------------------------------


def _text_schema(columns: list[str], corrupt: bool = True) -> StructType:
    fields = [StructField(c, StringType(), True) for c in columns]
    if corrupt:
        fields.append(StructField(CORRUPT, StringType(), True))
    return StructType(fields)


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header; only the header is parsed."""
    return spark.read.option("header", True).csv(path).columns


def read_csv_raw(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Every column as STRING (the ``csv.DictReader`` view), plus a
    ``malformed`` flag for rows with too few or too many fields.  A short
    row's missing fields are NULL."""
    cols = columns or header_columns(spark, path)
    df = (spark.read.schema(_text_schema(cols)).option("header", True)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
          .csv(path))
    return df.withColumn("malformed", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def na_to_null(c: Column, na_words: list[str] = PANDAS_NA_WORDS) -> Column:
    return F.when(~F.coalesce(c.isin(na_words), F.lit(False)), c)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType | str,
                   na_words: list[str] = PANDAS_NA_WORDS) -> DataFrame:
    """pandas ``read_csv`` with an explicit schema: NA words become NULL,
    then each column is cast; text that does not cast becomes NULL and is
    counted in ``bad_cells`` (pandas would silently make the column text)."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    cols = [f.name for f in schema.fields]
    raw = read_csv_raw(spark, path, cols)
    typed, bad = [], []
    for f in schema.fields:
        txt = na_to_null(F.col(f.name), na_words)
        val = txt if isinstance(f.dataType, StringType) else txt.try_cast(f.dataType)
        typed.append(val.alias(f.name))
        bad.append(F.when(txt.isNotNull() & val.isNull(), 1).otherwise(0))
    bad_sum = bad[0]
    for x in bad[1:]:
        bad_sum = bad_sum + x
    return raw.select(*typed, "malformed", bad_sum.alias("bad_cells"))


def load_audit(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Load status of many CSV files as one distributed job.

    Per requested path: (file_path, success, error, row_count, columns,
    size_bytes).  Tests, first match wins: not found, empty (0 bytes),
    permission (the listed permission bits grant read to nobody), other
    (nothing could be read), encoding (bytes that are not UTF-8), no
    headers (no non-blank line), headers but no rows, else success.

    * existence and size come from one metadata listing per parent folder
      (Spark's scans leave 0-byte files out, so they cannot tell "empty"
      from "missing");
    * only the requested, existing, non-empty files are scanned, with
      ``ignoreCorruptFiles`` so one unreadable file cannot fail the job: a
      non-empty readable file yields at least one line, so a file with no
      line read is reported as not readable;
    * line counts, invalid UTF-8 lines and the header line come from a
      text scan grouped by ``_metadata.file_path``; the header is the first
      non-blank line by (split start, position in split);
    * data rows come from the CSV reader itself (header skipped per file,
      blank lines skipped, quoted newlines handled).
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    qualified = {p: _qualify(spark, p) for p in paths}
    wanted = set(qualified.values())
    # qualified, so one folder spelled two ways is listed once
    dirs = sorted({_qualify(spark, posixpath.dirname(p) or ".") for p in paths})
    listed = []
    for d in dirs:   # folder metadata only: one listing call per distinct folder
        hp = jvm.org.apache.hadoop.fs.Path(d)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            read = jvm.org.apache.hadoop.fs.permission.FsAction.READ
            for st in fs.listStatus(hp):
                q = st.getPath().toString()
                if st.isFile() and q in wanted:
                    perm = st.getPermission()
                    readable = any(a.implies(read) for a in (
                        perm.getUserAction(), perm.getGroupAction(), perm.getOtherAction()))
                    listed.append((q, st.getLen(), readable))
    manifest = spark.createDataFrame(list(qualified.items()), "file_path string, qpath string")
    listing = spark.createDataFrame(listed, "qpath string, size_bytes bigint, readable boolean")
    found = manifest.join(listing, "qpath", "left")
    existing = found.where(F.col("size_bytes").isNotNull())
    to_scan = sorted({q for q, n, r in listed if n > 0 and r})

    if to_scan:
        text = spark.read.option("ignoreCorruptFiles", True).text(to_scan)
        t = text.select(F.col("_metadata.file_path").alias("qpath"), "value",
                        F.col("_metadata.file_block_start").alias("blk"),
                        F.monotonically_increasing_id().alias("pos"))
        blank = F.regexp_replace("value", r"^\s+|\s+$", "") == ""
        lines = (t.groupBy("qpath").agg(
            F.count(F.lit(1)).alias("all_lines"),
            F.count_if(~blank).alias("nonblank"),
            F.count_if(~F.is_valid_utf8("value")).alias("bad_utf8"),
            F.min_by("value", F.when(~blank, F.struct("blk", "pos"))).alias("header")))
        rows = (spark.read.option("ignoreCorruptFiles", True).schema("_c0 string")
                .option("header", True).csv(to_scan)
                .groupBy(F.col("_metadata.file_path").alias("qpath"))
                .agg(F.count(F.lit(1)).alias("row_count")))
        existing = existing.join(lines, "qpath", "left").join(rows, "qpath", "left")
    else:
        existing = existing.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("all_lines", "bigint"), ("nonblank", "bigint"), ("bad_utf8", "bigint"),
            ("header", "string"), ("row_count", "bigint"))])
    missing = found.where(F.col("size_bytes").isNull())
    msg = lambda tpl: F.replace(F.lit(tpl), F.lit("{path}"), F.col("file_path"))
    status_exist = (
        F.when(F.col("size_bytes") == 0, msg(AUDIT_EMPTY))
        .when(~F.col("readable"), msg(AUDIT_PERMISSION))
        .when(F.coalesce(F.col("all_lines"), F.lit(0)) == 0, msg(AUDIT_UNREADABLE))
        .when(F.coalesce(F.col("bad_utf8"), F.lit(0)) > 0, msg(AUDIT_ENCODING))
        .when(F.coalesce(F.col("nonblank"), F.lit(0)) == 0, F.lit(AUDIT_NO_HEADERS))
        .when(F.coalesce(F.col("row_count"), F.lit(0)) == 0, F.lit(AUDIT_NO_ROWS)))
    ok = existing.select(
        "file_path", status_exist.alias("error"),
        F.coalesce(F.col("row_count"), F.lit(0)).alias("row_count"),
        header_fields("header").alias("columns"), "size_bytes")
    nf = missing.select("file_path", msg(AUDIT_NOT_FOUND).alias("error"),
                        F.lit(None).cast("bigint").alias("row_count"),
                        F.lit(None).cast("array<string>").alias("columns"),
                        F.lit(None).cast("bigint").alias("size_bytes"))
    out = ok.unionByName(nf)
    return out.select("file_path", F.col("error").isNull().alias("success"), "error",
                      F.when(F.col("error").isNull(), F.col("row_count")).alias("row_count"),
                      F.when(F.col("error").isNull(), F.col("columns")).alias("columns"),
                      "size_bytes")


def header_fields(line: Column | str) -> Column:
    """Fields of one CSV header line: a quoted field may hold commas and
    doubled quotes."""
    line = F.col(line) if isinstance(line, str) else line
    fields = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'("(?:[^"]|"")*"[^,]*|[^,]*),'), F.lit(1))
    quoted = r'^"((?:[^"]|"")*)"'
    return F.transform(fields, lambda x: F.when(
        x.rlike(quoted), F.replace(F.regexp_replace(x, quoted, "$1"), F.lit('""'), F.lit('"'))).otherwise(x))


def _qualify(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(conf).makeQualified(hp).toString()


def split_index(df: DataFrame) -> DataFrame:
    """The order index of a frame read from files: per input split (file
    path, block start) its rows, the rows of all earlier splits in the order
    (path, block) and its first row's task position.  One row per split."""
    from pyspark.sql import Window
    rows = df.select(F.col("_metadata.file_path").alias("_path"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_mid"))
    per = rows.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_mid").alias("_first"))
    # rows before a file from per-file totals, then before a block inside its file
    in_file = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = per.groupBy("_path").agg(F.sum("_rows").alias("_rows"))
    earlier = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("_path").alias("_file"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    return (per.withColumn("_inside", F.coalesce(F.sum("_rows").over(in_file), F.lit(0)))
            .join(files, F.col("_path") == F.col("_file"))
            .select("_path", "_block", (F.col("_base") + F.col("_inside") - F.col("_first")).alias("_shift")))


def with_row_ordinal(df: DataFrame, name: str = "row_number") -> DataFrame:
    """1-based position of each row of a frame read from files, over all of
    its files in path order (the reference's data-row number), without moving
    the rows through one task.

    Tasks read splits in no particular order (Spark packs large files first),
    so a row is placed by its split: prefix sums over the order index of
    (file path, block start) and the position inside the split.  The frame
    must come from a file reader, by selections and filters only; filtered
    rows are not counted.  Splits are fixed for a session, so a lost task
    recomputes the same numbers."""
    rows = df.select("*", F.col("_metadata.file_path").alias("_path"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_mid"))
    return (rows.join(split_index(df), ["_path", "_block"])
            .withColumn(name, F.col("_mid") + F.col("_shift") + 1)
            .drop("_path", "_block", "_mid", "_shift"))
