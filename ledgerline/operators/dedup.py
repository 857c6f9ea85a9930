"""Duplicate rows: list, count, drop.

Exact, and cheap on wide rows (long texts):

1. every row gets a 128-bit fingerprint (two seeded xxhash64); only the
   fingerprints are shuffled, counted where they are read first, to find the
   ones that occur more than once;
2. the repeated fingerprints set bits of one bounded Bloom filter, which every
   task tests on its own rows: a row that misses it is unique and never moves;
3. the rows that pass are compared on their real columns (NULL equals NULL),
   so neither a hash collision nor a false hit of the filter changes a result.

That pays off when rows are wide (texts): pass ``fingerprints=True``.  For
narrow rows the plain exact plan (group by the columns themselves) moves
about as many bytes with one pass less, and is the default.

No join is on a row's value, so a value that fills a third of the table never
meets in one task: counts and first rows are partial aggregates, the filter
is broadcast, and a duplicate is a row that is not the first of its value, an
anti join on the row's own order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as T
from ledgerline.session import input_bytes

_SEEDS = (11, 29)


def fingerprint(columns: list[str]) -> list[Column]:
    return [F.xxhash64(F.lit(s), *[T.column(c) for c in columns]).alias(f"_h{i}")
            for i, s in enumerate(_SEEDS)]


# the filter's bits, as a power of two: at most 2 ** (FILTER_BITS - 6) rows of
# 64 bits each are broadcast, whatever the input
FILTER_BITS = 23


def repeated_keys_filter(keys: DataFrame) -> DataFrame:
    """The Bloom filter of the rows of ``keys``: one row with all of its words,
    an array of longs."""
    at = F.pmod(F.xxhash64(*[F.col(c) for c in keys.columns]), F.lit(1 << FILTER_BITS))
    words = keys.sparkSession.range(1 << FILTER_BITS >> 6).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    hit = (keys.select(F.shiftright(at, 6).alias("_word"), at.bitwiseAND(63).cast("int").alias("_bit"))
           .select("_word", F.expr("shiftleft(1L, _bit)").alias("_bits")))
    held = words.unionByName(hit).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return held.agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_words")).select("_words._bits")


def maybe_repeated(rows: DataFrame, keys: DataFrame, hit: bool = True) -> DataFrame:
    """Rows whose values of the columns of ``keys`` hit (or miss) the filter
    of ``keys``; all rows whose key is in ``keys`` hit it.  Rows stay where
    they are: only the bounded filter is sent out, as a scalar."""
    at = F.pmod(F.xxhash64(*[F.col(c) for c in keys.columns]), F.lit(1 << FILTER_BITS))
    words = repeated_keys_filter(keys).scalar()
    bits = F.get(words, F.shiftright(at, 6).cast("int"))
    found = F.call_function("shiftright", bits, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1
    return rows.where(found if hit else ~found)


def _repeated(h: DataFrame) -> DataFrame:
    """Fingerprints that occur more than once."""
    return (h.groupBy("_h0", "_h1").agg(F.count(F.lit(1)).alias("_c"))
            .where(F.col("_c") > 1).select("_h0", "_h1"))


def _candidates(df: DataFrame, columns: list[str], extra: list[str] | None = None) -> DataFrame:
    """Rows (columns + extra) whose fingerprint may occur more than once:
    all that do, and few others."""
    h = df.select(*[T.column(c) for c in (extra or []) + columns], *fingerprint(columns))
    return maybe_repeated(h, _repeated(h))


def duplicate_rows(df: DataFrame, columns: list[str], order_col: str,
                   fingerprints: bool = False) -> DataFrame:
    """Rows equal (NULL equals NULL) on ``columns`` to a row with a smaller
    ``order_col``; the first occurrence is not listed.  Rows that share an
    ``order_col`` are told apart by their fingerprints."""
    cols = [T.column(c) for c in columns]
    rows = _candidates(df, columns, [order_col]) if fingerprints else \
        df.select(T.column(order_col), *cols, *fingerprint(columns))
    first = (rows.groupBy("_h0", "_h1", *cols).agg(F.min(T.column(order_col)).alias("_first"))
             .select(F.col("_h0").alias("_f0"), F.col("_h1").alias("_f1"), "_first"))
    cond = [T.column(order_col) == F.col("_first"), F.col("_h0") == F.col("_f0"), F.col("_h1") == F.col("_f1")]
    return (rows.where(T.column(order_col).isNotNull()).join(first, cond, "left_anti")
            .select(T.column(order_col), *cols))


def duplicate_count(df: DataFrame, columns: list[str] | None = None,
                    fingerprints: bool = False) -> DataFrame:
    """total rows, distinct rows, duplicate rows, in one row."""
    cols = columns or df.columns
    if not fingerprints:
        per = df.groupBy(*[T.column(c) for c in cols]).agg(F.count(F.lit(1)).alias("c"))
        return per.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("total_rows"),
                       F.count(F.lit(1)).alias("distinct_rows"),
                       F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint")
                       .alias("duplicate_rows"))
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    per = _candidates(df, cols).groupBy(
        "_h0", "_h1", *[T.column(c) for c in cols]).agg(F.count(F.lit(1)).alias("c"))
    more = per.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    from ledgerline.operators.reconcile import one_row
    out = one_row({"total_rows": total, "duplicate_rows": more})
    return out.select("total_rows", (F.col("total_rows") - F.col("duplicate_rows")).alias("distinct_rows"),
                      "duplicate_rows")


# bytes of the files under a frame per task that holds its distinct rows, and
# the most tasks that this asks for by itself
BYTES_PER_TASK = 8 * 1024 * 1024
MOST_TASKS = 100_000


def distinct_tasks(df: DataFrame) -> int:
    """In how many tasks the distinct rows of ``df`` are held: in proportion
    to its input files, and not fewer than the session's shuffles have."""
    asked = min(MOST_TASKS, -(-input_bytes(df) // BYTES_PER_TASK))
    return max(1, asked, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def drop_duplicates(df: DataFrame, columns: list[str] | None = None,
                    fingerprints: bool = False, mostly_distinct: bool = False) -> DataFrame:
    """One row per distinct value of ``columns`` (all columns by default).
    With fingerprints, rows with a unique fingerprint pass through without a
    shuffle of their content; only candidate rows are deduplicated exactly.

    ``mostly_distinct``: rows of which few are equal are dealt by their value
    to ``distinct_tasks`` tasks before any are held.  Otherwise every task of
    the stage above holds all of its own rows, and Spark sizes those tasks by
    compressed bytes, of which such rows take few."""
    if columns and set(columns) != set(df.columns):
        return df.dropDuplicates(columns)    # keeps one whole row per key: Spark's own
    if mostly_distinct:
        df = df.repartition(distinct_tasks(df), *[T.column(c) for c in df.columns])
    if not fingerprints:
        return df.dropDuplicates()
    cols = df.columns
    h = df.select(*[T.column(c) for c in cols], *fingerprint(cols))
    again = _repeated(h)
    # rows that miss the filter are unique and never move
    unique = maybe_repeated(h, again, hit=False).select(*[T.column(c) for c in cols])
    several = maybe_repeated(h, again).select(*[T.column(c) for c in cols]).dropDuplicates()
    return unique.unionByName(several)
