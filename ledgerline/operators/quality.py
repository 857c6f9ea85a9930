"""Column-by-column quality profile of text data, as distributed aggregates.

Plan shape (no driver loops, no collect):

    text rows --unpivot--> (pos, column, value) --group by--> value counts
       value counts --group by column--> missing, distinct, lengths, types,
                                         numeric stats, rule counts
    text rows --one global aggregate--> rows, complete rows
    text rows --group by row key--> duplicate rows

Grouping by (column, value) is a hash aggregate with a map-side partial
phase, so a value that fills a third of a column is counted where it is
read and never gathered in one task.  Every value class, rule and number is
worked out once per distinct value, not once per row.  What reaches the
report is one row per column.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.functions import text as T
from ledgerline.session import materialise, scratch_path

# --- fixed values -----------------------------------------------------------
AMOUNT_WORDS = ["amount", "price", "cost", "total"]
DATE_WORDS = ["date", "time", "timestamp"]
EMAIL_WORD = "email"
NUMERIC_TYPES = ["integer", "float"]
MISSING_ISSUE_PCT = 20           # columns above this missing % are issues
MIXED_TYPE_PCT = 90              # dominant type below this % is "mixed"
LOW_SCORE = 70                   # overall recommendation below this score
WEIGHT_COMPLETE, WEIGHT_UNIQUE, WEIGHT_VALID = 40, 30, 30
RECOMMEND_IMPUTE = "Consider data imputation for columns with >20% missing values: "
RECOMMEND_DUPLICATES = "Remove {n} duplicate rows ({pct}% of total) to improve data quality"
RECOMMEND_MIXED = "Column '{col}' has mixed data types. Consider standardizing to {t}"
RECOMMEND_OVERALL = ("Overall data quality needs improvement. "
                     "Focus on reducing missing values and fixing invalid entries.")
# ---------------------------------------------------------------------------


def rule_family(column: str) -> str | None:
    """The one rule family that applies to a column, from its name (first
    match: email, amount, date, id)."""
    c = column.lower()
    if EMAIL_WORD in c:
        return "email"
    if any(w in c for w in AMOUNT_WORDS):
        return "amount"
    if any(w in c for w in DATE_WORDS):
        return "date"
    if c.endswith("_id") or c == "id":
        return "id"
    return None


def _pct(num: Column, den: Column) -> Column:
    """round(num / den * 100, 2); 0 when den is 0."""
    return F.coalesce(F.round(F.try_divide(num, den) * 100, 2), F.lit(0.0))


def _side_by_side(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row frames in one row: UNION ALL with the
    missing columns NULL, then one ``first(ignorenulls)`` aggregate (a join
    on a constant key would be planned as a nested-loop join)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in u.columns])


# ------------------------------------------------------------ pre-aggregate --

def value_counts(df: DataFrame, columns: list[str], order_col: str | None = None) -> DataFrame:
    """(pos, column, value, n, first_row): one row per distinct stripped
    present value of each column, plus one row per column with value NULL
    counting its missing cells."""
    cells = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                               T.column(c).cast("string").alias("raw"))
                      for i, c in enumerate(columns)])
    order = F.col(order_col) if order_col else F.lit(None).cast("bigint")
    long = df.select(order.alias("_row"), F.inline(cells))
    value = F.when(~T.is_missing_text("raw"), T.py_strip("raw"))
    return (long.select("_row", "pos", "column", value.alias("value"))
            .groupBy("pos", "column", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first_row")))


def cells(df: DataFrame, columns: list[str], order_col: str | None = None) -> DataFrame:
    """The unpivoted cells in the value-counts layout (pos, column, value,
    n = 1, first_row = the row), without grouping.  Feeds the decomposable
    sums (missing cells, rule counts) when grouping by value would shuffle
    long texts; never use it where distinct values are counted."""
    cells_ = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                                T.column(c).cast("string").alias("raw"))
                       for i, c in enumerate(columns)])
    order = F.col(order_col) if order_col else F.lit(None).cast("bigint")
    value = F.when(~T.is_missing_text("raw"), T.py_strip("raw"))
    return (df.select(order.alias("first_row"), F.inline(cells_))
            .select("pos", "column", value.alias("value"), F.lit(1).cast("bigint").alias("n"),
                    "first_row"))


def classify(vc: DataFrame) -> DataFrame:
    """Adds the value class, length and parsed number to each present value."""
    v = F.col("value")
    return vc.where(v.isNotNull()).select(
        "*", T.guess_type(v).alias("data_type"), F.length(v).cast("bigint").alias("len"),
        T.to_number(v).alias("num"))


# ----------------------------------------------------------- column level --

def per_type(vc: DataFrame) -> DataFrame:
    """(pos, column, data_type, value_count, first_row, distinct_values,
    min_len, max_len); data_type NULL is the missing-cell row."""
    v = F.col("value")
    cls = vc.select("*", F.when(v.isNotNull(), T.guess_type(v)).alias("data_type"),
                    F.length(v).cast("bigint").alias("len"))
    return (cls.groupBy("pos", "column", "data_type")
            .agg(F.sum("n").alias("value_count"), F.min("first_row").alias("first_row"),
                 F.count("value").alias("distinct_values"),
                 F.min("len").alias("min_len"), F.max("len").alias("max_len")))


def type_counts(vc: DataFrame) -> DataFrame:
    """(pos, column, data_type, value_count, first_row) of present values."""
    return per_type(vc).where(F.col("data_type").isNotNull()) \
        .select("pos", "column", "data_type", "value_count", "first_row")


def column_stats(vc: DataFrame) -> DataFrame:
    """One row per column from the per-class rows: missing / present
    counts, distinct present values, length range, and the dominant class
    (most values; a tie goes to the class seen first, then the name)."""
    return _column_stats(per_type(vc))


def _column_stats(t: DataFrame) -> DataFrame:
    present = F.col("data_type").isNotNull()
    key = F.when(present, F.struct(F.col("value_count"),
                                   F.coalesce(-F.col("first_row"), F.lit(0)),
                                   F.col("data_type")))
    return (t.groupBy("pos", "column").agg(
        F.sum(F.when(~present, F.col("value_count")).otherwise(0)).alias("missing_count"),
        F.sum(F.when(present, F.col("value_count")).otherwise(0)).alias("present_count"),
        F.sum("distinct_values").alias("unique_values"),
        F.min("min_len").alias("min_length"), F.max("max_len").alias("max_length"),
        F.max_by(F.struct("data_type", "value_count"), key).alias("d"))
        .select("pos", "column", "missing_count", "present_count", "unique_values",
                "min_length", "max_length", F.col("d.data_type").alias("data_type"),
                F.col("d.value_count").alias("dominant_count")))


def dominant_types(vc: DataFrame) -> DataFrame:
    return column_stats(vc).select("pos", "column", "data_type", "dominant_count")


def column_profile(vc: DataFrame) -> DataFrame:
    """Per column: missing count / % / severity, dominant type and its
    confidence, distinct present values, min / max text length.  Every row
    has one cell per column, so a column's missing + present count is the
    row count; no join with a row total is needed."""
    return _column_profile(column_stats(vc))


def _column_profile(stats: DataFrame) -> DataFrame:
    out = stats.withColumn("_rows", F.col("missing_count") + F.col("present_count"))
    missing_pct = _pct(F.col("missing_count"), F.col("_rows"))
    return out.select(
        "pos", F.col("column").alias("column_name"), "missing_count",
        missing_pct.alias("missing_percentage"),
        rules.severity(missing_pct).alias("completeness_severity"),
        F.coalesce(F.col("data_type"), F.lit("unknown")).alias("data_type"),
        _pct(F.col("dominant_count"), F.col("present_count")).alias("type_confidence"),
        F.col("unique_values").cast("bigint").alias("unique_values"),
        F.coalesce(F.col("min_length"), F.lit(0)).cast("bigint").alias("min_length"),
        F.coalesce(F.col("max_length"), F.lit(0)).cast("bigint").alias("max_length"),
        F.col("_rows").alias("total_rows"),
        (F.try_divide(F.col("dominant_count"), F.col("present_count")) * 100)
        .alias("type_pct_raw"))


TYPE_CLASSES = ["integer", "float", "boolean", "email", "date", "string"]


def _exact_distinct_by_fingerprint(typed: DataFrame) -> DataFrame:
    """(pos, unique_values): exact distinct present values per column
    without shuffling unique values.  Distinct (column, fingerprint) pairs
    are counted from fingerprints alone; only cells whose fingerprint repeats
    in their column are regrouped by their real value, which adds the
    values a fingerprint collision would have merged."""
    from ledgerline.operators.dedup import fingerprint, maybe_repeated
    fp = typed.where(F.col("value").isNotNull()).select("pos", "value", *fingerprint(["value"]))
    per_fp = fp.groupBy("pos", "_h0", "_h1").agg(F.count(F.lit(1)).alias("c"))
    distinct_fp = per_fp.groupBy("pos").agg(F.count(F.lit(1)).alias("d"))
    repeated = per_fp.where(F.col("c") > 1).select("pos", "_h0", "_h1")
    extra = (maybe_repeated(fp, repeated)
             .groupBy("pos", "_h0", "_h1", "value").agg(F.lit(1).alias("_x"))
             .groupBy("pos", "_h0", "_h1").agg((F.count(F.lit(1)) - 1).alias("more"))
             .groupBy("pos").agg(F.sum("more").alias("more")))
    return (distinct_fp.join(extra, "pos", "left")
            .select("pos", (F.col("d") + F.coalesce(F.col("more"), F.lit(0)))
                    .alias("unique_values")))


def profile_approx(df: DataFrame, columns: list[str], order_col: str | None = None,
                   rsd: float = 0.01, exact_distinct: bool = False) -> DataFrame:
    """``column_profile`` without the (column, value) shuffle: every
    statistic is a decomposable per-column aggregate of the cells (missing
    and per-class counts, first row per class, lengths), so free-text
    columns cost one pass and no value shuffle.  ``unique_values`` is
    approximate (HyperLogLog++, relative error ``rsd``), the named opt-in of
    the survey; with ``exact_distinct`` it is exact, counted
    fingerprint-first (unique long texts are never shuffled)."""
    cells = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                               T.column(c).cast("string").alias("raw"))
                      for i, c in enumerate(columns)])
    order = F.col(order_col) if order_col else F.lit(None).cast("bigint")
    long = df.select(order.alias("_row"), F.inline(cells))
    v = F.when(~T.is_missing_text("raw"), T.py_strip("raw"))
    typed = long.select("_row", "pos", "column", v.alias("value")).select(
        "*", F.when(F.col("value").isNotNull(), T.guess_type("value")).alias("t"),
        F.length("value").cast("bigint").alias("len"))
    per_class = []
    for t in TYPE_CLASSES:
        per_class += [F.count_if(F.col("t") == t).alias(f"n_{t}"),
                      F.min(F.when(F.col("t") == t, F.col("_row"))).alias(f"f_{t}")]
    g = typed.groupBy("pos", "column").agg(
        F.count_if(F.col("value").isNull()).alias("missing_count"),
        F.count("value").alias("present_count"),
        F.approx_count_distinct("value", rsd).alias("unique_values"),
        F.min("len").alias("min_length"), F.max("len").alias("max_length"), *per_class)
    best = F.greatest(*[F.when(F.col(f"n_{t}") > 0, F.struct(
        F.col(f"n_{t}").alias("c"), F.coalesce(-F.col(f"f_{t}"), F.lit(0)).alias("f"),
        F.lit(t).alias("t"))) for t in TYPE_CLASSES])
    out = (g.withColumn("_b", best)
           .withColumn("_rows", F.col("missing_count") + F.col("present_count")))
    if exact_distinct:
        exact = _exact_distinct_by_fingerprint(typed)
        out = (out.drop("unique_values").join(exact, "pos", "left")
               .withColumn("unique_values", F.coalesce(F.col("unique_values"), F.lit(0))))
    missing_pct = _pct(F.col("missing_count"), F.col("_rows"))
    return out.select(
        "pos", F.col("column").alias("column_name"), "missing_count",
        missing_pct.alias("missing_percentage"),
        rules.severity(missing_pct).alias("completeness_severity"),
        F.coalesce(F.col("_b.t"), F.lit("unknown")).alias("data_type"),
        _pct(F.col("_b.c"), F.col("present_count")).alias("type_confidence"),
        F.col("unique_values").cast("bigint").alias("unique_values"),
        F.coalesce(F.col("min_length"), F.lit(0)).cast("bigint").alias("min_length"),
        F.coalesce(F.col("max_length"), F.lit(0)).cast("bigint").alias("max_length"),
        F.col("_rows").alias("total_rows"),
        (F.try_divide(F.col("_b.c"), F.col("present_count")) * 100).alias("type_pct_raw"))


# Numbers with at most so many digits before and behind the point are summed
# as decimals; the product with a count then still fits 38 digits.
WHOLE_DIGITS, FRACTION_DIGITS, COUNT_DIGITS = 18, 6, 13
_PLAIN_NUMBER = rf"^[+-]?[0-9]{{0,{WHOLE_DIGITS}}}(\.[0-9]{{0,{FRACTION_DIGITS}}})?$"


def _exact_parts(value: Column, num: Column) -> tuple[Column, Column, Column]:
    """A number as (decimal, exponent, mantissa): a plain number is a
    decimal; any other finite one is mantissa * 2 ** exponent with an integer
    mantissa, exactly, as every double is."""
    plain = F.regexp_replace(value, "_", "")
    dec = F.when(plain.rlike(_PLAIN_NUMBER),
                 plain.try_cast(f"decimal({WHOLE_DIGITS + FRACTION_DIGITS},{FRACTION_DIGITS})"))
    # log2 may be off by one, which two spare bits take up; tiny numbers are
    # scaled in two steps, since 2 ** -exponent alone would overflow
    top = F.greatest(F.floor(F.log2(F.abs(num))).cast("int"), F.lit(-1022))
    exponent = top - 54
    half = F.floor(exponent / 2).cast("int")
    mantissa = num * F.pow(F.lit(2.0), -half.cast("double")) * F.pow(F.lit(2.0), (half - exponent).cast("double"))
    wide = dec.isNull() & num.isNotNull() & (F.abs(num) < float("inf")) & (num != 0)
    return dec, F.when(wide, exponent), F.when(wide, mantissa.cast("decimal(20,0)"))


def _number_terms(value: Column, num: Column, n: Column) -> dict[str, Column]:
    """What the exact weighted sum of numbers adds up per exponent ``_e``
    (NULL: the plain numbers): aggregates by name."""
    dec, _, mantissa = _exact_parts(value, num)
    times = n.cast(f"decimal({COUNT_DIGITS},0)")
    odd = F.when(F.isnan(num) | (F.abs(num) == float("inf")), num)
    return {"count": F.sum(F.when(num.isNotNull(), n)), "_d": F.sum(dec * times),
            "_m": F.sum((mantissa * times).cast("decimal(38,0)")), "_odd": F.sum(odd),
            "mn": F.min(num), "mx": F.max(num)}


def _number_totals(per: DataFrame, by: list[str]) -> DataFrame:
    """(by..., count, s, mn, mx) from the terms per exponent."""
    half = F.floor(F.col("_e") / 2)
    scaled = F.col("_m").cast("double") * F.pow(F.lit(2.0), half.cast("double")) \
        * F.pow(F.lit(2.0), (F.col("_e") - half).cast("double"))
    per = per.groupBy(*by, "_e").agg(
        F.sum("count").alias("count"), F.sum("_d").alias("_d"), F.sum("_m").alias("_m"),
        F.sum("_odd").alias("_odd"), F.min("mn").alias("mn"), F.max("mx").alias("mx"))
    wide = F.transform(F.array_sort(F.collect_list(F.when(F.col("_e").isNotNull(), F.struct(
        F.col("_e").alias("e"), scaled.alias("x"))))), lambda p: p["x"])
    total = F.aggregate(F.col("_wide"), F.coalesce(F.col("_d").cast("double"), F.lit(0.0)), lambda a, x: a + x)
    return (per.groupBy(*by).agg(
        F.sum("count").alias("count"), F.sum("_d").alias("_d"), wide.alias("_wide"), F.sum("_odd").alias("_odd"),
        F.min("mn").alias("mn"), F.max("mx").alias("mx"))
        .select(*by, "count", F.coalesce(F.col("_odd"), total).alias("s"), "mn", "mx"))


def exact_sums(nums: DataFrame, by: list[str]) -> DataFrame:
    """(by..., count, s, mn, mx): the sum of ``num`` (the parsed ``value``)
    times ``n``.  Plain numbers add up as decimals and all others per
    exponent as integers, so no addition rounds and the result does not depend
    on the order of rows or their partitioning; the exponents' sums, at most
    one per exponent, are added at the end in their order.  An infinity or NaN
    among the numbers gives the double sum of those."""
    _, exponent, _ = _exact_parts(F.col("value"), F.col("num"))
    terms = _number_terms(F.col("value"), F.col("num"), F.col("n"))
    per = nums.withColumn("_e", exponent).groupBy(*by, "_e").agg(*[x.alias(k) for k, x in terms.items()])
    return _number_totals(per, by)


def numeric_stats(vc: DataFrame) -> DataFrame:
    """count / sum / average / min / max / range (2 dp) of the values that
    are integer or float, for columns whose dominant class is numeric; sums
    are exact before they are rounded."""
    nums = classify(vc).where(F.col("data_type").isin(NUMERIC_TYPES))
    return _numeric_stats(exact_sums(nums, ["pos", "column"]), dominant_types(vc))


def _numeric_stats(sums: DataFrame, dominant: DataFrame) -> DataFrame:
    dom = dominant.where(F.col("data_type").isin(NUMERIC_TYPES))
    return (sums.join(dom.select("pos", "column"), ["pos", "column"])
            .where(F.col("count") > 0)
            .select("pos", F.col("column").alias("column_name"), "count",
                    F.round("s", 2).alias("sum"),
                    F.round(F.try_divide(F.col("s"), F.col("count")), 2).alias("average"),
                    F.round("mn", 2).alias("min"), F.round("mx", 2).alias("max"),
                    F.round(F.col("mx") - F.col("mn"), 2).alias("range")))


def rule_tests(columns: list[str]) -> list[tuple[str, str, Column]]:
    """(column, rule key, failing test on ``value``) for every column that a
    rule family applies to."""
    v = F.col("value")
    out = []
    for c in columns:
        fam = rule_family(c)
        if fam == "email":
            checks = {"invalid_email": ~T.is_valid_email(v)}
        elif fam == "amount":
            x = T.to_number(v)
            checks = {"negative": x < 0, "zero": x == 0, "non_numeric": x.isNull()}
        elif fam == "date":
            checks = {"invalid_date": ~T.is_valid_date_shape(v)}
        elif fam == "id":
            checks = {"invalid_id": ~T.is_alnum(v)}
        else:
            checks = {}
        out += [(c, f"{c}_{k}", t) for k, t in checks.items()]
    return out


def _cell_sums(vc: DataFrame, columns: list[str]) -> DataFrame:
    """One aggregate over the value counts: missing cells and every rule
    count (each test runs once per distinct value)."""
    n, present = F.col("n"), F.col("value").isNotNull()
    sums = [F.sum(F.when(~present, n).otherwise(0)).alias("empty_cells")]
    sums += [F.sum(F.when(present & (F.col("column") == c) & F.coalesce(t, F.lit(False)), n)
                   .otherwise(0)).alias(f"r{i}")
             for i, (c, _, t) in enumerate(rule_tests(columns))]
    return vc.agg(*sums)


def rule_counts(vc: DataFrame, columns: list[str]) -> DataFrame:
    """(rule_key, invalid_count) for every rule that fired at least once;
    key = '<column>_<problem>'.  The rule family is chosen per column from
    its name."""
    tests = rule_tests(columns)
    if not tests:
        return vc.sparkSession.createDataFrame([], "rule_key string, invalid_count bigint")
    return _rule_counts(_cell_sums(vc, columns), tests)


def _rule_counts(s: DataFrame, tests: list) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(k).alias("rule_key"),
                                 F.col(f"r{i}").cast("bigint").alias("invalid_count"))
                        for i, (_, k, _) in enumerate(tests)])
    return s.select(F.inline(entries)).where(F.col("invalid_count") > 0)


# -------------------------------------------------------------- row level --

def row_key(columns: list[str]) -> Column:
    """Stripped values joined by '|'; an absent value prints as 'None'.  As
    in the reference the joined text can collide ('a|b','c' = 'a','b|c')."""
    return F.concat_ws("|", *[F.coalesce(T.py_strip(T.column(c).cast("string")), F.lit("None"))
                              for c in columns])


def _complete(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [~T.is_missing_text(T.column(c)) for c in columns])


def row_metrics(df: DataFrame, columns: list[str], fingerprints: bool = False) -> DataFrame:
    """One grouping by row key, partial-aggregated: total rows, rows with
    no missing cell, duplicate rows (rows - distinct keys).

    With ``fingerprints`` (wide rows, e.g. long texts) the grouping is by a
    128-bit fingerprint of the key; only rows whose fingerprint repeats are
    regrouped by their exact key, so duplicates stay exact and unique long
    keys are never shuffled."""
    base = df.select(row_key(columns).alias("_key"),
                                    _complete(columns).alias("_ok"))
    if fingerprints:
        from ledgerline.operators.dedup import fingerprint, maybe_repeated
        h = base.select("_key", "_ok", *fingerprint(["_key"]))
        per_fp = h.groupBy("_h0", "_h1").agg(F.count(F.lit(1)).alias("c"),
                                             F.count_if("_ok").alias("k"))
        rep = per_fp.where(F.col("c") > 1).select("_h0", "_h1")
        dup = (maybe_repeated(h, rep).groupBy("_key")
               .agg(F.count(F.lit(1)).alias("c"))
               .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint")
                    .alias("duplicate_rows")))
        tot = per_fp.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("total_rows"),
                         F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("complete_rows"))
        return _side_by_side(tot, dup)
    per_key = base.groupBy("_key").agg(F.count(F.lit(1)).alias("c"), F.count_if("_ok").alias("k"))
    return per_key.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("total_rows"),
                       F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("complete_rows"),
                       F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint")
                       .alias("duplicate_rows"))


def duplicate_rows(df: DataFrame, columns: list[str], order_col: str,
                   fingerprints: bool = False) -> DataFrame:
    """Rows whose row key was seen on an earlier row (first occurrence
    excluded): (order_col).  Exact; see ``dedup.duplicate_rows``."""
    from ledgerline.operators import dedup
    keyed = df.select(F.col(order_col).alias("_row"), row_key(columns).alias("_key"))
    return (dedup.duplicate_rows(keyed, ["_key"], "_row", fingerprints)
            .select(F.col("_row").alias(order_col)))


# ----------------------------------------------------------------- report --

def summary(df: DataFrame, columns: list[str], vc: DataFrame | None = None,
            fingerprints: bool = False) -> DataFrame:
    """The one-row summary: rows, columns, complete rows and %, empty
    cells, duplicate rows, invalid values, quality score and rating.  Two
    aggregate chains: one over row keys, one over value counts."""
    vc = vc if vc is not None else value_counts(df, columns)
    return _summary(row_metrics(df, columns, fingerprints), _cell_sums(vc, columns), columns)


def _summary(rows: DataFrame, cells: DataFrame, columns: list[str]) -> DataFrame:
    invalid = reduce(lambda a, b: a + b, [F.col(f"r{i}") for i in range(len(rule_tests(columns)))],
                     F.lit(0).cast("bigint"))
    cells = cells.select("empty_cells", invalid.cast("bigint").alias("invalid_values"))
    s = _side_by_side(rows, cells) \
        .withColumn("total_columns", F.lit(len(columns)).cast("bigint"))
    return s.select("total_rows", "total_columns", "complete_rows",
                    _pct(F.col("complete_rows"), F.col("total_rows"))
                    .alias("completeness_percentage"),
                    F.coalesce("empty_cells", F.lit(0)).cast("bigint").alias("empty_cells"),
                    "duplicate_rows", "invalid_values") \
        .transform(with_score)


def with_score(s: DataFrame) -> DataFrame:
    cells = F.col("total_rows") * F.col("total_columns")
    comp = (1 - F.try_divide(F.col("empty_cells"), cells)) * WEIGHT_COMPLETE
    uniq = (1 - F.col("duplicate_rows") / F.greatest(F.lit(1), F.col("total_rows"))) \
        * WEIGHT_UNIQUE
    valid = (1 - F.col("invalid_values")
             / F.greatest(F.lit(1), cells - F.col("empty_cells"))) * WEIGHT_VALID
    raw = F.when(cells > 0, F.least(F.lit(100.0), F.greatest(F.lit(0.0), comp + uniq + valid))) \
        .otherwise(F.lit(0.0))
    return (s.withColumn("_score", raw)
            .withColumn("quality_score", F.round("_score", 2))
            .withColumn("quality_rating", rules.quality_rating("_score"))
            .drop("_score"))


def issues(profile: DataFrame, rule_keys: DataFrame) -> DataFrame:
    """Columns with more than 20 % missing, or whose bare name is among the
    rule keys (as in the reference, only a name accident makes that fire)."""
    named = rule_keys.select(F.col("rule_key").alias("column_name")).distinct()
    flagged = profile.join(named.withColumn("_named", F.lit(True)), "column_name", "left")
    return (flagged.where((F.col("missing_percentage") > MISSING_ISSUE_PCT)
                          | F.col("_named").isNotNull())
            .select("pos", "column_name", "missing_percentage",
                    F.col("completeness_severity").alias("severity")))


def _filled(template: str, **values: Column) -> Column:
    """The template with each {name} replaced by its column."""
    parts = re.split(r"[{}]", template)          # text, name, text, name, ...
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def recommendations(profile: DataFrame, summ: DataFrame) -> DataFrame:
    """(seq, recommendation) in the reference's order."""
    rows = summ.select("total_rows", "duplicate_rows", "quality_score")
    # 1. imputation: the first five >20 % columns, '...' if more.
    heavy = profile.where(
        F.try_divide(F.col("missing_count"), F.col("total_rows")) > MISSING_ISSUE_PCT / 100)
    imp = heavy.agg(F.sort_array(F.collect_list(F.struct("pos", "column_name"))).alias("cs")) \
        .where(F.size("cs") > 0).select(
            F.lit(1).alias("seq"), F.lit(0).alias("sub"),
            F.concat(F.lit(RECOMMEND_IMPUTE),
                     F.array_join(F.transform(F.slice("cs", 1, 5), lambda x: x["column_name"]),
                                  ", "),
                     F.when(F.size("cs") > 5, F.lit("...")).otherwise(F.lit("")))
            .alias("recommendation"))
    # 2. duplicates.
    dup_pct = F.format_string("%.1f", F.bround(F.try_divide(F.col("duplicate_rows"),
                                                            F.col("total_rows"))
                                               * 100, 1))
    dup = rows.where(F.col("duplicate_rows") > 0).select(
        F.lit(2).alias("seq"), F.lit(0).alias("sub"),
        _filled(RECOMMEND_DUPLICATES, n=F.col("duplicate_rows").cast("string"), pct=dup_pct)
        .alias("recommendation"))
    # 3. mixed types, one per column in column order.
    mixed = profile.where((F.col("data_type") != "unknown")
                          & (F.col("type_pct_raw") < MIXED_TYPE_PCT)).select(
        F.lit(3).alias("seq"), F.col("pos").alias("sub"),
        _filled(RECOMMEND_MIXED, col=F.col("column_name"), t=F.col("data_type"))
        .alias("recommendation"))
    # 4. overall.
    overall = rows.where(F.col("quality_score") < LOW_SCORE).select(
        F.lit(4).alias("seq"), F.lit(0).alias("sub"), F.lit(RECOMMEND_OVERALL)
        .alias("recommendation"))
    out = imp.unionByName(dup).unionByName(mixed).unionByName(overall)
    w = Window.orderBy("seq", "sub")   # a handful of rows: bounded by columns
    return out.select(F.row_number().over(w).cast("bigint").alias("seq"), "recommendation")


def small_report(df: DataFrame, columns: list[str], amount_col: str = "amount") -> DataFrame:
    """The short report: row count, missing counts > 0 only (empty text or
    absent), and ``amount <= 0`` count (non-numeric ignored), in long form
    (section, item, value)."""
    miss = [F.struct(F.lit("missing_values").alias("section"), F.lit(c).alias("item"),
                     F.count_if(F.coalesce(T.column(c), F.lit("")) == "").alias("value"))
            for c in columns]
    parts = [F.struct(F.lit("row_count").alias("section"), F.lit("rows").alias("item"),
                      F.count(F.lit(1)).alias("value"))] + miss
    if amount_col in columns:
        x = F.regexp_replace(T.py_strip(amount_col), "_", "")
        x = F.when(T.is_float_text(T.py_strip(amount_col)), x.try_cast("double"))
        parts.append(F.struct(F.lit("invalid_values").alias("section"),
                              F.lit(amount_col).alias("item"), F.count_if(x <= 0).alias("value")))
    return (df.agg(F.array(*parts).alias("a")).select(F.inline("a"))
            .where((F.col("section") == "row_count") | (F.col("value") > 0)))


# ------------------------------------------------------------ full report --

def _sorted_entries(df: DataFrame, key: str, value: Column, order: str = "pos") -> Column:
    """collect into an array ordered by ``order`` (column order, bounded by
    the number of columns, not by data)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                            F.col(key).alias("k"),
                                                            value.alias("v")))),
                       lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))


def class_table(vc: DataFrame, columns: list[str]) -> DataFrame:
    """Everything that the report says about columns, in one aggregate of
    the value counts: one row per column, value class and exponent of its
    inexact numbers (few rows, whatever the data), with the class's counts and
    lengths, the terms of its exact sum and the rule counts."""
    v, n, present = F.col("value"), F.col("n"), F.col("value").isNotNull()
    cls = vc.select("*", F.when(present, T.guess_type(v)).alias("data_type"), F.length(v).cast("bigint").alias("len"))
    num = F.when(F.col("data_type").isin(NUMERIC_TYPES), T.to_number(v))
    cls = cls.withColumn("num", num)
    _, exponent, _ = _exact_parts(v, F.col("num"))
    rules_ = [F.sum(F.when(present & (F.col("column") == c) & F.coalesce(t, F.lit(False)), n).otherwise(0)).alias(f"r{i}")
              for i, (c, _, t) in enumerate(rule_tests(columns))]
    terms = [x.alias(k) for k, x in _number_terms(v, F.col("num"), n).items()]
    return (cls.withColumn("_e", exponent).groupBy("pos", "column", "data_type", "_e").agg(
        F.sum("n").alias("value_count"), F.min("first_row").alias("first_row"),
        F.count("value").alias("distinct_values"), F.min("len").alias("min_len"), F.max("len").alias("max_len"),
        *terms, *rules_))


def quality_report(df: DataFrame, columns: list[str], order_col: str | None = None,
                   file_name: str | None = None, file_path: str | None = None,
                   file_size: int | None = None, analysis_date: str | None = None,
                   fingerprints: bool = False, duplicates_path: str | None = None) -> DataFrame:
    """The whole report as one row of nested structs: metadata, summary,
    column_analysis (map column -> stats), issues, recommendations.

    The data is read for three written tables: the class table and the row
    metrics, which are small and from which every part of the report is then
    made without an exchange, and the duplicate rows, which may be many: they
    stay a Parquet table of their own (``order_col``), under
    ``duplicates_path`` or the scratch folder, and the report holds their count
    and the table's path (``issues.duplicates.rows_table``)."""
    spark = df.sparkSession
    t = materialise(class_table(value_counts(df, columns, order_col), columns), "report_classes").coalesce(1)
    rows = materialise(row_metrics(df, columns, fingerprints), "report_rows").coalesce(1)
    if order_col:
        duplicates_path = duplicates_path or scratch_path(spark, "report_duplicates")
        duplicate_rows(df, columns, order_col, fingerprints).write.mode("overwrite").parquet(duplicates_path)
    per = t.groupBy("pos", "column", "data_type").agg(
        F.sum("value_count").alias("value_count"), F.min("first_row").alias("first_row"),
        F.sum("distinct_values").alias("distinct_values"), F.min("min_len").alias("min_len"),
        F.max("max_len").alias("max_len"))
    tests = rule_tests(columns)
    sums = t.agg(F.sum(F.when(F.col("data_type").isNull(), F.col("value_count")).otherwise(0)).alias("empty_cells"),
                 *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(tests))])
    stats = _column_stats(per)
    prof = _column_profile(stats)
    nums = _numeric_stats(_number_totals(t.where(F.col("data_type").isin(NUMERIC_TYPES)), ["pos", "column"]),
                          stats.select("pos", "column", "data_type"))
    rk = _rule_counts(sums, tests)
    summ = _summary(rows, sums, columns)
    iss = issues(prof, rk)
    recs = recommendations(prof, summ)

    num_struct = F.struct("count", "sum", "average", "min", "max", "range")
    cols = (prof.join(nums.select("pos", num_struct.alias("numeric_stats")), "pos", "left")
            .withColumn("stats", F.struct(
                "missing_count", "missing_percentage", "completeness_severity", "data_type",
                "type_confidence", "unique_values",
                F.struct(F.col("min_length").alias("min"), F.col("max_length").alias("max"))
                .alias("value_length"), "numeric_stats")))
    col_map = cols.agg(F.map_from_entries(_sorted_entries(cols, "column_name", F.col("stats")))
                       .alias("column_analysis"))
    inv = rk.withColumn("pos", F.col("rule_key"))
    inv = inv.agg(F.map_from_entries(_sorted_entries(inv, "rule_key", F.col("invalid_count"))).alias("invalid_values"))
    cwi = iss.agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "pos", F.col("column_name").alias("column"), "missing_percentage", "severity"))),
        lambda e: e.dropFields("pos")).alias("columns_with_issues"))
    rec = recs.agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "recommendation"))),
                               lambda e: e["recommendation"]).alias("recommendations"))
    meta = summ.select(F.struct(
        F.lit(file_name).cast("string").alias("file_name"),
        F.lit(file_path).cast("string").alias("file_path"),
        F.lit(file_size).cast("bigint").alias("file_size_bytes"),
        (F.lit(analysis_date) if analysis_date else
         F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("analysis_date")).alias("metadata"),
        F.struct("total_rows", "total_columns", "complete_rows", "completeness_percentage",
                 "quality_score", "quality_rating").alias("summary"),
        "duplicate_rows", "total_rows")
    out = _side_by_side(*[x.coalesce(1) for x in (meta, col_map, inv, cwi, rec)])
    dpct = _pct(F.col("duplicate_rows"), F.col("total_rows"))
    return out.select(
        "metadata", "summary", "column_analysis",
        F.struct(F.struct(F.col("duplicate_rows").alias("count"), dpct.alias("percentage"),
                          F.lit(duplicates_path).cast("string").alias("rows_table")).alias("duplicates"),
                 "invalid_values", "columns_with_issues").alias("issues"),
        "recommendations")


def reported_duplicates(report: DataFrame) -> DataFrame | None:
    """The table of duplicate rows that a report links to."""
    path = report.select("issues.duplicates.rows_table").first()[0]
    return report.sparkSession.read.parquet(path) if path else None


def report_lines(report: DataFrame) -> DataFrame:
    """The report in long form, but for its time and paths: (section, item,
    field, number, text)."""
    def line(section, item, field, number=None, text=None):
        return F.struct(F.lit(section).alias("section"), item.cast("string").alias("item"), F.lit(field).alias("field"),
                        (F.lit(None) if number is None else number).cast("double").alias("number"),
                        (F.lit(None) if text is None else text).cast("string").alias("text"))

    none = F.lit(None).cast("string")
    s, dup = F.col("summary"), F.col("issues.duplicates")
    fixed = [line("metadata", none, "file_name", text=F.col("metadata.file_name")),
             *[line("summary", none, k, number=s[k]) for k in (
                 "total_rows", "total_columns", "complete_rows", "completeness_percentage", "quality_score")],
             line("summary", none, "quality_rating", text=s["quality_rating"]),
             *[line("duplicates", none, k, number=dup[k]) for k in ("count", "percentage")]]

    def of_column(e):
        v = e["value"]
        x = v["numeric_stats"]
        numbers = {k: v[k] for k in ("missing_count", "missing_percentage", "type_confidence", "unique_values")}
        numbers |= {f"{k}_length": v["value_length"][k] for k in ("min", "max")}
        numbers |= {f"numeric_{k}": x[k] for k in ("count", "sum", "average", "min", "max", "range")}
        return F.array(*[line("column", e["key"], k, number=c) for k, c in numbers.items()],
                       *[line("column", e["key"], k, text=v[k]) for k in ("completeness_severity", "data_type")])

    parts = F.concat(
        F.array(*fixed), F.flatten(F.transform(F.map_entries("column_analysis"), of_column)),
        F.transform(F.map_entries("issues.invalid_values"),
                    lambda e: line("invalid", e["key"], "count", number=e["value"])),
        F.transform("issues.columns_with_issues", lambda e: line(
            "issue", e["column"], "missing_percentage", number=e["missing_percentage"], text=e["severity"])),
        F.transform("recommendations", lambda r, i: line("recommendation", i + 1, "text", text=r)))
    return report.select(F.inline(parts)).where(F.col("number").isNotNull() | F.col("text").isNotNull())
