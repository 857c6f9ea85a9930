"""Inspection of typed frames: head, shape, schema, describe, null counts,
distinct counts, value distribution, min / max, step counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerline.functions import text as T


def head(df: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """First n rows by a key (a frame has no row order of its own)."""
    return df.orderBy(*key).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def _long(df: DataFrame, metrics: dict[str, callable], columns: list[str]) -> DataFrame:
    """One aggregate pass, unpivoted to (column_name, metric...)."""
    aggs = [m(c).alias(f"{c}__{name}") for c in columns for name, m in metrics.items()]
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"),
                        *[F.col(f"`{c}__{name}`").alias(name) for name in metrics])
               for c in columns]
    return one.select(F.inline(F.array(*structs)))


def schema_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null_count)."""
    types = dict(df.dtypes)
    out = _long(df, {"non_null_count": lambda c: F.count(T.column(c))}, df.columns)
    m = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return out.select("column_name", m[F.col("column_name")].alias("data_type"),
                      "non_null_count")


def null_counts(df: DataFrame) -> DataFrame:
    return _long(df, {"null_count": lambda c: F.count_if(T.column(c).isNull())}, df.columns)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct values per column (one aggregate; NULL not counted)."""
    return _long(df, {"distinct_count": lambda c: F.count_distinct(T.column(c))}, columns)


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), col))


def min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    return _long(df, {"min": lambda c: F.min(c), "max": lambda c: F.max(c)}, columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


BINS = 512                        # of one interval and round
_LARGEST = 1.7976931348623157e308


def _bin(v: Column, low: float, high: float, log: bool) -> Column:
    """Which of ``BINS`` ordered bins of [low, high] a value is in: never
    falling, with ``low`` and ``high`` in different ones.  The infinities have
    the outer bins; the finite rest is cut evenly, or evenly in its logarithm."""
    lo, hi = max(low, -_LARGEST), min(high, _LARGEST)
    if lo >= hi:
        inside = F.lit(1)
    else:
        if log and math.copysign(math.log1p(abs(lo)), lo) < math.copysign(math.log1p(abs(hi)), hi):
            def level(x):
                return F.signum(x) * F.log1p(F.abs(x))
        elif math.isinf(hi - lo):
            def level(x):
                return x / 2
        else:
            def level(x):
                return x
        start = level(F.lit(lo))
        share = (level(v) - start) / (level(F.lit(hi)) - start)
        inside = F.least(F.lit(BINS - 2), F.greatest(F.lit(1), F.floor(share * (BINS - 2)) + 1))
    return (F.when(v == F.lit(float("-inf")), 0).when(v == F.lit(float("inf")), BINS - 1)
            .otherwise(inside).cast("int"))


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], bounds: dict[str, tuple[float, float]]) -> dict:
    """{(column, rank): value}: the values at 0-based ranks of the columns'
    sorted non-missing values.

    Every rank is known to lie in an interval of values, at first the whole
    column.  A round counts each interval's values in ordered bins (partial
    aggregates; only the bins' counts, least and greatest values reach the
    driver) and keeps the bin that holds the rank, so nothing is sorted or
    shuffled; an interval of one value is the answer.  Rounds cut evenly and
    by logarithm in turn."""
    todo = {(c, *bounds[c], 0): sorted(set(r)) for c, r in ranks.items() if r}
    out, log = {}, False
    while todo:
        for key in [k for k in todo if k[1] == k[2]]:
            out.update({(key[0], r): key[1] for r in todo.pop(key)})
        if not todo:
            break
        keys = list(todo)
        hits = []
        for i, (c, low, high, _) in enumerate(keys):
            v = T.column(c).cast("double")
            hits.append(F.when(v.between(low, high) & ~F.isnan(v), F.struct(
                F.lit(i).alias("i"), _bin(v, low, high, log).alias("bin"), v.alias("v"))))
        cells = df.select(F.inline(F.filter(F.array(*hits), lambda x: x.isNotNull())))
        found: dict[int, list] = {}
        for r in cells.groupBy("i", "bin").agg(F.count(F.lit(1)), F.min("v"), F.max("v")).collect():
            found.setdefault(r[0], []).append(tuple(r)[1:])
        narrowed: dict = {}
        for i, key in enumerate(keys):
            before, wanted = key[3], list(todo[key])
            for _, n, low, high in sorted(found[i]):
                here = [r for r in wanted if r < before + n]
                if here:
                    narrowed.setdefault((key[0], low, high, before), []).extend(here)
                    wanted = wanted[len(here):]
                before += n
        todo, log = narrowed, not log
    return out


def exact_quantiles(df: DataFrame, cols: list[str] | str, qs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``percentile``) of
    one or more numeric columns, without gathering, sorting or shuffling a
    column: (column_name, q, value).  NULL and NaN are skipped, as pandas
    does; a column without values has no rows.  Reads ``df`` once for the
    range and a few times to narrow it."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    one = []
    for i, c in enumerate(cols):
        v = T.column(c).cast("double")
        v = F.when(~F.isnan(v), v)
        one += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}")]
    got = df.agg(*one).first()
    count = {c: got[f"n{i}"] for i, c in enumerate(cols) if got[f"n{i}"]}
    bounds = {c: (got[f"low{i}"], got[f"high{i}"]) for i, c in enumerate(cols)}
    place = {(c, q): (n - 1) * q for c, n in count.items() for q in qs}
    ranks = {c: [r for q in qs for r in (math.floor(place[c, q]), math.ceil(place[c, q]))] for c in count}
    values = order_statistics(df, ranks, bounds)
    rows = []
    for (c, q), p in place.items():
        low, high = values[c, math.floor(p)], values[c, math.ceil(p)]
        rows.append((c, float(q), low if low == high else low + (high - low) * (p - math.floor(p))))
    return df.sparkSession.createDataFrame(rows, "column_name string, q double, value double")


def describe(df: DataFrame, columns: list[str] | None = None,
             qs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """pandas ``describe`` for numeric columns in long form: count, mean,
    sample std, min, 25/50/75 % (exact, linear interpolation), max."""
    cols = columns or numeric_columns(df)
    base = _long(df, {"count": lambda c: F.count(T.column(c)),
                      "mean": lambda c: F.avg(T.column(c)),
                      "std": lambda c: F.stddev_samp(T.column(c)),
                      "min": lambda c: F.min(T.column(c)).cast("double"),
                      "max": lambda c: F.max(T.column(c)).cast("double")}, cols)
    names = {q: f"p{int(round(q * 100))}" for q in qs}
    quant = (exact_quantiles(df, cols, list(qs)).groupBy("column_name")
             .agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(names[q]) for q in qs]))
    # left: a column with no value still reports count 0 (pandas does)
    return base.join(quant, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *names.values(), "max")


def observed(df: DataFrame, name: str):
    """(df with a row-count observation, the Observation).  The count is
    collected as a side result of whatever action later runs the plan, so
    reporting rows in / out of a step costs no extra job; read it with
    ``obs.get["rows"]`` after that action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def step_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """Rows after each step, as (step, row_count)."""
    from ledgerline.operators.reconcile import labelled_counts
    return labelled_counts(steps, label="step", value="row_count")
