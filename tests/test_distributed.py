"""Distributed rank and exact quantiles against brute force, on skewed
data, with different partition counts."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import dedup, inspect, windows


def skewed_rows(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 20)}"
        v = 7 if rnd.random() < 0.2 else rnd.randint(-50, 500)     # one hot value
        rows.append((i, g, v if rnd.random() > 0.01 else None))
    return rows


@pytest.mark.parametrize("parts", [None, 1, 3, 16])
@pytest.mark.parametrize("dense", [False, True])
def test_rank_within_matches_window(spark, parts, dense):
    df = spark.createDataFrame(skewed_rows(), "id int, g string, v int")
    fn = F.dense_rank() if dense else F.rank()
    exp = df.withColumn("r", fn.over(Window.partitionBy("g").orderBy(F.desc("v"))))
    got = windows.rank_within(df, ["g"], "v", out="r", dense=dense, partitions=parts)
    a = sorted((r.id, r.r) for r in exp.collect())
    b = sorted((r.id, r.r) for r in got.collect())
    assert a == b


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_quantiles(spark, parts):
    vals = [r[2] for r in skewed_rows() if r[2] is not None]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(parts)
    got = {r.q: r.value for r in inspect.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for q, v in got.items():
        assert v == pytest.approx(float(np.percentile(vals, q * 100)))


@pytest.mark.parametrize("bins", [4, 512])
def test_quantiles_of_extreme_values(spark, monkeypatch, bins):
    """Heavy tails, tiny and huge magnitudes, infinities, ties, NaN, NULL."""
    monkeypatch.setattr(inspect, "BINS", bins)
    rnd = random.Random(4)
    cols = {"tail": [2.0 ** rnd.randint(-300, 300) * rnd.choice([-1, 1]) for _ in range(200)],
            "tiny": [rnd.randint(-9, 9) * 5e-324 for _ in range(200)],
            "wide": [rnd.choice([-1.7e308, 1.7e308, 0.0, 1.0, 1.0 + 2.0 ** -52]) for _ in range(200)],
            "inf": [rnd.choice([float("inf"), float("-inf"), 3.0, 4.0]) for _ in range(200)],
            "one": [7.5] * 200,
            "gaps": [rnd.choice([None, float("nan"), float(rnd.randint(0, 50))]) for _ in range(200)],
            "none": [None] * 200}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    qs = [0.0, 0.1, 1 / 3, 0.5, 0.99, 1.0]
    got = {(r.column_name, r.q): r.value for r in inspect.exact_quantiles(df, list(cols), qs).collect()}
    assert not any(c == "none" for c, _ in got)
    for c in cols:
        vals = sorted(v for v in cols[c] if v is not None and v == v)
        for q in qs if vals else []:
            p = (len(vals) - 1) * q
            low, high = vals[int(np.floor(p))], vals[int(np.ceil(p))]
            want = low if low == high else low + (high - low) * (p - np.floor(p))
            assert got[c, q] == want or (want != want and got[c, q] != got[c, q])


def test_duplicate_rows_with_hot_value(spark):
    rows = [(i, "same" if i % 3 else f"u{i}", None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    first = min(i for i in range(300) if i % 3)
    for fp in (False, True):
        got = sorted(r.id for r in dedup.duplicate_rows(df, ["a", "b"], "id", fp).collect())
        assert got == [i for i in range(300) if i % 3 and i != first]


@pytest.mark.parametrize("bits", [6, 10, 23])
def test_duplicates_with_a_full_or_sparse_filter(spark, monkeypatch, bits):
    """False hits of the filter change nothing; equal order keys neither."""
    monkeypatch.setattr(dedup, "FILTER_BITS", bits)
    rnd = random.Random(bits)
    rows = [(rnd.randint(0, 400), rnd.choice(["hot", None, f"v{rnd.randint(0, 300)}"]), rnd.choice(["x", None]))
            for _ in range(900)]
    df = spark.createDataFrame(rows, "id int, a string, b string").repartition(5)
    first = {}
    for i, a, b in rows:
        first[a, b] = min(i, first.get((a, b), i))
    want = sorted((r for r in rows if r[0] > first[r[1:]]), key=str)
    for fp in (False, True):
        assert sorted(map(tuple, dedup.duplicate_rows(df, ["a", "b"], "id", fp).collect()), key=str) == want
        c = dedup.duplicate_count(df, ["a", "b"], fp).first()
        assert (c.total_rows, c.distinct_rows, c.duplicate_rows) == (900, len(first), 900 - len(first))
        got = dedup.drop_duplicates(df.select("a", "b"), fingerprints=fp).collect()
        assert sorted(map(tuple, got), key=str) == sorted(first, key=str)


def test_no_task_meets_a_hot_duplicate(spark):
    """Without broadcasts of measured size, no exchange is keyed by the
    repeated value but the aggregates'."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(20_000).selectExpr("id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS a")
        dup = dedup.duplicate_rows(df, ["a"], "id", True)
        sizes = [r["count"] for r in dup.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 6666 and len(sizes) > 4 and max(sizes) < 2 * 6666 / len(sizes)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_mostly_distinct_rows_are_dealt_before_they_are_held(spark, monkeypatch, tmp_path):
    """The jobs hold distinct rows in tasks in proportion to the input files,
    behind a shuffle by value; no aggregate runs in the stage above it."""
    from ledgerline.plans import jobs
    from ledgerline.session import input_bytes
    rows = [(i % 40, "West" if i % 3 else None, f"p{i % 7}", float(i % 5) if i % 11 else None, 2.0) for i in range(300)]
    rows += rows[:90]
    path = f"{tmp_path}/a b/sales.parquet"
    spark.createDataFrame(rows, jobs.SALES_FILE).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "a b" / "sales.parquet").glob("*.parquet"))
    assert input_bytes(df) == size and input_bytes(spark.range(3).toDF("x")) == 0
    monkeypatch.setattr(dedup, "BYTES_PER_TASK", size // 20)
    assert dedup.distinct_tasks(df) in (20, 21)
    monkeypatch.setattr(dedup, "MOST_TASKS", 13)
    assert dedup.distinct_tasks(df) == 13 and dedup.distinct_tasks(spark.range(3).toDF("x")) == 8
    # as a join on a key leaves them: dealt by a column, which an aggregate would take as enough
    by_key = df.repartition("order_id")
    clean = {r for r in rows if r[3] is not None}
    got = jobs.clean_and_aggregate(by_key)["clean"]
    assert sorted(map(str, (tuple(r)[:5] for r in got.collect()))) == sorted(map(str, clean))
    summary = {r.Region: r.Total_Quantity for r in jobs.regional_sales(by_key)["summary"].collect()}
    assert summary == {"West": sum(r[3] for r in clean if r[1] == "West")}
    west = jobs.clean_sales_data(by_key)
    assert sorted(map(str, map(tuple, west.collect()))) == sorted(str(r) for r in clean if r[1] == "West" and r[3] > 1)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,), (None,)], "x double")
    assert dedup.drop_duplicates(zeros.repartition(6), mostly_distinct=True).count() == 3
    for job in (got, jobs.regional_sales(by_key)["summary"], west):
        plan = job.select("*")._jdf.queryExecution().executedPlan().toString()     # not run yet
        dealt = plan.index(", 13), REPARTITION_BY_NUM")
        assert "HashAggregate" in plan[:dealt] and "HashAggregate" not in plan[dealt:], plan


def test_results_do_not_depend_on_partitioning(spark):
    from ledgerline.operators import aggregate as agg
    from tests.fixtures import SALES, SALES_SCHEMA
    base = spark.createDataFrame(SALES, SALES_SCHEMA)
    ref = sorted(map(tuple, agg.by_region(base).collect()))
    for n in (1, 4, 13):
        shuffled = base.repartition(n).orderBy(F.rand(n))
        assert sorted(map(tuple, agg.by_region(shuffled).collect())) == ref
        ranked = sorted(map(tuple, windows.rank_in_region(shuffled).collect()))
        assert ranked == sorted(map(tuple, windows.rank_in_region(base).collect()))


def test_exact_distinct_survives_fingerprint_collisions(spark, monkeypatch):
    from ledgerline.operators import quality as Q
    rows = [(i, f"v{i % 9}", None if i % 4 == 0 else f"w{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "r bigint, a string, b string")
    want = sorted(map(tuple, Q.column_profile(Q.value_counts(df, ["a", "b"], "r")).collect()))
    monkeypatch.setattr(dedup, "fingerprint",
                        lambda cols: [F.lit(0).cast("bigint").alias("_h0"),
                                      F.lit(0).cast("bigint").alias("_h1")])
    got = sorted(map(tuple, Q.profile_approx(df, ["a", "b"], "r", exact_distinct=True).collect()))
    assert got == want


def test_dedup_exact_even_when_every_fingerprint_collides(spark, monkeypatch):
    rows = [(1, "a", None), (2, "a", None), (3, None, "a"), (4, "a", "a"), (5, "b", None),
            (6, None, "a"), (7, "a", None)]
    df = spark.createDataFrame(rows, "id int, x string, y string")
    monkeypatch.setattr(dedup, "fingerprint",
                        lambda cols: [F.lit(0).cast("bigint").alias("_h0"),
                                      F.lit(0).cast("bigint").alias("_h1")])
    for fp in (False, True):
        got = sorted(r.id for r in dedup.duplicate_rows(df, ["x", "y"], "id", fp).collect())
        assert got == [2, 6, 7]
        c = dedup.duplicate_count(df.drop("id"), fingerprints=fp).first()
        assert (c.total_rows, c.distinct_rows, c.duplicate_rows) == (7, 4, 3)
        got = sorted(map(tuple, dedup.drop_duplicates(df.drop("id"), fingerprints=fp).collect()),
                     key=repr)
        assert got == sorted([("a", None), (None, "a"), ("a", "a"), ("b", None)], key=repr)


def test_quality_row_metrics_fingerprints_agree(spark):
    from ledgerline.operators import quality as Q
    rows = [(i, f"t{i % 7}", None if i % 5 == 0 else "x", " y " if i % 2 else "y") for i in range(200)]
    df = spark.createDataFrame(rows, "r bigint, a string, b string, c string")
    cols = ["a", "b", "c"]
    plain = Q.row_metrics(df, cols).first()
    fp = Q.row_metrics(df, cols, fingerprints=True).first()
    assert tuple(plain) == tuple(fp)
    a = sorted(r.r for r in Q.duplicate_rows(df, cols, "r").collect())
    b = sorted(r.r for r in Q.duplicate_rows(df, cols, "r", fingerprints=True).collect())
    assert a == b and len(a) > 0


def test_profile_approx_matches_exact_profile(spark):
    from ledgerline.operators import quality as Q
    from ledgerline.sources import raw_views as R
    d = "/root/testdata/sf0.01"
    for df, cols in ((R.txn_raw(spark, d), R.TXN_COLUMNS), (R.docs_raw(spark, d), R.DOCS_COLUMNS)):
        exact = {r.column_name: r for r in
                 Q.column_profile(Q.value_counts(df, cols, "row_id")).collect()}
        approx = {r.column_name: r for r in Q.profile_approx(df, cols, "row_id").collect()}
        cells = sorted(map(tuple, Q.profile_approx(df, cols, "row_id", exact_distinct=True)
                           .collect()))
        assert cells == sorted(map(tuple, Q.column_profile(
            Q.value_counts(df, cols, "row_id")).collect()))
        assert exact.keys() == approx.keys()
        for c, e in exact.items():
            a = approx[c]
            for f in ("missing_count", "missing_percentage", "completeness_severity", "data_type",
                      "type_confidence", "min_length", "max_length", "total_rows"):
                assert e[f] == a[f], (c, f)
            assert abs(a.unique_values - e.unique_values) <= max(2, 0.05 * e.unique_values)


def test_quality_and_dedup_do_not_depend_on_partitioning(spark):
    from ledgerline.operators import quality as Q
    from ledgerline.sources import raw_views as R
    base = R.docs_raw(spark, "/root/testdata/sf0.001")
    cols = R.DOCS_COLUMNS

    def results(df):
        vc = Q.value_counts(df, cols, "row_id")
        return (tuple(Q.summary(df, cols, vc, fingerprints=True).first()),
                sorted(map(tuple, Q.column_profile(vc).collect())),
                sorted(map(tuple, Q.rule_counts(vc, cols).collect())),
                sorted(r.row_id for r in Q.duplicate_rows(df, cols, "row_id", True).collect()))

    ref = results(base)
    for n in (1, 3, 11):
        assert results(base.repartition(n).orderBy(F.rand(n))) == ref


def test_rank_within_keeps_null_groups(spark):
    rows = [(1, None, 5), (2, None, 7), (3, "a", 1), (4, "a", 9), (5, None, 7)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    exp = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    for parts in (None, 1, 3):
        got = windows.rank_within(df, ["g"], "v", out="r", partitions=parts)
        assert sorted((r.id, r.r) for r in got.collect()) == \
            sorted((r.id, r.r) for r in exp.collect())


def test_exact_sums_do_not_depend_on_order(spark):
    """Plain numbers beyond 2 ** 53 cents, and doubles of every magnitude."""
    from fractions import Fraction
    from ledgerline.operators import quality as Q
    rnd = random.Random(6)
    plain = [f"{rnd.randint(-10 ** 15, 10 ** 15)}.{rnd.randint(0, 99):02d}" for _ in range(150)]
    plain += ["12345678901234567.25"] * 7 + ["1_000.5", "0", "-0", ".5", "7."]
    wide = ["1e300", "-1e300", "5e-324", "2.5E-310", "0.1234567891", "1e15", "-3.3333333333", "1e-5"]
    got = set()
    for parts in (1, 4, 13):
        df = spark.createDataFrame(list(enumerate(plain + wide)), "r bigint, amount string").repartition(parts)
        for vc in (Q.value_counts(df, ["amount"], "r"), Q.cells(df, ["amount"], "r")):
            nums = Q.classify(vc).where(F.col("data_type").isin(Q.NUMERIC_TYPES))
            r = Q.exact_sums(nums, ["pos"]).first()
            got.add((r["count"], r.s, r.mn, r.mx))
    exact = sum(Fraction(v.replace("_", "").rstrip(".")) for v in plain) + sum(Fraction(float(v)) for v in wide)
    assert got == {(len(plain) + len(wide), float(exact), -1e300, 1e300)}


def test_report_links_its_duplicate_rows(spark, tmpdir_fresh):
    from ledgerline.operators import quality as Q
    from ledgerline.sources import sinks
    rows = [(i, "a" if i % 3 else f"b{i}", "1.5" if i % 4 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "r bigint, name string, amount string").repartition(4)
    rep = Q.quality_report(df, ["name", "amount"], "r", "f.csv")
    seen, want = set(), []
    for i, a, b in rows:
        want += [i] if (a, b) in seen else []
        seen.add((a, b))
    r = rep.first()
    assert r.issues.duplicates["count"] == len(want) > 300
    assert sorted(x.r for x in Q.reported_duplicates(rep).collect()) == want
    vc = Q.value_counts(df, ["name", "amount"], "r")
    s = Q.summary(df, ["name", "amount"], vc).first()
    assert (r.summary.quality_score, r.summary.complete_rows) == (s.quality_score, s.complete_rows)
    assert r.column_analysis["amount"].numeric_stats["sum"] == Q.numeric_stats(vc).first()["sum"] == 675.0
    path = sinks.write_json_report(rep, f"{tmpdir_fresh}/report.json")
    back = sinks.read_json_report(rep, path)
    a, b = (sorted(map(tuple, Q.report_lines(x).collect()), key=str) for x in (rep, back))
    assert a == b and len(a) > 25
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 10


def test_array_kernels(spark, tmpdir_fresh):
    from ledgerline.plans import jobs
    rows = [(1, [100, 2000, None], [3, 6, 1]), (2, [], []), (3, None, None), (4, [5000], [2])]
    df = spark.createDataFrame(rows, "id int, prices array<bigint>, quantities array<bigint>")
    out = jobs.array_rules(df)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.id: r for r in out.collect()}
    assert got[1].revenue == [300, 12000, None] and got[1].total_revenue == 12300
    assert got[1].category == ["LOW_VALUE", "HIGH_VALUE", "LOW_VALUE"] and got[1].high_items == 1
    assert (got[2].items, got[2].total_revenue, got[3].items, got[3].revenue) == (0, 0, 0, None)
    assert got[4].category == ["MEDIUM_VALUE"]
    path = jobs.array_rules_csv(out.select("id", "revenue", "category"), f"{tmpdir_fresh}/arrays")
    back = {r.id: r.revenue for r in spark.read.option("header", True).schema("id int, revenue string, category string").csv(path).collect()}
    assert back[1] == "300;12000;" and back[4] == "10000"
    with pytest.raises(Exception, match="different lengths"):
        jobs.array_rules(spark.createDataFrame([([1], [1, 2])], "prices array<int>, quantities array<int>")).collect()
