"""Edge frames: empty input, an all-NULL column, whitespace-only text."""

from pyspark.sql import functions as F

from ledgerline.operators import aggregate as agg, dedup, inspect, windows
from ledgerline.operators import quality as Q
from tests.fixtures import SALES_SCHEMA


def test_empty_sales(spark):
    e = spark.createDataFrame([], SALES_SCHEMA)
    assert agg.by_region(e).count() == 0
    t = agg.total(e).first()
    assert (t.total_revenue, t.total_orders) == (None, 0)
    assert windows.trend_na(e).count() == 0
    assert windows.rank_in_region(e).count() == 0
    assert windows.top_customer_per_region(e).count() == 0
    assert dedup.duplicate_count(e).first().total_rows == 0


def test_empty_and_all_null_profile(spark):
    e = spark.createDataFrame([], "r bigint, a string, b string")
    s = Q.summary(e, ["a", "b"]).first()
    assert (s.total_rows, s.quality_score, s.quality_rating) == (0, 0.0, "Critical 🚨")
    rows = [(1, None, "  "), (2, None, "\t"), (3, None, "x")]
    df = spark.createDataFrame(rows, "r bigint, a string, b string")
    vc = Q.value_counts(df, ["a", "b"], "r")
    prof = {p.column_name: p for p in Q.column_profile(vc).collect()}
    assert (prof["a"].missing_count, prof["a"].data_type, prof["a"].type_confidence) == \
        (3, "unknown", 0.0)
    assert (prof["b"].missing_count, prof["b"].unique_values, prof["b"].min_length) == (2, 1, 1)
    assert Q.summary(df, ["a", "b"], vc).first().complete_rows == 0


def test_describe_and_quantiles_on_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    d = inspect.describe(df, ["x"]).first()
    assert d["count"] == 0 and d.p50 is None
    ok = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert inspect.describe(ok, ["x"]).first().p50 == 2.0    # NaN skipped


def test_ratios_on_empty_input_do_not_raise(spark):
    o = spark.createDataFrame([], "order_id int, customer_id string, order_date date")
    i = spark.createDataFrame([], "order_id int, product string, quantity int, price int")
    r = agg.items_ratio(o, i).first()
    assert (r.orders, r.order_items, r.avg_items_per_order) == (0, 0, None)
    e = spark.createDataFrame([], SALES_SCHEMA)
    a = agg.average(e).first()
    assert (a.avg_order_value, a.avg_order_value_manual) == (None, None)


def test_validation_on_huge_and_odd_ages(spark):
    from ledgerline.operators import clean
    raw = spark.createDataFrame([("1", "A", "123456789012345678901234567890", "a@b.c"),
                                 ("2", "B", "-7", "b@c.d"), ("3", "C", "7.5", "x")],
                                "id string, name string, age string, email string")
    got = {r.id: r for r in clean.validation_errors(clean.typed_users(raw)).collect()}
    assert got["1"].is_valid
    assert got["2"].errors == ["❌ Age must be > 0, got -7"]
    assert got["3"].errors == ["❌ Age field is missing", "❌ Email must contain '@', got 'x'"]


def test_headers_with_dots_and_spaces(spark, tmpdir_fresh):
    import os
    from ledgerline.plans import jobs
    from tests.conftest import write
    p = write(os.path.join(tmpdir_fresh, "odd.csv"),
              "unit.price,a b,total amount\n1.5,x,2\n1.5,x,2\n,y,-1\n")
    rep = jobs.analyze_csv(spark, p).first()
    assert rep.summary.total_rows == 3 and rep.issues.duplicates["count"] == 1
    assert rep.issues.invalid_values == {"total amount_negative": 1}
    df = spark.createDataFrame([(1, "a", "b"), (2, "a", "b")], "`r.id` int, `x.y` string, `p q` string")
    assert [r[0] for r in dedup.duplicate_rows(df, ["x.y", "p q"], "r.id").collect()] == [2]
    assert [r[0] for r in dedup.duplicate_rows(df, ["x.y", "p q"], "r.id", True).collect()] == [2]
    assert dedup.duplicate_count(df.drop("r.id")).first().duplicate_rows == 1
    assert inspect.null_counts(df).count() == 3


def test_row_ordinals_follow_file_order_across_splits(spark, tmpdir_fresh):
    import os
    from ledgerline.sources import csv as C
    from tests.conftest import write
    p = write(os.path.join(tmpdir_fresh, "big.csv"),
              "\nn,pad\n" + "".join(f"{i},{'x' * 40}\n" for i in range(1, 3001)))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        raw = C.read_csv_raw(spark, p)
        assert raw.rdd.getNumPartitions() > 10
        got = [(int(r.n), r.row_number) for r in C.with_row_ordinal(raw).collect()]
    finally:
        spark.conf.set(key, old)
    assert sorted(got) == [(i, i) for i in range(1, 3001)]


def test_load_audit_header_and_rows_across_splits(spark, tmpdir_fresh):
    import os
    from ledgerline.sources import csv as C
    from tests.conftest import write
    p = write(os.path.join(tmpdir_fresh, "big.csv"),
              "\n\nn,pad\n" + "".join(f"{i},{'y' * 40}\n" for i in range(1, 2001)))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        r = C.load_audit(spark, [p]).first()
    finally:
        spark.conf.set(key, old)
    assert (r.success, r.row_count, r.columns) == (True, 2000, ["n", "pad"])


def test_row_ordinals_over_a_folder_of_files(spark, tmpdir_fresh):
    """Files are numbered in path order however tasks pack their splits."""
    import os
    from ledgerline.sources import csv as C
    from tests.conftest import write
    want, n = [], 0
    for part, rows in (("part0", 3), ("part1", 900), ("part2", 40), ("part3", 0), ("part4", 1)):
        lines = [str(n + i) for i in range(1, rows + 1)]
        n += rows
        want += lines
        write(os.path.join(tmpdir_fresh, f"{part}.csv"), "\nn,pad\n" + "".join(f"{x},{'z' * 30}\n\n" for x in lines))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        for size in ("2k", "1m"):
            spark.conf.set(key, size)
            raw = C.read_csv_raw(spark, tmpdir_fresh)
            got = C.with_row_ordinal(raw, "at").select("n", "at").collect()
            assert [r.n for r in sorted(got, key=lambda r: r.at)] == want
            assert sorted(r.at for r in got) == list(range(1, n + 1))
    finally:
        spark.conf.set(key, old)


def test_quoted_header_in_load_audit(spark, tmpdir_fresh):
    import os
    from ledgerline.sources import csv as C
    from tests.conftest import write
    for name, header, want in (("a", '"a,b",c', ["a,b", "c"]), ("b", 'x,"say ""hi""",', ["x", 'say "hi"', ""]),
                               ("c", '"",d e,"f"', ["", "d e", "f"]), ("d", "plain", ["plain"])):
        p = write(os.path.join(tmpdir_fresh, f"{name}.csv"), f"{header}\n1,2,3\n")
        assert C.load_audit(spark, [p]).first().columns == want
