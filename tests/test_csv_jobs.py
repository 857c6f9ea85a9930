"""Jobs on small CSV files, each written with a leading blank line."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean
from ledgerline.operators import quality as Q
from ledgerline.plans import jobs
from ledgerline.sources import csv as C
from ledgerline.sources import sinks
from tests.conftest import write
from tests.fixtures import LIMITS_CSV, PAYMENTS_CSV, PEOPLE_CSV, SHOP_CSV, SHOP_SCHEMA


def typed(spark, d, name, text, schema=SHOP_SCHEMA):
    return C.read_csv_typed(spark, write(os.path.join(d, name), text), schema) \
        .drop("malformed", "bad_cells")


def test_clean_sales_data(spark, tmpdir_fresh):
    df = typed(spark, tmpdir_fresh, "shop.csv", SHOP_CSV)
    assert df.count() == 7 and df.where(F.col("quantity").isNull()).count() == 1
    out = jobs.clean_sales_data(df, "Hills", 1)
    assert sorted(r.order_id for r in out.collect()) == [35, 36]
    assert [r.order_id for r in jobs.clean_sales_data(df, "Plain", 0).collect()] == [34]   # once


def test_sales_analytics(spark, tmpdir_fresh):
    res = jobs.sales_analytics(typed(spark, tmpdir_fresh, "shop.csv", SHOP_CSV))
    assert {r.product: r.total_revenue for r in res["product"].collect()} == \
        {"Barrow": 35600, "Rake": 9500, "Twine": 1500}
    assert {r.region: r.total_revenue for r in res["region"].collect()} == \
        {"Hills": 21200, "Plain": 17800, "Coast": 7600}
    assert [r.product for r in res["top"].collect()] == ["Barrow", "Rake"]


def test_regional_sales(spark, tmpdir_fresh):
    res = jobs.regional_sales(typed(spark, tmpdir_fresh, "shop.csv", SHOP_CSV), 8900)
    assert [tuple(r) for r in res["summary"].collect()] == [
        ("Hills", 21200.0, 9.0), ("Plain", 8900.0, 1.0), ("Coast", 7600.0, 4.0)]
    assert [r.Region for r in res["low"].collect()] == ["Coast"]       # at the limit is not below
    out = sinks.write_csv(res["low"], os.path.join(tmpdir_fresh, "low"))
    assert sinks.read_back_csv(res["low"], out).count() == 1
    none = res["summary"].where("Total_Revenue < 0")
    out = sinks.write_csv(none, os.path.join(tmpdir_fresh, "none"))
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 0 and back.columns == ["Region", "Total_Revenue", "Total_Quantity"]


def test_clean_and_aggregate(spark, tmpdir_fresh):
    res = jobs.clean_and_aggregate(typed(spark, tmpdir_fresh, "shop.csv", SHOP_CSV))
    assert res["clean"].count() == 5
    assert [tuple(r) for r in res["product"].collect()] == [("Barrow", 26700.0), ("Rake", 9500.0), ("Twine", 1500.0)]
    assert [tuple(r) for r in res["region"].collect()] == [("Hills", 21200.0), ("Plain", 8900.0), ("Coast", 7600.0)]


def test_business_rules(spark, tmpdir_fresh):
    df = typed(spark, tmpdir_fresh, "limits.csv", LIMITS_CSV, jobs.RULES_FILE)
    out = jobs.business_rules_engine(df, high=10_000, medium=2_000)
    assert {r.transaction_id: (r.revenue, r.category) for r in out.collect()} == {
        "at-medium": (2000, "MEDIUM"), "below-medium": (1999, "LOW"), "at-high": (10000, "MEDIUM"),
        "above-high": (10001, "HIGH")}


def test_vectorized_rules(spark):
    arr = spark.createDataFrame([([40, 701, 350, 9], [5, 1, 2, 11])],
                                "prices array<bigint>, quantities array<bigint>")
    out = jobs.vectorized_rules(arr, high=700, medium=200).collect()
    assert [r.revenue for r in out] == [200, 701, 700, 99]
    assert [r.category for r in out] == ["MEDIUM_VALUE", "HIGH_VALUE", "MEDIUM_VALUE", "LOW_VALUE"]
    bad = spark.createDataFrame([([1, 2], [1])], "prices array<bigint>, quantities array<bigint>")
    with pytest.raises(Exception):
        jobs.vectorized_rules(bad).collect()


def test_clean_users(spark, tmpdir_fresh):
    raw = C.read_csv_raw(spark, write(os.path.join(tmpdir_fresh, "people.csv"), PEOPLE_CSV))
    out = clean.clean_users(raw.drop("malformed"))
    assert [tuple(r) for r in out.collect()] == [
        ("a", "Noor", "41", "noor@garden.example"), ("c", "Ola", "UNKNOWN", None),
        ("d", "Pim", "UNKNOWN", "pim@garden.example")]
    edge = spark.createDataFrame([("5", "  ", "7", "A@B.C"), ("6", "Eve", " +007 ", " X@Y.Z "),
                                  ("7", "Ann", "28.0", ""), ("8", "Al", "1_0", None)],
                                 "id string, name string, age string, email string")
    got = [tuple(r) for r in clean.clean_users(edge).collect()]
    assert got == [("6", "Eve", "7", "x@y.z"), ("7", "Ann", "UNKNOWN", ""), ("8", "Al", "10", None)]


def test_validate_users(spark):
    users = spark.createDataFrame([("1", "Alex", 28, "alex@example.com"), ("2", "", 35, "bob@example.com"),
                                   ("3", "Charlie", -2, "charlieexample.com"), ("4", "Diana", 22, None)],
                                  "id string, name string, age bigint, email string")
    f = [r.failed_fields for r in clean.failing_fields(users).collect()]
    assert f == ["", "name", "age,email", "email"]
    e = clean.validation_errors(users).collect()
    assert e[0].errors == [] and e[0].is_valid
    assert e[2].errors == ["❌ Age must be > 0, got -2",
                           "❌ Email must contain '@', got 'charlieexample.com'"]
    assert e[3].errors == ["❌ Email field is missing"]
    assert [r.name_ok for r in clean.min_length_rule(users).collect()] == [True, False, True, True]


def test_load_audit(spark, tmpdir_fresh):
    d = tmpdir_fresh
    write(f"{d}/valid_data.csv", "\nid,name,age\n1,Alex,28\n2,Bob,35\n3,Charlie,22\n")
    write(f"{d}/empty_file.csv", "\n")
    write(f"{d}/headers_only.csv", "\nid,name,age\n")
    write(f"{d}/zero.csv", "")
    write(f"{d}/latin1.csv", b"id,name\n1,\xe9t\xe9\n", "wb")
    paths = [f"{d}/{n}" for n in ["valid_data.csv", "missing_file.csv", "empty_file.csv",
                                  "headers_only.csv", "zero.csv", "latin1.csv"]]
    got = {os.path.basename(r.file_path): r for r in C.load_audit(spark, paths).collect()}
    assert got["valid_data.csv"].success and got["valid_data.csv"].row_count == 3
    assert got["valid_data.csv"].columns == ["id", "name", "age"]
    assert got["missing_file.csv"].error.startswith("File not found: ")
    assert got["empty_file.csv"].error == "CSV file has no headers"
    assert got["headers_only.csv"].error == "CSV file has headers but no data rows"
    assert got["zero.csv"].error.startswith("File is empty: ")
    assert got["latin1.csv"].error.startswith("File encoding error: ")


def test_short_and_long_rows(spark, tmpdir_fresh):
    p = write(f"{tmpdir_fresh}/ragged.csv", "a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    rows = C.read_csv_raw(spark, p).collect()
    assert [r.malformed for r in rows] == [False, True, True]
    assert rows[1].c is None


def test_quality_report_payments(spark, tmpdir_fresh):
    path = write(f"{tmpdir_fresh}/payments.csv", PAYMENTS_CSV)
    raw = C.with_row_ordinal(C.read_csv_raw(spark, path).drop("malformed"), "_row")
    cols = ["transaction_id", "customer_id", "amount", "currency", "status"]
    vc = Q.value_counts(raw, cols, "_row")
    s = Q.summary(raw, cols, vc).first()
    assert (s.total_rows, s.total_columns, s.complete_rows, s.completeness_percentage) == (5, 5, 4, 80.0)
    assert (s.empty_cells, s.duplicate_rows) == (2, 1)
    prof = {r.column_name: r for r in Q.column_profile(vc).collect()}
    a = prof["amount"]
    assert (a.data_type, a.type_confidence, a.missing_percentage, a.completeness_severity) == \
        ("integer", 100.0, 20.0, "medium")
    num = Q.numeric_stats(vc).first()
    assert (num.column_name, num["count"], num["sum"], num.average, num["min"], num["max"],
            num["range"]) == ("amount", 4, 35.0, 8.75, -20.0, 75.0, 95.0)
    invalid = {r.rule: r[1] for r in Q.rule_counts(vc, cols).toDF("rule", "n").collect()}
    assert invalid["amount_negative"] == 2 and s.invalid_values == sum(invalid.values())
    assert [r.recommendation for r in Q.recommendations(Q.column_profile(vc), Q.summary(raw, cols, vc)).collect()] \
        == ["Remove 1 duplicate rows (20.0% of total) to improve data quality"]
    small = {(r.section, r.item): r.value for r in Q.small_report(raw, cols).collect()}
    assert small[("row_count", "rows")] == 5 and small[("missing_values", "customer_id")] == 1
    rep = jobs.analyze_csv(spark, path, tmpdir_fresh)
    r = rep.first()
    assert r.summary.quality_score == s.quality_score and r.issues.duplicates["count"] == 1
    import json
    js = json.loads(rep.select(F.to_json("column_analysis")).first()[0])
    assert list(js) == cols                        # column order kept in the report
    assert any(f.startswith("quality_report_payments.csv_") for f in os.listdir(tmpdir_fresh))


def test_quality_duplicates_and_recommendations(spark):
    rows = [(1, "a", "x", " 1 "), (2, "a", "x", "1"), (3, "b", None, "one"), (4, "b", None, "one"),
            (5, "c", "x", "two"), (6, "c", None, "three"), (7, "d", "x", "2"), (8, "e", None, "3")]
    df = spark.createDataFrame(rows, "r bigint, a string, b string, c string")
    cols = ["a", "b", "c"]
    vc = Q.value_counts(df, cols, "r")
    s = Q.summary(df, cols, vc).first()
    assert s.duplicate_rows == 2 and s.quality_score == 85.83
    assert [r.r for r in Q.duplicate_rows(df, cols, "r").orderBy("r").collect()] == [2, 4]
    prof = {r.column_name: r for r in Q.column_profile(vc).collect()}
    assert (prof["c"].data_type, prof["c"].type_confidence) == ("integer", 50.0)  # tie: seen first
    recs = [r.recommendation for r in
            Q.recommendations(Q.column_profile(vc), Q.summary(df, cols, vc)).collect()]
    assert recs == ["Consider data imputation for columns with >20% missing values: b",
                    "Remove 2 duplicate rows (25.0% of total) to improve data quality",
                    "Column 'c' has mixed data types. Consider standardizing to integer"]


def test_report_error_form(spark, tmpdir_fresh):
    r = jobs.analyze_csv(spark, f"{tmpdir_fresh}/nope.csv").first()
    assert r.status == "error" and r.error_message.startswith("File not found")
    assert sinks.write_json_report(jobs.analyze_csv(spark, f"{tmpdir_fresh}/nope.csv"),
                                   f"{tmpdir_fresh}/x.json") is None


def test_report_headers_only_and_no_headers(spark, tmpdir_fresh):
    p = write(f"{tmpdir_fresh}/headers_only.csv", "\nid,name,age\n")
    r = jobs.analyze_csv(spark, p).first()
    assert (r.summary.total_rows, r.summary.quality_score, r.summary.quality_rating) == \
        (0, 0.0, "Critical 🚨")
    assert r.column_analysis == {} and r.issues.duplicates["count"] == 0
    p = write(f"{tmpdir_fresh}/empty_file.csv", "\n")
    r = jobs.analyze_csv(spark, p).first()
    assert r.status == "error" and r.error_message == "CSV file has no headers"


def test_load_audit_same_folder_spelled_two_ways(spark, tmpdir_fresh):
    p = write(f"{tmpdir_fresh}/a.csv", "x,y\n1,2\n3,4\n")
    got = C.load_audit(spark, [f"file:{p}", f"{tmpdir_fresh}/missing.csv"]).collect()
    assert sorted((r.success, r.row_count) for r in got) == [(False, None), (True, 2)]


def test_analyze_csv_at_table_scale_matches_table_path(spark, tmpdir_fresh):
    """E07 on a CSV export of the whole txn view (sf0.01, 15,000 rows):
    the report read from the file equals the oracle-checked table queries."""
    from ledgerline.sources import raw_views as R
    d = "/root/testdata/sf0.01"
    txn = R.txn_raw(spark, d)
    folder = os.path.join(tmpdir_fresh, "txn")
    txn.orderBy("row_id").drop("row_id").coalesce(1).write.option("header", True).csv(folder)
    path = [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".csv")][0]
    rep = jobs.analyze_csv(spark, path).first()
    want = Q.summary(txn, R.TXN_COLUMNS, Q.value_counts(txn, R.TXN_COLUMNS, "row_id")).first()
    got = rep.summary
    for f in ("total_rows", "complete_rows", "completeness_percentage", "quality_score",
              "quality_rating"):
        assert got[f] == want[f], f
    prof = {r.column_name: r for r in
            Q.column_profile(Q.value_counts(txn, R.TXN_COLUMNS, "row_id")).collect()}
    for c, stats in rep.column_analysis.items():
        assert stats.missing_count == prof[c].missing_count
        assert stats.data_type == prof[c].data_type
        assert stats.unique_values == prof[c].unique_values


def test_sales_analytics_totals_and_rule_distribution(spark, tmpdir_fresh):
    t = jobs.sales_analytics(typed(spark, tmpdir_fresh, "shop.csv", SHOP_CSV))["totals"].first()
    assert (t.total_revenue, t.average_order_value) == (46600.0, 46600.0 / 6)
    limits = typed(spark, tmpdir_fresh, "limits.csv", LIMITS_CSV, jobs.RULES_FILE)
    dist = [tuple(r) for r in jobs.category_distribution(
        jobs.business_rules_engine(limits, 10_000, 2_000)).collect()]
    assert dist == [("MEDIUM", 2, 12000), ("HIGH", 1, 10001), ("LOW", 1, 1999)]


def test_load_audit_unreadable_and_unrequested_files(spark, tmpdir_fresh):
    d = tmpdir_fresh
    ok = write(f"{d}/ok.csv", "a,b\n1,2\n")
    locked = write(f"{d}/locked.csv", "a,b\n1,2\n")
    os.chmod(locked, 0)
    bad_gz = write(f"{d}/broken.csv.gz", b"not gzip at all", "wb")
    write(f"{d}/other.csv", b"x\n\xff\xfe\n", "wb")      # in the folder, not requested
    got = {os.path.basename(r.file_path): r for r in C.load_audit(spark, [ok, locked, bad_gz]).collect()}
    assert set(got) == {"ok.csv", "locked.csv", "broken.csv.gz"}
    assert got["ok.csv"].success and got["ok.csv"].row_count == 1
    assert got["locked.csv"].error.startswith("Permission denied: ")
    assert got["broken.csv.gz"].error.startswith("Unexpected error: could not read ")


def test_pandas_group_semantics_missing_key(spark, tmpdir_fresh):
    text = "order_id,region,product,quantity,price\n1,,Mouse,2,10\n2,East,Mouse,1,10\n3,East,,x,5\n"
    df = typed(spark, tmpdir_fresh, "k.csv", text)
    res = jobs.sales_analytics(df)
    assert {r.region: r.total_revenue for r in res["region"].collect()} == {"East": 10.0}
    assert {r.product: r.total_revenue for r in res["product"].collect()} == {"Mouse": 30.0}
    assert res["totals"].first().total_revenue == 30.0      # missing keys kept in totals


def test_json_report_file_round_trip(spark, tmpdir_fresh):
    import glob
    import json
    path = write(f"{tmpdir_fresh}/payments.csv", PAYMENTS_CSV)
    jobs.analyze_csv(spark, path, tmpdir_fresh)
    parts = glob.glob(f"{tmpdir_fresh}/quality_report_payments.csv_*.json/part-*")
    assert len(parts) == 1
    text = open(parts[0], encoding="utf-8").read()
    rep = json.loads(text)
    assert list(rep) == ["metadata", "summary", "column_analysis", "issues", "recommendations"]
    rating = rep["summary"]["quality_rating"]
    assert not rating.isascii() and rating in text                        # UTF-8 kept
    assert rep["column_analysis"]["amount"]["numeric_stats"]["sum"] == 35.0
    assert rep["issues"]["invalid_values"]["amount_negative"] == 2
    assert rep["metadata"]["file_name"] == "payments.csv"
