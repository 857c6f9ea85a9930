"""Jobs from file to file: order, whole sets of outputs, fractions."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import jobs
from ledgerline.sources import publish as P
from tests.conftest import write


def lines_of(folder):
    """Data lines over the part files in the order of their names."""
    out = []
    for name in sorted(f for f in os.listdir(folder) if f.endswith(".csv")):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out += f.read().splitlines()[1:]
    return out


def test_cleaned_users_keep_the_order_of_many_files(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    os.makedirs(src)
    want = []
    # later files are larger, so tasks read them first
    for part in range(4):
        rows = []
        for i in range(20 * (part * 40 + 1)):
            name = "" if i % 7 == 3 else f"  n{part}-{i}"
            rows.append(f"{part}-{i},{name},{i % 5 - 1}, X{i}@Y.ORG ")
            if name:
                want.append(f"{part}-{i},{name},{i % 5 - 1 if i % 5 > 1 else 'UNKNOWN'},x{i}@y.org")
        write(f"{src}/part-{part}.csv", "id,name,age,email\n" + "\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        got = jobs.run_clean_users(spark, src, f"{tmpdir_fresh}/out")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert lines_of(got["paths"]["clean_users"]) == want       # blanks of a name are kept
    assert got["steps"] == {"loaded": sum(20 * (p * 40 + 1) for p in range(4)), "kept": len(want)}


def test_clean_sales_file_keeps_first_of_equal_rows(spark, tmpdir_fresh):
    src = write(f"{tmpdir_fresh}/s.csv", "order_id,region,product,quantity,price\n"
                "9,N,b,2,1.5\n8,N,a,,3\n7,S,a,4,3\n9,N,b,2,1.5\n5,N,c,3,2\n4,N,c,1,2\n")
    got = jobs.run_clean_sales(spark, src, f"{tmpdir_fresh}/out", "N", 1)
    assert lines_of(got["paths"]["clean_sales"]) == ["9,N,b,2.0,1.5", "5,N,c,3.0,2.0"]
    assert got["steps"] == {"loaded": 6, "filtered": 3, "distinct": 2}


def test_sales_analytics_files_and_totals(spark, tmpdir_fresh):
    src = write(f"{tmpdir_fresh}/s.csv", "order_id,region,product,quantity,price\n"
                "1,N,a,2,1.25\n2,,a,1,4\n3,S,b,,9\n4,S,,3,0.5\n")
    got = jobs.run_sales_analytics(spark, src, f"{tmpdir_fresh}/out", top_n=1)
    assert lines_of(got["paths"]["revenue_per_product"]) == ["a,6.5", "b,0.0"]
    assert lines_of(got["paths"]["revenue_per_region"]) == ["N,2.5", "S,1.5"]
    assert lines_of(got["paths"]["top_products"]) == ["a,6.5"]
    assert got["totals"] == {"total_revenue": 8.0, "average_order_value": 8.0 / 3}   # missing keys count


def test_rules_file(spark, tmpdir_fresh):
    src = write(f"{tmpdir_fresh}/t.csv", "transaction_id,price,quantity\nz,7000,2\na,100,3\nm,,3\nk,3000,1\n")
    got = jobs.run_business_rules(spark, src, f"{tmpdir_fresh}/out")
    assert lines_of(got["paths"]["classified_transactions"]) == [
        "z,14000,HIGH", "a,300,LOW", "m,,LOW", "k,3000,MEDIUM"]
    assert lines_of(got["paths"]["category_summary"]) == ["LOW,2,300", "HIGH,1,14000", "MEDIUM,1,3000"]


def test_empty_input_gives_headers(spark, tmpdir_fresh):
    src = write(f"{tmpdir_fresh}/t.csv", "transaction_id,price,quantity\n")
    got = jobs.run_business_rules(spark, src, f"{tmpdir_fresh}/out")
    back = spark.read.option("header", True).csv(got["paths"]["classified_transactions"])
    assert back.columns == ["transaction_id", "revenue", "category"] and back.count() == 0


def test_a_failed_run_leaves_the_earlier_outputs(spark, tmpdir_fresh):
    folder = f"{tmpdir_fresh}/out"
    assert P.published(spark, folder) == {}
    first = P.publish(spark, folder, {"a": spark.range(3), "b": spark.range(2)})
    assert P.published(spark, folder) == first
    broken = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception):
        P.publish(spark, folder, {"a": spark.range(9), "b": broken})
    assert P.published(spark, folder) == first and spark.read.csv(first["a"], header=True).count() == 3
    assert len([f for f in os.listdir(folder) if f.startswith("run-")]) == 1
    second = P.publish(spark, folder, {"a": spark.range(9)})
    assert P.published(spark, folder) == second
    assert P.drop_earlier_runs(spark, folder) == 1 and spark.read.csv(second["a"], header=True).count() == 9


def test_scratch_tables_go_after_use(spark):
    from ledgerline.session import scratch_table
    with scratch_table(spark.range(5).toDF("x"), "t") as t:
        path = t.inputFiles()[0].removeprefix("file://")
        assert t.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)
