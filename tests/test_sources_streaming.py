"""Inline rows, schemas, the generator, CSV runners and incremental runs."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerline.operators import clean
from ledgerline.plans import jobs
from ledgerline.sources import inline, schemas
from ledgerline.streaming import folders
from tests.conftest import write
from tests.fixtures import SHOP_CSV


def test_values_and_schema(spark):
    df = inline.values(spark, [(1001, dt.date(2024, 1, 1), "C001", "East", "Keyboard", 2, 1500)],
                       schemas.schema(schemas.SALES))
    assert df.dtypes[1] == ("order_date", "date") and df.count() == 1


def test_random_sales_ranges_and_seed(spark):
    a = inline.random_sales(spark, 20000, seed=5)
    r = a.agg(F.min("price"), F.max("price"), F.min("quantity"), F.max("quantity")).first()
    assert r[0] >= 100 and r[1] < 10000 and r[2] >= 1 and r[3] < 10
    b = inline.random_sales(spark, 20000, seed=5)
    assert a.exceptAll(b).count() == 0


def test_run_clean_and_aggregate_writes_three_outputs(spark, tmpdir_fresh):
    src = write(os.path.join(tmpdir_fresh, "sales_raw.csv"), SHOP_CSV)
    res = jobs.run_clean_and_aggregate(spark, src, os.path.join(tmpdir_fresh, "out"))
    assert res["steps"] == {"loaded": 7, "drop_duplicates": 6, "dropna_quantity": 5}
    back = {k: spark.read.option("header", True).csv(v) for k, v in res["paths"].items()}
    assert back["clean"].count() == 5
    assert {r.product: float(r.total_revenue) for r in back["product"].collect()} == \
        {"Barrow": 26700.0, "Rake": 9500.0, "Twine": 1500.0}


def test_run_regional_empty_split_has_header(spark, tmpdir_fresh):
    src = write(os.path.join(tmpdir_fresh, "regional.csv"), SHOP_CSV)
    out = jobs.run_regional(spark, src, os.path.join(tmpdir_fresh, "out"), threshold=100)
    low = spark.read.option("header", True).csv(out["low_performing_regions"])
    assert low.count() == 0 and low.columns == ["Region", "Total_Revenue", "Total_Quantity"]


def test_process_new_files_incrementally(spark, tmpdir_fresh):
    inbox = os.path.join(tmpdir_fresh, "inbox")
    os.makedirs(inbox)
    out = os.path.join(tmpdir_fresh, "clean")
    write(os.path.join(inbox, "a.csv"), "id,name,age,email\n1,Alex,28,A@X.COM\n2, ,3,b@x\n")
    folders.process_new_files(spark, inbox, schemas.USERS_CSV, clean.clean_users, out, "users-test")
    assert spark.read.parquet(out).count() == 1
    write(os.path.join(inbox, "b.csv"), "id,name,age,email\n3,Cy,-4,c@x\n")
    folders.process_new_files(spark, inbox, schemas.USERS_CSV, clean.clean_users, out, "users-test")
    got = sorted((r.id, r.age, r.email) for r in spark.read.parquet(out).collect())
    assert got == [("1", "28", "a@x.com"), ("3", "UNKNOWN", "c@x")]


def test_daily_revenue_running(spark, tmpdir_fresh):
    inbox = os.path.join(tmpdir_fresh, "sales")
    os.makedirs(inbox)
    write(os.path.join(inbox, "a.csv"), "order_date,quantity,price\n2024-01-01,2,10\n2024-01-01,1,5\n"
                                        "2024-01-02,3,1\n")
    s = folders.csv_stream(spark, inbox, "order_date DATE, quantity BIGINT, price BIGINT")
    q = (folders.daily_revenue_running(s).writeStream.outputMode("complete").format("memory")
         .queryName("daily_rev_test").start())
    q.processAllAvailable()
    q.stop()
    got = {r.order_date.isoformat(): (r.daily_revenue, r.daily_orders)
           for r in spark.table("daily_rev_test").collect()}
    assert got == {"2024-01-01": (25, 2), "2024-01-02": (3, 1)}


def test_running_daily_revenue_over_table_export_equals_batch(spark, tmpdir_fresh):
    from ledgerline.operators import aggregate as agg
    from ledgerline.sources import bindings as b
    sales = b.sales(spark, "/root/testdata/sf0.001")
    folder = os.path.join(tmpdir_fresh, "sales_parts")
    sales.repartition(4).write.option("header", True).csv(folder)
    stream = folders.csv_stream(spark, folder, sales.schema.simpleString()[7:-1]
                                .replace(":", " "), max_files_per_trigger=1)
    q = (folders.daily_revenue_running(stream).writeStream.outputMode("complete")
         .format("memory").queryName("daily_rev_table").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.table("daily_rev_table").collect()))
    want = sorted(map(tuple, agg.daily(sales).collect()))
    assert got == want and len(got) > 100
