"""Rewritten tables give fresh answers; counts past BIGINT; lost orders."""

import os
import shutil

import pytest

import __spark_entry__ as E
from ledgerline import session
from ledgerline.operators import quality as Q
from ledgerline.operators import reconcile

SF = "/root/testdata/sf0.001"
NAMES = ["region", "nation", "customer", "part", "orders", "lineitem"]


def test_rewritten_tables_are_read_afresh(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "sf")
    os.makedirs(d)
    for n in NAMES:
        shutil.copy(f"{SF}/{n}.parquet", f"{d}/{n}.parquet")
    qs = E.queries()
    before = {r.region for r in qs["agg_region"](spark, d).collect()}
    rows = qs["src_csv_raw"](spark, d).count()
    renamed = spark.read.parquet(f"{SF}/region.parquet").selectExpr(
        "r_regionkey", "concat('new ', r_name) AS r_name")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").limit(100)
    renamed.write.mode("overwrite").parquet(f"{d}/region.parquet")
    lines.write.mode("overwrite").parquet(f"{d}/lineitem.parquet")
    assert {r.region for r in qs["agg_region"](spark, d).collect()} <= {f"new {r}" for r in before}
    assert rows > 100 and qs["src_csv_raw"](spark, d).count() == 100


def test_product_of_counts_past_bigint(spark):
    n = 3_000_000
    df = spark.createDataFrame([(n, n, n)], "a bigint, b bigint, c bigint")
    assert int(df.select(reconcile.product_of_counts("a", "b", "c")).first()[0]) == n ** 3 > 2 ** 63


def test_lost_and_extra_orders_are_reported(spark):
    schema = "order_id bigint, quantity bigint, price bigint"
    items = spark.createDataFrame([(1, 2, 5), (1, 1, 1), (2, 1, 7)], schema)
    joined = spark.createDataFrame([(1, 2, 5), (1, 1, 1), (3, 1, 1)], schema)
    got = {r.order_id: (r.expected_revenue, r.actual_revenue, r.revenue_matches)
           for r in reconcile.order_revenue_check(items, joined).collect()}
    assert got == {1: (11, 11, True), 2: (7, None, False), 3: (None, 1, False)}


def test_every_duplicate_row_is_listed(spark):
    df = spark.range(300).selectExpr("id AS row_id", "'same' AS text")
    rows = sorted(r.row_id for r in Q.duplicate_rows(df, ["text"], "row_id").collect())
    assert rows == list(range(1, 300))


def test_unshared_scratch_is_refused_off_local(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_shuffle_partitions_follow_the_input(spark):
    tb = 1 << 40
    assert session.shuffle_partitions_for(100 * tb) == 100 * tb // (256 << 20)
