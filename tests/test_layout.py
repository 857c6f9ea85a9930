"""Bucketed copies join without an exchange and give the same rows."""

from pyspark.sql import functions as F

from ledgerline.sources import layout
from ledgerline.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_bucketed_join_has_no_exchange(spark):
    tables = layout.bucket_by_order(spark, SF, 4, database="ledgerline_test")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        j = layout.lines_with_orders(spark, tables).select("l_orderkey", "l_linenumber", "o_custkey")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = read_table(spark, SF, "lineitem").join(
            read_table(spark, SF, "orders"), F.col("l_orderkey") == F.col("o_orderkey")) \
            .select("l_orderkey", "l_linenumber", "o_custkey")
        assert sorted(map(tuple, j.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
