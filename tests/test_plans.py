"""Physical-plan checks on every registered query (sf0.001)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_no_pair_joins_or_python_udfs(spark):
    bad = []
    for k, fn in E.queries().items():
        p = plan(fn(spark, SF))
        for tok in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                    "ArrowEvalPython"):
            if tok in p:
                bad.append((k, tok))
    assert not bad


@pytest.mark.parametrize("key", ["anti_orders", "anti_customers", "anti_orders_items", "chk_fk"])
def test_anti_joins_are_left_anti(spark, key):
    assert "LeftAnti" in plan(E.queries()[key](spark, SF))


@pytest.mark.parametrize("key", ["win_top2_region", "win_top3_products"])
def test_topk_uses_window_group_limit(spark, key):
    assert "WindowGroupLimit" in plan(E.queries()[key](spark, SF))


def test_region_filter_reaches_the_region_scan(spark):
    df = E.queries()["agg_filtered"](spark, SF)
    assert "EqualTo(r_name,AMERICA)" in formatted(df)


def test_projection_pruned_at_scan(spark):
    df = E.queries()["agg_daily"](spark, SF)
    s = formatted(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in s


def test_top_customer_is_one_aggregate_not_a_window(spark):
    p = plan(E.queries()["win_top_customer"](spark, SF))
    assert "Window" not in p.replace("WindowGroupLimit", "")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "total_revenue", "order_count"] and df.count() == 5
