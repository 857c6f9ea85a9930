"""SQL-script operators on small rows, held against plain Python."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import aggregate as agg, joins, reconcile, windows
from tests.fixtures import CUSTOMERS, ITEMS, ORDERS, SALES, SALES_SCHEMA


@pytest.fixture()
def sales(spark):
    return spark.createDataFrame(SALES, SALES_SCHEMA)


def sums(*key):
    """Revenue, rows and quantity of the sample sales by column positions."""
    out = defaultdict(lambda: [0, 0, 0])
    for r in SALES:
        cell = out[tuple(r[i] for i in key)]
        cell[0] += r[5] * r[6]
        cell[1] += 1
        cell[2] += r[5]
    return out


def test_total_and_average(sales):
    everything = sums()[()]
    t = agg.total(sales).first()
    assert (t.total_revenue, t.total_orders) == (everything[0], len(SALES))
    a = agg.average(sales).first()
    assert a.avg_order_value == pytest.approx(everything[0] / len(SALES))
    assert a.avg_order_value_manual == pytest.approx(everything[0] / len(SALES))


def test_region_and_product(sales):
    by_region = sorted(((k[0], v[0], v[1]) for k, v in sums(3).items()), key=lambda r: -r[1])
    assert [tuple(x) for x in agg.by_region(sales).collect()] == by_region
    by_product = sorted(((k[0], v[0], v[2], v[1]) for k, v in sums(4).items()), key=lambda r: -r[1])
    assert [tuple(x) for x in agg.by_product(sales).collect()] == by_product


def test_filtered_and_loss(sales):
    assert agg.filtered_region(sales, "Hills").first().total_revenue == sums(3)[("Hills",)][0]
    g = reconcile.group_loss(sales, "region").first()
    assert (g.total_rows, g.aggregated_rows, g.rows_match) == (len(SALES), len(SALES), True)
    assert reconcile.duplicate_keys(sales, "order_id").count() == 0
    assert [r.order_date.day for r in reconcile.duplicate_keys(sales, "order_date").orderBy("order_date").collect()] \
        == [6, 17]


def test_top_customer_and_segments(sales):
    spent = sums(3, 2)
    best = {}
    for (region, customer), v in sorted(spent.items()):
        if region not in best or v[0] > spent[region, best[region]][0]:
            best[region] = customer
    got = {r[0]: tuple(r)[1:4] for r in windows.top_customer_per_region(sales).collect()}
    assert got == {r: (c, spent[r, c][0], spent[r, c][1]) for r, c in best.items()}


def test_rolling_and_pct(sales):
    daily = sorted((d[0], v[0]) for d, v in sums(1).items())
    roll = [round(x.rolling_7day_avg, 2) for x in windows.rolling7(sales).collect()]
    want = [[v for _, v in daily[max(0, i - 6):i + 1]] for i in range(len(daily))]
    assert roll == [pytest.approx(sum(w) / len(w), abs=0.006) for w in want]
    rows = windows.trend_na(sales).collect()
    for i, row in enumerate(rows):
        before, now = (daily[i - 1][1] if i else None), daily[i][1]
        if not before:                       # the first day, or the day after the free sample
            assert row.percent_change is None
        else:
            assert row.percent_change == pytest.approx(100 * (now - before) / before, abs=0.006)
    assert len(rows) == len(daily) and rows[0].trend == "N/A"
    assert windows.trend_stable(sales).collect()[0].trend == "STABLE"
    grown = [i for i in range(1, len(daily)) if daily[i][1] > daily[i - 1][1]]
    assert [i for i, r in enumerate(rows) if "GROWTH" in r.trend] == grown


def test_zero_previous_day_and_ties(spark):
    import datetime as dt
    rows = [(1, dt.date(2024, 1, 1), "C1", "E", "A", 0, 100), (2, dt.date(2024, 1, 2), "C1", "E", "A", 1, 50),
            (3, dt.date(2024, 1, 3), "C2", "E", "B", 1, 100), (4, dt.date(2024, 1, 3), "C3", "W", "C", 1, 100)]
    s = spark.createDataFrame(rows, SALES_SCHEMA)
    pc = [x.percent_change for x in windows.trend_na(s).collect()]
    assert pc == [None, None, 300.0]     # previous day 0 -> NULL, no error
    rc = {x.product: (x.rank_value, x.dense_rank_value) for x in windows.rank_compare(s).collect()}
    assert rc == {"B": (1, 1), "C": (1, 1), "A": (3, 2)}
    tie = spark.createDataFrame([(1, dt.date(2024, 1, 1), "C1", "E", "A", 1, 100),
                                 (2, dt.date(2024, 1, 1), "C2", "E", "A", 1, 100),
                                 (3, dt.date(2024, 1, 1), "C3", "E", "A", 1, 10)], SALES_SCHEMA)
    top = windows.top2_customers_per_region(tie, 1).collect()
    assert sorted(r.customer_id for r in top) == ["C1", "C2"]          # ties kept
    one = windows.top_customer_per_region(tie).collect()
    assert [r.top_customer for r in one] == ["C1"]                      # tie: smallest id


def test_rank_region_and_top2(sales):
    spent = sums(3, 2)
    rank = {(r, c): 1 + sum(x[0] > v[0] for (q, _), x in spent.items() if q == r)
            for (r, c), v in spent.items()}
    got = {(x.region, x.customer_id): x.rank_in_region for x in windows.rank_in_region(sales).collect()}
    assert got == rank
    top = [(x.region, x.customer_id) for x in windows.top2_customers_per_region(sales).collect()]
    assert sorted(top) == sorted(k for k, n in rank.items() if n <= 2)


def test_join_goldens(spark):
    c = spark.createDataFrame(CUSTOMERS, "customer_id string, customer_name string, region string")
    o = spark.createDataFrame(ORDERS, "order_id int, customer_id string, order_date date")
    i = spark.createDataFrame(ITEMS, "order_id int, product string, quantity int, price int")
    assert joins.orders_without_customer(o, c).count() == 0
    assert [x.customer_name for x in joins.customers_without_order(c, o).collect()] == ["Diana"]
    assert joins.orders_customers_items(o, c, i).count() == 6
    assert joins.cross_count(o, c, i).first().cartesian_product_rows == 120
    rr = {x.region: x.total_revenue for x in joins.region_revenue(o, c, i).collect()}
    assert rr == {"West": 36000, "East": 5000, "South": 1500}
    per = [tuple(x) for x in agg.order_items_summary(o, i).collect()]
    assert per == [(1001, 2, 3500), (1002, 1, 12000), (1003, 1, 1500), (1004, 1, 1500), (1005, 1, 24000)]
    ratio = agg.items_ratio(o, i).first()
    assert (ratio.orders, ratio.order_items, ratio.avg_items_per_order) == (5, 6, 1.2)
    joined = o.join(c.select("customer_id"), "customer_id").join(i, "order_id")
    sums = {x.source: x.total_revenue for x in reconcile.labelled_sums(
        {"direct": i, "joined": joined}).collect()}
    assert sums == {"direct": 42500, "joined": 42500}
    f = reconcile.fanout(o, c, i, joined).first()
    assert (f.cartesian_product_rows, f.joined_rows, f.join_preserves_rows) == (120, 6, True)


def test_fk_and_keys(spark):
    o = spark.createDataFrame([(1, "a"), (2, None)], "order_id int, customer_id string")
    i = spark.createDataFrame([(1,), (3,), (None,)], "order_id int")
    assert [x.order_id for x in reconcile.orphans(i, o, "order_id").collect()] == [3]
    assert reconcile.null_keys(o, "customer_id").count() == 1


def test_allclose(spark):
    a = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, float("inf"))], "k int, x double")
    b = spark.createDataFrame([(1, 1.0 + 1e-9), (2, float("nan")), (3, float("inf"))], "k int, y double")
    r = reconcile.allclose(a, b, "k", "x", "y").first()
    assert (r.rows_compared, r.rows_different, r.all_close) == (3, 1, False)
    r = reconcile.allclose(a.where("k <> 2"), b.where("k <> 2"), "k", "x", "y").first()
    assert r.all_close is True
    r = reconcile.allclose(a.where("k = 1"), b, "k", "x", "y").first()   # missing rows fail
    assert r.all_close is False


def test_skip_missing_and_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 5.0)], "k string, v double")
    got = {x.k: x.total for x in agg.skip_missing(df, "k", "v").collect()}
    assert got == {"a": 1.0, "b": 0.0}
    g = spark.createDataFrame([("x", 10), ("y", 30), ("z", 30)], "k string, v bigint")
    s = agg.pipeline_summary(g, "k", "v").first()
    assert (s.group_count, s.total, s.best_group, s.best_value) == (3, 70, "y", 30)


def test_cross_preview_matches_bruteforce_product(spark):
    import itertools
    c = spark.createDataFrame(CUSTOMERS, "customer_id string, customer_name string, region string")
    o = spark.createDataFrame(ORDERS, "order_id int, customer_id string, order_date date")
    i = spark.createDataFrame(ITEMS, "order_id int, product string, quantity int, price int")
    for n in (1, 7, 20, 200):
        got = [tuple(r) for r in joins.cross_preview(
            [(o, ["order_id"]), (c, ["customer_name"]), (i, ["product", "quantity", "price"])],
            n).collect()]
        full = sorted((a[0], b[1], x[1], x[2], x[3])
                      for a, b, x in itertools.product(ORDERS, CUSTOMERS, ITEMS))
        assert got == full[:n]
    p = joins.cross_preview([(o, ["order_id"]), (c, ["customer_name"])], 5)
    assert "CartesianProduct" not in p._jdf.queryExecution().executedPlan().toString()


def test_top_customer_null_revenue_is_last(spark):
    import datetime as dt
    rows = [(1, dt.date(2024, 1, 1), "C1", "E", "A", None, 100),
            (2, dt.date(2024, 1, 1), "C2", "E", "A", 1, 5)]
    s = spark.createDataFrame(rows, SALES_SCHEMA)
    assert [r.top_customer for r in windows.top_customer_per_region(s).collect()] == ["C2"]
