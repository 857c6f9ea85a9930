"""Every registered query against its DuckDB oracle (sf0.001), and every
rows-only query runs."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.sources.tables import TABLES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_queries_match_oracle(spark, duck):
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    bad = []
    for k, fn in qs.items():
        df = fn(spark, SF)
        srows = [tuple(r) for r in df.collect()]
        if k not in orc:
            continue
        cur = duck.execute(orc[k])
        dcols = [c[0] for c in cur.description]
        drows = cur.fetchall()
        if sorted(df.columns) != sorted(dcols):
            bad.append((k, "columns", df.columns, dcols))
        elif rows_of(df.columns, srows) != rows_of(dcols, drows):
            bad.append((k, "values", len(srows), len(drows)))
    assert not bad, bad


NO_BROADCAST_KEYS = ["agg_region", "agg_product", "agg_daily_customers", "agg_filtered",
                     "proj_revenue", "join_three", "anti_orders", "anti_customers",
                     "anti_orders_items", "chk_fk", "rec_allclose", "rec_row_check",
                     "join_region_revenue", "win_rank_region", "win_top_customer",
                     "ts_daily_full", "dup_rows", "dup_drop", "dq_summary_docs",
                     "insp_describe", "job_clean_aggregate_region", "job_rules_arrays"]


def test_no_broadcast_plans_match_oracle(spark, duck):
    """Broadcast joins off: every join is a sort-merge join; results stay
    exact."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    qs, orc = E.queries(), E.oracle_sql()
    bad = []
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for k in NO_BROADCAST_KEYS:
            df = qs[k](spark, SF)
            if k != "insp_describe":     # its one-row-per-column side is hinted on purpose
                assert "BroadcastHashJoin" not in \
                    df._jdf.queryExecution().executedPlan().toString(), k
            cur = duck.execute(orc[k])
            dcols = [c[0] for c in cur.description]
            if rows_of(df.columns, [tuple(r) for r in df.collect()]) != \
                    rows_of(dcols, cur.fetchall()):
                bad.append(k)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert not bad, bad
