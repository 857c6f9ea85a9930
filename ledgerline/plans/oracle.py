"""DuckDB oracle SQL for the registered queries.

The views ``region nation customer ... conversations`` are the supplied
Parquet tables.  The reference relations are rebuilt as CTEs with the same
binding as ``ledgerline.sources.bindings``.  Conventions: SUM is cast to
BIGINT (DuckDB widens it to HUGEINT), RANK/LENGTH to BIGINT, and rounding
goes through DECIMAL so it is the decimal half-up rounding Spark does.
"""

from __future__ import annotations

SALES = """sales AS (
  SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date,
         o.o_custkey AS customer_id, r.r_name AS region, p.p_type AS product,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(ROUND(p.p_retailprice * 100) AS BIGINT) AS price
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

S_CUSTOMERS = """s_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, r.r_name AS region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

S_ORDERS = """s_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date FROM orders)"""

S_ITEMS = """s_items AS (
  SELECT l.l_orderkey AS order_id, p.p_type AS product,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(ROUND(p.p_retailprice * 100) AS BIGINT) AS price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

DOCS_LABELS = """docs_labels AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def round2(x: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {places}) AS DOUBLE)"
