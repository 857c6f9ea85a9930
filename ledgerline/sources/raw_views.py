"""Text-typed views with the faults of the reference's sample CSVs.

The supplied tables are clean and typed; the reference's quality and
cleaning jobs read hand-written CSVs with planted faults (missing cells,
negative and zero amounts, bad emails, bad dates, the missing words).  These
views derive such text rows from every row of a supplied table: the fault
kind is a fixed function of the row key, so each view is deterministic and
grows with its table.  The expressions are plain SQL so that Spark
(``selectExpr``) and the DuckDB oracle evaluate the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.tables import read_table

# --- fixed values: transaction rows from `orders` ---------------------------
_K, _C = "o_orderkey", "CAST(o_custkey AS STRING)"
_AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
TXN_COLUMNS = ["transaction_id", "customer_id", "customer_email", "amount", "currency",
               "status", "order_date"]
TXN_EXPRS = {
    "row_id": _K,
    "transaction_id": f"'T' || CAST({_K} AS STRING)",
    "customer_id": f"CASE WHEN {_K} % 53 = 0 THEN '' WHEN {_K} % 59 = 0 THEN 'C-' || {_C} "
                   f"ELSE 'C' || {_C} END",
    "customer_email": f"CASE WHEN {_K} % 47 = 0 THEN 'cust' || {_C} || '.example.com' "
                      f"WHEN {_K} % 43 = 0 THEN 'NULL' "
                      f"WHEN {_K} % 41 = 0 THEN 'cust@' || {_C} || '@example.com' "
                      f"ELSE ' Cust' || {_C} || '@Example.com ' END",
    "amount": f"CASE WHEN {_K} % 37 = 0 THEN '-' || {_AMOUNT} WHEN {_K} % 31 = 0 THEN '0' "
              f"WHEN {_K} % 29 = 0 THEN 'n/a' WHEN {_K} % 23 = 0 THEN '  ' ELSE {_AMOUNT} END",
    "currency": f"CASE WHEN {_K} % 19 = 0 THEN 'nan' WHEN o_orderpriority LIKE '1%' "
                f"THEN 'EUR' ELSE 'USD' END",
    "status": "o_orderstatus",
    "order_date": f"CASE WHEN {_K} % 17 = 0 THEN 'unknown' "
                  f"WHEN {_K} % 13 = 0 THEN replace({_DAY}, '-', '/') ELSE {_DAY} END",
}

# --- fixed values: user rows from `customer` --------------------------------
_U = "c_custkey"
USER_EXPRS = {
    "id": f"CAST({_U} AS STRING)",
    "name": f"CASE WHEN {_U} % 31 = 0 THEN '' WHEN {_U} % 37 = 0 THEN '   ' "
            f"WHEN {_U} % 61 = 0 THEN NULL ELSE c_name END",
    "age": f"CASE WHEN {_U} % 41 = 0 THEN NULL WHEN {_U} % 43 = 0 THEN '' "
           f"ELSE CAST(CAST(FLOOR(c_acctbal / 100) AS BIGINT) AS STRING) END",
    "email": f"CASE WHEN {_U} % 29 = 0 THEN NULL "
             f"WHEN {_U} % 23 = 0 THEN 'user' || CAST({_U} AS STRING) || 'example.com' "
             f"ELSE ' User' || CAST({_U} AS STRING) || '@Example.COM ' END",
}
# --- fixed values: poor transaction rows from `orders` ----------------------
POOR_COLUMNS = ["customer_id", "amount", "amount_negative", "status"]
POOR_EXPRS = {
    "row_id": _K,
    "customer_id": f"CASE WHEN {_K} % 4 = 0 THEN NULL ELSE 'C-' || CAST(o_custkey % 7 AS STRING) END",
    "amount": f"CASE WHEN {_K} % 3 = 0 THEN '' WHEN {_K} % 5 = 0 THEN '-5' WHEN {_K} % 7 = 0 THEN 'abc' "
              f"ELSE '10.5' END",
    "amount_negative": f"CASE WHEN {_K} % 2 = 0 THEN '1' ELSE 'one' END",
    "status": "o_orderstatus",
}

# --- fixed values: orders whose keys have faults, from `orders` --------------
FAULT_ORDER_EXPRS = {
    "order_id": f"CASE WHEN {_K} % 101 = 0 THEN NULL WHEN {_K} % 8 = 0 THEN {_K} + 1 ELSE {_K} END",
    "customer_id": f"CASE WHEN {_K} % 61 = 0 THEN -o_custkey WHEN {_K} % 67 = 0 THEN NULL ELSE o_custkey END",
    "order_date": "CAST(o_orderdate AS DATE)",
}
# ---------------------------------------------------------------------------


def _select(exprs: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in exprs.items()]


def txn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id BIGINT, transaction_id ... order_date STRING): the payment
    CSV form, one row per order; ``row_id`` carries the row order."""
    return read_table(spark, sf_dir, "orders").selectExpr(*_select(TXN_EXPRS))


def poor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction text rows of poor quality: many missing, mixed and
    repeated values, and a column that is named like another one's rule."""
    return read_table(spark, sf_dir, "orders").selectExpr(*_select(POOR_EXPRS))


def fault_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with missing and repeated order keys and with customers
    that are missing or do not exist."""
    return read_table(spark, sf_dir, "orders").selectExpr(*_select(FAULT_ORDER_EXPRS))


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, age, email) as text, one row per customer; NULL stands for
    an absent field."""
    return read_table(spark, sf_dir, "customer").selectExpr(*_select(USER_EXPRS))


def docs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents left join labels as text; ``row_id`` = doc_id.  Natural
    missing values (unlabelled documents) and natural duplicate rows."""
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    return (d.join(lab, "doc_id", "left")
            .selectExpr("doc_id AS row_id", "text", "lang", "source",
                        "CAST(n_chars AS STRING) AS n_chars",
                        "CAST(quality AS STRING) AS quality",
                        "CAST(toxic AS STRING) AS toxic"))


DOCS_COLUMNS = ["text", "lang", "source", "n_chars", "quality", "toxic"]


def oracle_cte(name: str, table: str, exprs: dict[str, str]) -> str:
    return f"{name} AS (SELECT {', '.join(_select(exprs))} FROM {table})"


TXN_CTE = oracle_cte("txn_raw", "orders", TXN_EXPRS)
POOR_CTE = oracle_cte("poor_raw", "orders", POOR_EXPRS)
FAULT_ORDERS_CTE = oracle_cte("fault_orders", "orders", FAULT_ORDER_EXPRS)
USERS_CTE = oracle_cte("users_raw", "customer", USER_EXPRS)
DOCS_CTE = """docs_raw AS (SELECT d.doc_id AS row_id, d.text, d.lang, d.source,
  CAST(d.n_chars AS VARCHAR) AS n_chars, CAST(l.quality AS VARCHAR) AS quality,
  CAST(l.toxic AS VARCHAR) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
