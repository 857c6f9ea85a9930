"""Registered queries: quality profile, validation, duplicates, cleaning,
inspection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import clean, dedup, inspect, quality as Q
from ledgerline.plans import oracle_quality as O
from ledgerline.plans.oracle import DOCS_LABELS, SALES, round2, with_
from ledgerline.sources import bindings as b
from ledgerline.sources import raw_views as R
from ledgerline.sources.tables import read_table

REGISTRY: dict = {}


def register(key, oracle):
    def deco(fn):
        REGISTRY[key] = (fn, oracle)
        return fn
    return deco


TXN, TC = R.TXN_COLUMNS, "txn_raw"
DOCS, DC = R.DOCS_COLUMNS, "docs_raw"
TXN_P = with_(R.TXN_CTE).rstrip("\n") + O.profile_ctes(TC, TXN) + "\n"
TXN_PR = TXN_P.rstrip("\n") + O.rules_cte(TXN) + "\n"
TXN_PRS = TXN_PR.rstrip("\n") + O.summary_ctes(TC, TXN) + "\n"
DOCS_PRS = (with_(R.DOCS_CTE).rstrip("\n") + O.profile_ctes(DC, DOCS) + O.rules_cte(DOCS)
            + O.summary_ctes(DC, DOCS) + "\n")

PROFILE_COLS = ["column_name", "missing_count", "missing_percentage", "completeness_severity",
                "data_type", "type_confidence", "unique_values", "min_length", "max_length"]


def _txn(spark, d):
    return R.txn_raw(spark, d)


def _vc(spark, d):
    return Q.value_counts(_txn(spark, d), TXN, "row_id")


# ----------------------------------------------------------------- quality --

@register("dq_missing", TXN_P + """SELECT column_name, missing_count, missing_percentage,
  completeness_severity FROM prof2""")
def q_dq_missing(spark, d):
    return Q.column_profile(_vc(spark, d)).select(
        "column_name", "missing_count", "missing_percentage", "completeness_severity")


@register("dq_type_guess", TXN_P + """SELECT col AS column_name, data_type, value_count
  FROM tc""")
def q_dq_type_guess(spark, d):
    return Q.type_counts(_vc(spark, d)).select(
        F.col("column").alias("column_name"), "data_type", "value_count")


@register("dq_columns", TXN_P + f"SELECT {', '.join(PROFILE_COLS)} FROM prof2")
def q_dq_columns(spark, d):
    return Q.column_profile(_vc(spark, d)).select(*PROFILE_COLS)


_NUMERIC_SQL = f"""SELECT nstat.col AS column_name, cnt AS "count", {round2('s')} AS "sum",
  {round2('s / cnt')} AS average, {round2('mn')} AS "min", {round2('mx')} AS "max",
  {round2('mx - mn')} AS "range"
FROM (SELECT pos, col, CAST(SUM(n) AS BIGINT) AS cnt, SUM(num * n) AS s, MIN(num) AS mn, MAX(num) AS mx
  FROM cls WHERE data_type IN ('integer', 'float') GROUP BY pos, col) nstat JOIN dom ON nstat.pos = dom.pos
WHERE dom.data_type IN ('integer', 'float') AND cnt > 0"""


@register("dq_numeric", TXN_P.rstrip("\n") + f""", nstat AS (SELECT pos, col,
  CAST(SUM(n) AS BIGINT) AS cnt, SUM(num * n) AS s, MIN(num) AS mn, MAX(num) AS mx
  FROM cls WHERE data_type IN ('integer', 'float') GROUP BY pos, col)
SELECT nstat.col AS column_name, cnt AS "count", {round2('s')} AS "sum",
  {round2('s / cnt')} AS average, {round2('mn')} AS "min", {round2('mx')} AS "max",
  {round2('mx - mn')} AS "range"
FROM nstat JOIN dom ON nstat.pos = dom.pos
WHERE dom.data_type IN ('integer', 'float') AND cnt > 0""")
def q_dq_numeric(spark, d):
    return Q.numeric_stats(_vc(spark, d)).drop("pos")


@register("dq_rules", TXN_PR + "SELECT rule_key, invalid_count FROM rules")
def q_dq_rules(spark, d):
    return Q.rule_counts(_vc(spark, d), TXN)


@register("dq_summary", TXN_PRS + "SELECT * FROM summ")
def q_dq_summary(spark, d):
    """The sums need no distinct values, so they come from the cells."""
    txn = _txn(spark, d)
    return Q.summary(txn, TXN, Q.cells(txn, TXN, "row_id"))


@register("dq_issues", TXN_PR + """SELECT column_name, missing_percentage,
  completeness_severity AS severity FROM prof2
  WHERE missing_percentage > 20 OR column_name IN (SELECT rule_key FROM rules)""")
def q_dq_issues(spark, d):
    vc = _vc(spark, d)
    return Q.issues(Q.column_profile(vc), Q.rule_counts(vc, TXN)).drop("pos")


_RECOMMEND_CTE = """, rec AS (
  SELECT 1 AS seq, 0 AS sub, 'Consider data imputation for columns with >20% missing values: '
    || array_to_string(list_slice(list(column_name ORDER BY pos), 1, 5), ', ')
    || CASE WHEN COUNT(*) > 5 THEN '...' ELSE '' END AS recommendation
    FROM prof2 WHERE missing_count / total_rows > 0.2 HAVING COUNT(*) > 0
  UNION ALL SELECT 2, 0, 'Remove ' || CAST(duplicate_rows AS VARCHAR) || ' duplicate rows ('
    || printf('%.1f', round_even(duplicate_rows / total_rows * 100, 1))
    || '% of total) to improve data quality' FROM summ WHERE duplicate_rows > 0
  UNION ALL SELECT 3, pos, 'Column ''' || column_name
    || ''' has mixed data types. Consider standardizing to ' || data_type
    FROM prof2 WHERE data_type <> 'unknown' AND type_pct_raw < 90
  UNION ALL SELECT 4, 0, 'Overall data quality needs improvement. Focus on reducing missing '
    || 'values and fixing invalid entries.' FROM summ WHERE quality_score < 70)"""
_RECOMMEND_ROWS = "SELECT CAST(ROW_NUMBER() OVER (ORDER BY seq, sub) AS BIGINT) AS seq, recommendation FROM rec"
_RECOMMEND_SQL = f"{_RECOMMEND_CTE}\n{_RECOMMEND_ROWS}"


@register("dq_recommend", TXN_PRS.rstrip("\n") + _RECOMMEND_SQL)
def q_dq_recommend(spark, d):
    txn, vc = _txn(spark, d), _vc(spark, d)
    return Q.recommendations(Q.column_profile(vc), Q.summary(txn, TXN, vc))


def _report_sql():
    """The report in long form, from the same parts."""
    parts = ["SELECT 'metadata' AS section, CAST(NULL AS VARCHAR) AS item, 'file_name' AS field, "
             "CAST(NULL AS DOUBLE) AS number, 'txn_raw' AS text"]
    parts += [f"SELECT 'summary', NULL, '{k}', CAST({k} AS DOUBLE), NULL FROM summ" for k in (
        "total_rows", "total_columns", "complete_rows", "completeness_percentage", "quality_score")]
    parts += ["SELECT 'summary', NULL, 'quality_rating', NULL, quality_rating FROM summ",
              "SELECT 'duplicates', NULL, 'count', CAST(duplicate_rows AS DOUBLE), NULL FROM summ",
              f"SELECT 'duplicates', NULL, 'percentage', coalesce({round2('duplicate_rows / NULLIF(total_rows, 0) * 100')}, 0.0), "
              "NULL FROM summ"]
    parts += [f"SELECT 'column', column_name, '{k}', CAST({k} AS DOUBLE), NULL FROM prof2" for k in (
        "missing_count", "missing_percentage", "type_confidence", "unique_values", "min_length", "max_length")]
    parts += [f"SELECT 'column', column_name, '{k}', NULL, {k} FROM prof2" for k in ("completeness_severity", "data_type")]
    parts += [f"SELECT 'column', column_name, 'numeric_{k}', CAST(\"{k}\" AS DOUBLE), NULL FROM nums" for k in (
        "count", "sum", "average", "min", "max", "range")]
    parts += ["SELECT 'invalid', rule_key, 'count', CAST(invalid_count AS DOUBLE), NULL FROM rules",
              "SELECT 'issue', column_name, 'missing_percentage', missing_percentage, completeness_severity FROM prof2 "
              "WHERE missing_percentage > 20 OR column_name IN (SELECT rule_key FROM rules)",
              "SELECT 'recommendation', CAST(seq AS VARCHAR), 'text', NULL, recommendation FROM recs"]
    return (TXN_PRS.rstrip("\n") + ", nums AS (" + _NUMERIC_SQL + ")" + _RECOMMEND_CTE
            + ", recs AS (" + _RECOMMEND_ROWS + ") " + " UNION ALL ".join(parts))


def _small_sql():
    parts = [f"SELECT 'row_count' AS section, 'rows' AS item, COUNT(*) AS value FROM {TC}"]
    for c in TXN:
        parts.append(f"SELECT * FROM (SELECT 'missing_values' AS section, '{c}' AS item, "
                     f"COUNT(*) FILTER (WHERE coalesce({c}, '') = '') AS value FROM {TC}) "
                     f"WHERE value > 0")
    x = O.to_num(O.strip("amount"))
    parts.append(f"SELECT * FROM (SELECT 'invalid_values' AS section, 'amount' AS item, "
                 f"COUNT(*) FILTER (WHERE ({x}) <= 0) AS value FROM {TC}) WHERE value > 0")
    return with_(R.TXN_CTE) + " UNION ALL ".join(parts)


@register("dq_small", _small_sql())
def q_dq_small(spark, d):
    return Q.small_report(_txn(spark, d), TXN)


# The document view holds long texts: its reports never group by value.  Sums
# come from the cells, the profile from per-cell aggregates with the exact
# distinct count taken fingerprint-first, duplicates fingerprint-first.

def _docs_profile(docs):
    return Q.profile_approx(docs, DOCS, "row_id", exact_distinct=True)


def _docs_summary(docs):
    return Q.summary(docs, DOCS, Q.cells(docs, DOCS, "row_id"), fingerprints=True)


@register("dq_summary_docs", DOCS_PRS + "SELECT * FROM summ")
def q_dq_summary_docs(spark, d):
    return _docs_summary(R.docs_raw(spark, d))


@register("dq_numeric_docs", DOCS_PRS.rstrip("\n") + f""", nstat AS (SELECT pos, col,
  CAST(SUM(n) AS BIGINT) AS cnt, SUM(num * n) AS s, MIN(num) AS mn, MAX(num) AS mx
  FROM cls WHERE data_type IN ('integer', 'float') GROUP BY pos, col)
SELECT nstat.col AS column_name, cnt AS "count", {round2('s')} AS "sum",
  {round2('s / cnt')} AS average, {round2('mn')} AS "min", {round2('mx')} AS "max",
  {round2('mx - mn')} AS "range"
FROM nstat JOIN dom ON nstat.pos = dom.pos
WHERE dom.data_type IN ('integer', 'float') AND cnt > 0""")
def q_dq_numeric_docs(spark, d):
    """Numeric columns of the document view, from the cells (n = 1 each):
    sums and the dominant class need no grouping of the long texts."""
    docs = R.docs_raw(spark, d)
    return Q.numeric_stats(Q.cells(docs, DOCS, "row_id")).drop("pos")


@register("dq_columns_docs", DOCS_PRS + f"SELECT {', '.join(PROFILE_COLS)} FROM prof2")
def q_dq_columns_docs(spark, d):
    return _docs_profile(R.docs_raw(spark, d)).select(*PROFILE_COLS)


@register("dup_text_rows", with_(R.DOCS_CTE) + f""", k AS (SELECT row_id,
  {O.row_key(DOCS)} AS k FROM {DC}), f AS (SELECT k, MIN(row_id) AS first FROM k GROUP BY k)
SELECT k.row_id FROM k JOIN f ON k.k = f.k WHERE k.row_id > f.first""")
def q_dup_text_rows(spark, d):
    return Q.duplicate_rows(R.docs_raw(spark, d), DOCS, "row_id", fingerprints=True)


# -------------------------------------------------------------- duplicates --

DOC_KEY = ["text", "lang", "source"]


def _docs(spark, d):
    return read_table(spark, d, "documents").select("doc_id", *DOC_KEY)


@register("dup_rows", """SELECT d.doc_id, d.text, d.lang, d.source FROM documents d JOIN
  (SELECT text, lang, source, MIN(doc_id) AS f FROM documents GROUP BY text, lang, source) g
  ON d.text IS NOT DISTINCT FROM g.text AND d.lang IS NOT DISTINCT FROM g.lang
  AND d.source IS NOT DISTINCT FROM g.source WHERE d.doc_id > g.f""")
def q_dup_rows(spark, d):
    return dedup.duplicate_rows(_docs(spark, d), DOC_KEY, "doc_id", fingerprints=True)


@register("dup_count", """SELECT CAST(SUM(c) AS BIGINT) AS total_rows,
  COUNT(*) AS distinct_rows, CAST(SUM(c - 1) AS BIGINT) AS duplicate_rows
  FROM (SELECT COUNT(*) AS c FROM documents GROUP BY text, lang, source)""")
def q_dup_count(spark, d):
    return dedup.duplicate_count(_docs(spark, d).drop("doc_id"))


@register("dup_drop", "SELECT DISTINCT text, lang, source FROM documents")
def q_dup_drop(spark, d):
    return dedup.drop_duplicates(_docs(spark, d).drop("doc_id"))


# -------------------------------------------------------------- validation --

_AGE_T = (f"CASE WHEN {O.is_int(O.strip('age'))} THEN "
          f"TRY_CAST(replace({O.strip('age')}, '_', '') AS BIGINT) END")
USERS_T = with_(R.USERS_CTE) + f""", users AS (SELECT id, name, {_AGE_T} AS age, email
  FROM users_raw)
"""


@register("val_user_verbose", USERS_T + f"""SELECT id, concat_ws(' | ',
  CASE WHEN name IS NULL OR name = '' OR {O.strip('name')} = ''
    THEN '❌ Name is missing or empty' END,
  CASE WHEN age IS NULL THEN '❌ Age field is missing'
    WHEN age <= 0 THEN '❌ Age must be > 0, got ' || CAST(age AS VARCHAR) END,
  CASE WHEN email IS NULL THEN '❌ Email field is missing'
    WHEN NOT contains(email, '@') THEN '❌ Email must contain ''@'', got ''' || email || '''' END)
  AS errors_text,
  CAST((name IS NULL OR name = '' OR {O.strip('name')} = '') AS BIGINT)
  + CAST((age IS NULL OR age <= 0) AS BIGINT)
  + CAST((email IS NULL OR NOT contains(email, '@')) AS BIGINT) AS error_count,
  NOT (name IS NULL OR name = '' OR {O.strip('name')} = '' OR age IS NULL OR age <= 0
       OR email IS NULL OR NOT contains(email, '@')) AS is_valid
  FROM users""")
def q_val_user_verbose(spark, d):
    v = clean.validation_errors(clean.typed_users(R.users_raw(spark, d)))
    return v.select("id", F.array_join("errors", " | ").alias("errors_text"),
                    F.size("errors").cast("bigint").alias("error_count"), "is_valid")


@register("val_user_fields", USERS_T + """SELECT id, coalesce(name, 'Unknown') AS display_name,
  CASE WHEN (name IS NULL OR name = '') OR (age IS NULL OR age <= 0)
    OR (email IS NULL OR NOT contains(email, '@')) THEN 'INVALID' ELSE 'VALID' END AS status,
  concat_ws(',', CASE WHEN name IS NULL OR name = '' THEN 'name' END,
    CASE WHEN age IS NULL OR age <= 0 THEN 'age' END,
    CASE WHEN email IS NULL OR NOT contains(email, '@') THEN 'email' END) AS failed_fields
  FROM users""")
def q_val_user_fields(spark, d):
    return clean.failing_fields(clean.typed_users(R.users_raw(spark, d)))


@register("val_min_length", with_(R.USERS_CTE) + """SELECT id, name,
  coalesce(length(name) > 3, false) AS name_ok FROM users_raw""")
def q_val_min_length(spark, d):
    return clean.min_length_rule(R.users_raw(spark, d).select("id", "name"))


_AGE_I = (f"CASE WHEN {O.is_int(O.strip('age'))} THEN "
          f"TRY_CAST(replace({O.strip('age')}, '_', '') AS DECIMAL(38,0)) END")


CLEAN_USERS_SQL = f"""SELECT id, name,
  CASE WHEN ({_AGE_I}) > 0 THEN CAST(({_AGE_I}) AS VARCHAR) ELSE 'UNKNOWN' END AS age,
  CASE WHEN coalesce(email <> '', false) THEN {O.strip('lower(email)')} ELSE email END AS email
  FROM users_raw WHERE {O.strip('name')} <> ''"""


@register("clean_users", with_(R.USERS_CTE) + CLEAN_USERS_SQL)
def q_clean_users(spark, d):
    return clean.clean_users(R.users_raw(spark, d))


@register("clean_dropna", with_(DOCS_LABELS) + "SELECT * FROM docs_labels WHERE quality IS NOT NULL")
def q_clean_dropna(spark, d):
    return b.docs_labels(spark, d).na.drop(subset=["quality"])


@register("clean_to_numeric", with_(R.TXN_CTE) + f"""SELECT row_id, amount,
  {O.to_num(O.strip('amount'))} AS amount_num FROM txn_raw""")
def q_clean_to_numeric(spark, d):
    t = _txn(spark, d).select("row_id", "amount", F.col("amount").alias("amount_num"))
    return clean.to_numeric(t, "amount_num")


@register("clean_text", with_(R.TXN_CTE) + f"""SELECT row_id,
  lower({O.strip('customer_email')}) AS email_clean FROM txn_raw""")
def q_clean_text(spark, d):
    return clean.normalise_text(_txn(spark, d).select("row_id", "customer_email"),
                                "customer_email", "email_clean").drop("customer_email")


# -------------------------------------------------------------- inspection --

DL = with_(DOCS_LABELS)


@register("insp_head", DL + "SELECT * FROM docs_labels ORDER BY doc_id LIMIT 5")
def q_insp_head(spark, d):
    return inspect.head(b.docs_labels(spark, d), ["doc_id"], 5)


@register("insp_shape", with_(SALES) + "SELECT COUNT(*) AS row_count, CAST(7 AS BIGINT) AS column_count FROM sales")
def q_insp_shape(spark, d):
    return inspect.shape(b.sales(spark, d))


_DL_TYPES = [("doc_id", "bigint"), ("lang", "string"), ("source", "string"),
             ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]


@register("insp_schema", DL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null_count "
    f"FROM docs_labels" for c, t in _DL_TYPES))
def q_insp_schema(spark, d):
    return inspect.schema_profile(b.docs_labels(spark, d))


_NUM = ["doc_id", "n_chars", "quality", "toxic"]


@register("insp_describe", DL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {round2(f'AVG({c})', 6)} AS mean, "
    f"{round2(f'STDDEV_SAMP({c})', 6)} AS std, CAST(MIN({c}) AS DOUBLE) AS min, "
    f"quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
    f"quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM docs_labels"
    for c in _NUM))
def q_insp_describe(spark, d):
    out = inspect.describe(b.docs_labels(spark, d), _NUM)
    return (out.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6)))


@register("insp_null_counts", DL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM docs_labels" for c, _ in _DL_TYPES))
def q_insp_null_counts(spark, d):
    return inspect.null_counts(b.docs_labels(spark, d))


@register("insp_step_counts", DL + """SELECT 'loaded' AS step, COUNT(*) AS row_count
  FROM docs_labels
  UNION ALL SELECT 'dropna(quality)', COUNT(*) FROM docs_labels WHERE quality IS NOT NULL
  UNION ALL SELECT 'drop_duplicates', COUNT(*) FROM (SELECT DISTINCT lang, source, quality,
  toxic FROM docs_labels WHERE quality IS NOT NULL)""")
def q_insp_step_counts(spark, d):
    loaded = b.docs_labels(spark, d)
    kept = loaded.na.drop(subset=["quality"])
    dedup_ = kept.select("lang", "source", "quality", "toxic").dropDuplicates()
    return inspect.step_counts({"loaded": loaded, "dropna(quality)": kept,
                                "drop_duplicates": dedup_})


@register("insp_nunique", DL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_count FROM docs_labels"
    for c in ["lang", "source", "quality"]))
def q_insp_nunique(spark, d):
    return inspect.distinct_counts(b.docs_labels(spark, d), ["lang", "source", "quality"])


@register("insp_value_counts", DL + """SELECT lang, COUNT(*) AS count FROM docs_labels
  GROUP BY lang""")
def q_insp_value_counts(spark, d):
    return inspect.value_distribution(b.docs_labels(spark, d), "lang")


@register("insp_min_max", with_(SALES) + """SELECT 'quantity' AS column_name, MIN(quantity) AS min,
  MAX(quantity) AS max FROM sales UNION ALL SELECT 'price', MIN(price), MAX(price) FROM sales""")
def q_insp_min_max(spark, d):
    return inspect.min_max(b.sales(spark, d), ["quantity", "price"])


@register("dq_issues_docs", DOCS_PRS + """SELECT column_name, missing_percentage,
  completeness_severity AS severity FROM prof2
  WHERE missing_percentage > 20 OR column_name IN (SELECT rule_key FROM rules)""")
def q_dq_issues_docs(spark, d):
    docs = R.docs_raw(spark, d)
    return Q.issues(_docs_profile(docs),
                    Q.rule_counts(Q.cells(docs, DOCS, "row_id"), DOCS)).drop("pos")


@register("dq_recommend_docs", DOCS_PRS.rstrip("\n") + _RECOMMEND_SQL)
def q_dq_recommend_docs(spark, d):
    docs = R.docs_raw(spark, d)
    return Q.recommendations(_docs_profile(docs), _docs_summary(docs))


# A view of poor quality: every kind of issue and recommendation occurs.
POOR = R.POOR_COLUMNS
POOR_PRS = (with_(R.POOR_CTE).rstrip("\n") + O.profile_ctes("poor_raw", POOR) + O.rules_cte(POOR)
            + O.summary_ctes("poor_raw", POOR) + "\n")


@register("dq_issues_poor", POOR_PRS + """SELECT column_name, missing_percentage,
  completeness_severity AS severity FROM prof2
  WHERE missing_percentage > 20 OR column_name IN (SELECT rule_key FROM rules)""")
def q_dq_issues_poor(spark, d):
    vc = Q.value_counts(R.poor_raw(spark, d), POOR, "row_id")
    return Q.issues(Q.column_profile(vc), Q.rule_counts(vc, POOR)).drop("pos")


@register("dq_recommend_poor", POOR_PRS.rstrip("\n") + _RECOMMEND_SQL)
def q_dq_recommend_poor(spark, d):
    poor = R.poor_raw(spark, d)
    vc = Q.value_counts(poor, POOR, "row_id")
    return Q.recommendations(Q.column_profile(vc), Q.summary(poor, POOR, vc))


REPORT_SQL = _report_sql()
