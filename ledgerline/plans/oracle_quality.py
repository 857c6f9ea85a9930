"""DuckDB oracle SQL for the quality profile, generated from column lists.

RE2 (DuckDB) and Java regexes agree on the ASCII text of the supplied
tables; Java's Unicode ``\\s`` is wider than RE2's, which only matters for
non-ASCII whitespace.
"""

from __future__ import annotations

from ledgerline.functions import text as T
from ledgerline.operators import quality as Q
from ledgerline.plans.oracle import round2

_STRIP_RE = r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_INT_RE = T.INTEGER_PATTERN[1:-1]
_FLOAT_RE = T.FLOAT_PATTERN.replace("^", "", 1)[:-1]


def strip(x: str) -> str:
    return f"regexp_replace({x}, '{_STRIP_RE}', '', 'g')"


def missing(x: str) -> str:
    s = strip(x)
    return f"({x} IS NULL OR {s} = '' OR lower({s}) IN ('null', 'nan', 'none'))"


def is_float(v: str) -> str:
    return f"coalesce(regexp_full_match({v}, '{_FLOAT_RE}'), false)"


def is_int(v: str) -> str:
    return f"coalesce(regexp_full_match({v}, '{_INT_RE}'), false)"


def guess(v: str) -> str:
    return (f"CASE WHEN {is_int(v)} THEN 'integer' WHEN {is_float(v)} THEN 'float' "
            f"WHEN lower({v}) IN ('true', 'false', 'yes', 'no') THEN 'boolean' "
            f"WHEN contains({v}, '@') AND contains({v}, '.') THEN 'email' "
            f"WHEN (contains({v}, '-') OR contains({v}, '/') OR contains({v}, '.')) "
            f"AND length({v}) >= 8 THEN 'date' ELSE 'string' END")


def to_num(v: str) -> str:
    return f"CASE WHEN {is_float(v)} THEN TRY_CAST(replace({v}, '_', '') AS DOUBLE) END"


def valid_email(v: str) -> str:
    return (f"(contains({v}, '@') AND contains({v}, '.') "
            f"AND regexp_full_match({v}, '[^@]*@[^@]*'))")


def valid_date(v: str) -> str:
    parts = f"string_split(translate({v}, '/.', '--'), '-')"
    return f"(len({parts}) >= 2 AND len(list_filter({parts}, lambda p: {strip('p')} = '')) = 0)"


def alnum(v: str) -> str:
    return f"coalesce(regexp_full_match({v}, '[\\p{{L}}\\p{{N}}]+'), false)"


def profile_ctes(src: str, columns: list[str], order_col: str = "row_id") -> str:
    """cells, vc (value counts), cls (classified present values), dom."""
    cells = " UNION ALL ".join(
        f"SELECT {order_col} AS _row, {i} AS pos, '{c}' AS col, CAST({c} AS VARCHAR) AS raw "
        f"FROM {src}" for i, c in enumerate(columns))
    return f""", cells AS ({cells}),
 vc AS (SELECT pos, col, value, COUNT(*) AS n, MIN(_row) AS first_row FROM (
   SELECT _row, pos, col, CASE WHEN NOT {missing('raw')} THEN {strip('raw')} END AS value
   FROM cells) GROUP BY pos, col, value),
 cls AS (SELECT *, {guess('value')} AS data_type, CAST(length(value) AS BIGINT) AS len,
   {to_num('value')} AS num FROM vc WHERE value IS NOT NULL),
 tc AS (SELECT pos, col, data_type, CAST(SUM(n) AS BIGINT) AS value_count,
   MIN(first_row) AS first_row FROM cls GROUP BY pos, col, data_type),
 dom AS (SELECT pos, col, data_type, value_count AS dominant_count FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY pos, col ORDER BY value_count DESC,
   first_row ASC, data_type DESC) AS rk FROM tc) WHERE rk = 1),
 base AS (SELECT pos, col,
   CAST(SUM(CASE WHEN value IS NULL THEN n ELSE 0 END) AS BIGINT) AS missing_count,
   CAST(SUM(CASE WHEN value IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS present_count,
   COUNT(value) AS unique_values FROM vc GROUP BY pos, col),
 lens AS (SELECT pos, col, MIN(len) AS min_length, MAX(len) AS max_length FROM cls
   GROUP BY pos, col),
 prof AS (SELECT b.pos, b.col AS column_name, b.missing_count,
   {round2('b.missing_count / (b.missing_count + b.present_count) * 100')}
     AS missing_percentage,
   coalesce(d.data_type, 'unknown') AS data_type,
   coalesce({round2('d.dominant_count / NULLIF(b.present_count, 0) * 100')}, 0.0)
     AS type_confidence,
   b.unique_values, CAST(coalesce(l.min_length, 0) AS BIGINT) AS min_length,
   CAST(coalesce(l.max_length, 0) AS BIGINT) AS max_length,
   b.missing_count + b.present_count AS total_rows,
   d.dominant_count / b.present_count * 100 AS type_pct_raw
   FROM base b LEFT JOIN lens l ON b.pos = l.pos LEFT JOIN dom d ON b.pos = d.pos),
 prof2 AS (SELECT *, {severity('missing_percentage')} AS completeness_severity FROM prof)"""


def severity(p: str) -> str:
    return (f"CASE WHEN {p} <= 5 THEN 'low' WHEN {p} <= 20 THEN 'medium' "
            f"WHEN {p} <= 50 THEN 'high' ELSE 'critical' END")


def rating(s: str) -> str:
    return (f"CASE WHEN {s} >= 90 THEN 'Excellent 🏆' WHEN {s} >= 75 THEN 'Good 👍' "
            f"WHEN {s} >= 60 THEN 'Fair ⚠️' WHEN {s} >= 40 THEN 'Poor 👎' "
            f"ELSE 'Critical 🚨' END")


def rules_cte(columns: list[str]) -> str:
    parts = []
    for c in columns:
        fam = Q.rule_family(c)
        if fam is None:
            continue
        v = "value"
        if fam == "email":
            checks = {"invalid_email": f"NOT {valid_email(v)}"}
        elif fam == "amount":
            x = to_num(v)
            checks = {"negative": f"({x}) < 0", "zero": f"({x}) = 0",
                      "non_numeric": f"({x}) IS NULL"}
        elif fam == "date":
            checks = {"invalid_date": f"NOT {valid_date(v)}"}
        else:
            checks = {"invalid_id": f"NOT {alnum(v)}"}
        for k, t in checks.items():
            parts.append(f"SELECT '{c}_{k}' AS rule_key, CAST(coalesce(SUM(CASE WHEN {t} "
                         f"THEN n ELSE 0 END), 0) AS BIGINT) AS invalid_count FROM vc "
                         f"WHERE col = '{c}' AND value IS NOT NULL")
    body = " UNION ALL ".join(parts) if parts else \
        "SELECT CAST(NULL AS VARCHAR) AS rule_key, CAST(0 AS BIGINT) AS invalid_count WHERE false"
    return f""", rules AS (SELECT * FROM ({body}) WHERE invalid_count > 0)"""


def row_key(columns: list[str]) -> str:
    return " || '|' || ".join(f"coalesce({strip(f'CAST({c} AS VARCHAR)')}, 'None')"
                             for c in columns)


def complete(columns: list[str]) -> str:
    return " AND ".join(f"NOT {missing(f'CAST({c} AS VARCHAR)')}" for c in columns)


def summary_ctes(src: str, columns: list[str]) -> str:
    n = len(columns)
    cells = "(total_rows * total_columns)"
    score = (f"CASE WHEN {cells} > 0 THEN least(100.0, greatest(0.0, "
             f"(1 - empty_cells / {cells}) * 40 "
             f"+ (1 - duplicate_rows / greatest(1, total_rows)) * 30 "
             f"+ (1 - invalid_values / greatest(1, {cells} - empty_cells)) * 30)) ELSE 0.0 END")
    return f""", s0 AS (SELECT
   (SELECT COUNT(*) FROM {src}) AS total_rows, CAST({n} AS BIGINT) AS total_columns,
   (SELECT COUNT(*) FILTER (WHERE {complete(columns)}) FROM {src}) AS complete_rows,
   (SELECT CAST(coalesce(SUM(CASE WHEN value IS NULL THEN n END), 0) AS BIGINT) FROM vc)
     AS empty_cells,
   (SELECT CAST(coalesce(SUM(c - 1), 0) AS BIGINT) FROM (SELECT {row_key(columns)} AS k,
     COUNT(*) AS c FROM {src} GROUP BY k)) AS duplicate_rows,
   (SELECT CAST(coalesce(SUM(invalid_count), 0) AS BIGINT) FROM rules) AS invalid_values),
 s1 AS (SELECT *, {score} AS _score FROM s0),
 summ AS (SELECT total_rows, total_columns, complete_rows,
   coalesce({round2('complete_rows / NULLIF(total_rows, 0) * 100')}, 0.0)
     AS completeness_percentage,
   empty_cells, duplicate_rows, invalid_values, {round2('_score')} AS quality_score,
   {rating('_score')} AS quality_rating FROM s1)"""
