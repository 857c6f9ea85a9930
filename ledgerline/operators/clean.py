"""Record validation and cleaning (users and sales rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as T

# --- fixed values: validation messages --------------------------------------
MSG_NAME = "❌ Name is missing or empty"
MSG_AGE_MISSING = "❌ Age field is missing"
MSG_AGE_RANGE = "❌ Age must be > 0, got {}"
MSG_EMAIL_MISSING = "❌ Email field is missing"
MSG_EMAIL_AT = "❌ Email must contain '@', got '{}'"
UNKNOWN_AGE = "UNKNOWN"
UNKNOWN_NAME = "Unknown"
MIN_NAME_LENGTH = 3        # a name passes when longer than this
# ---------------------------------------------------------------------------


def typed_users(raw: DataFrame) -> DataFrame:
    """Users with an integer age as DECIMAL(38,0), exact like Python's int
    up to 38 digits (NULL when absent or not an integer): a BIGINT cast
    would fail the job under ANSI on a long digit run."""
    return raw.select("id", "name", T.to_integer("age").alias("age"), "email")


def _fmt(template: str, c: Column) -> Column:
    a, b = template.split("{}")
    return F.concat(F.lit(a), c.cast("string"), F.lit(b))


def validation_errors(users: DataFrame) -> DataFrame:
    """Adds ``errors`` (ARRAY<STRING>, one message per failed check, in the
    order name, age, email) and ``is_valid``.  NULL = absent field."""
    name, age, email = F.col("name"), F.col("age"), F.col("email")
    checks = F.array(
        F.when(name.isNull() | (name == "") | (T.py_strip(name) == ""), F.lit(MSG_NAME)),
        F.when(age.isNull(), F.lit(MSG_AGE_MISSING))
         .when(age <= 0, _fmt(MSG_AGE_RANGE, age)),
        F.when(email.isNull(), F.lit(MSG_EMAIL_MISSING))
         .when(~email.contains("@"), _fmt(MSG_EMAIL_AT, email)))
    errors = F.filter(checks, lambda x: x.isNotNull())
    return users.withColumn("errors", errors).withColumn("is_valid", F.size(errors) == 0)


def failing_fields(users: DataFrame) -> DataFrame:
    """Compact form: names of the failing fields (name compared to '' without
    strip), VALID / INVALID, and the display name ('Unknown' only when the
    name is absent)."""
    name, age, email = F.col("name"), F.col("age"), F.col("email")
    fields = F.filter(F.array(
        F.when(name.isNull() | (name == ""), F.lit("name")),
        F.when(age.isNull() | (age <= 0), F.lit("age")),
        F.when(email.isNull() | ~email.contains("@"), F.lit("email"))), lambda x: x.isNotNull())
    return users.select(
        "id", F.coalesce(name, F.lit(UNKNOWN_NAME)).alias("display_name"),
        F.when(F.size(fields) == 0, "VALID").otherwise("INVALID").alias("status"),
        F.array_join(fields, ",").alias("failed_fields"))


def min_length_rule(df: DataFrame, col: str = "name", min_len: int = MIN_NAME_LENGTH) -> DataFrame:
    return df.withColumn(f"{col}_ok", F.coalesce(F.length(col) > min_len, F.lit(False)))


def clean_users(raw: DataFrame) -> DataFrame:
    """Rows with a blank or absent name are dropped; age becomes its
    canonical integer text when it is an integer > 0, else UNKNOWN; a
    non-empty email is lower-cased and stripped.  Column order is kept."""
    age = T.to_integer("age")
    email = F.col("email")
    return (raw.where(T.py_strip("name") != "")
            .withColumn("age", F.when(age > 0, age.cast("string")).otherwise(F.lit(UNKNOWN_AGE)))
            .withColumn("email", F.when(F.coalesce(email != "", F.lit(False)),
                                        T.py_strip(F.lower(email))).otherwise(email))
            .select(*raw.columns))


def to_numeric(df: DataFrame, *cols: str) -> DataFrame:
    """``pd.to_numeric(errors='coerce')``: text that is not a number becomes
    NULL; numeric columns pass through."""
    out = df
    for c in cols:
        if dict(df.dtypes)[c] == "string":
            out = out.withColumn(c, T.to_number(c))
    return out


def normalise_text(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """strip + lower-case."""
    return df.withColumn(out or col, F.lower(T.py_strip(col)))
