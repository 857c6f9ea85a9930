"""Text tests and normalisation as Column expressions.

The patterns reproduce Python's ``str.strip``, ``int()``, ``float()``,
``str.isalnum`` and ``str.split`` on the values they are applied to.  One
documented deviation: Python treats non-ASCII digits (e.g. ``'٣'``) as
digits for ``int()``; these patterns do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Words that count as a missing value after strip + lower-case.
MISSING_WORDS = ["null", "nan", "none"]
# Words guessed as boolean.
BOOLEAN_WORDS = ["true", "false", "yes", "no"]
# Separators that make a long enough value look like a date, and the length.
DATE_SEPARATORS = ["-", "/", "."]
DATE_MIN_LENGTH = 8
# Python whitespace = Unicode White_Space plus the four information
# separators U+001C..U+001F.
STRIP_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# The same set as characters, derived from Python's own rule (str.isspace),
# for ``btrim``: a character-set trim without a regex.
STRIP_CHARS = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
DIGITS = r"[0-9]+(?:_[0-9]+)*"
INTEGER_PATTERN = rf"^[+-]?{DIGITS}$"
FLOAT_PATTERN = (rf"(?i)^[+-]?(?:(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})"
                 rf"(?:e[+-]?{DIGITS})?|inf|infinity|nan)$")
ONE_AT_PATTERN = r"^[^@]*@[^@]*$"
ALNUM_PATTERN = r"^[\p{L}\p{N}]+$"
# ---------------------------------------------------------------------------


def column(name: str) -> Column:
    """A column by its exact name; a name with dots or spaces (any CSV
    header) is quoted, so it is never read as a struct field access."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(c: Column | str) -> Column:
    return column(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()`` (``trim`` removes only spaces): ``btrim`` with
    Python's whitespace characters."""
    return F.btrim(_c(c), F.lit(STRIP_CHARS))


def is_missing_text(c: Column | str) -> Column:
    """Missing test of the quality report: NULL, empty after strip, or one
    of the missing words (any case).  Never NULL itself."""
    s = py_strip(c)
    return F.coalesce(_c(c).isNull() | (s == "") | F.lower(s).isin(MISSING_WORDS),
                      F.lit(True))


def is_int_text(c: Column | str) -> Column:
    return F.coalesce(_c(c).rlike(INTEGER_PATTERN), F.lit(False))


def is_float_text(c: Column | str) -> Column:
    return F.coalesce(_c(c).rlike(FLOAT_PATTERN), F.lit(False))


def to_number(c: Column | str) -> Column:
    """``float(text)`` or NULL: the pattern guards the cast, because a bare
    ``try_cast`` also accepts forms Python rejects (``5d``, ``0x1p3``)."""
    s = py_strip(c)
    return F.when(is_float_text(s),
                  F.regexp_replace(s, "_", "").try_cast("double"))


def to_integer(c: Column | str) -> Column:
    """``int(text.strip())`` or NULL, as DECIMAL(38,0) so long digit runs
    stay exact."""
    s = py_strip(c)
    return F.when(is_int_text(s),
                  F.regexp_replace(s, "_", "").try_cast("decimal(38,0)"))


def guess_type(c: Column | str) -> Column:
    """Value class of an already stripped, present value (first match):
    integer, float, boolean, email, date, string."""
    v = _c(c)
    return (F.when(is_int_text(v), "integer")
            .when(is_float_text(v), "float")
            .when(F.lower(v).isin(BOOLEAN_WORDS), "boolean")
            .when(v.contains("@") & v.contains("."), "email")
            .when(_has_any(v, DATE_SEPARATORS) & (F.length(v) >= DATE_MIN_LENGTH), "date")
            .otherwise("string"))


def _has_any(v: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | v.contains(p)
    return out


def is_valid_email(c: Column | str) -> Column:
    """Has '@', has '.', and exactly one '@'."""
    v = _c(c)
    return v.contains("@") & v.contains(".") & v.rlike(ONE_AT_PATTERN)


def is_valid_date_shape(c: Column | str) -> Column:
    """After '/' and '.' become '-', at least two parts, none blank."""
    parts = F.split(F.translate(_c(c), "/.", "--"), "-", -1)
    return (F.size(parts) >= 2) & ~F.exists(parts, lambda p: py_strip(p) == "")


def is_alnum(c: Column | str) -> Column:
    return F.coalesce(_c(c).rlike(ALNUM_PATTERN), F.lit(False))
