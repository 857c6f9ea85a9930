"""Business-rule classifications as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
VALUE_LABELS = ("HIGH_VALUE", "MEDIUM_VALUE", "LOW_VALUE")
SHORT_LABELS = ("HIGH", "MEDIUM", "LOW")
# Reference limits in the reference's currency units.
VALUE_HIGH_ABOVE, VALUE_MEDIUM_FROM = 10000, 2000          # '>' and '>='
SEGMENT_HIGH_FROM, SEGMENT_MEDIUM_FROM = 20000, 10000      # both '>='
TREND_LABELS = ("GROWTH", "DECLINE", "STABLE")
TREND_ARROW_LABELS = ("↑ GROWTH", "↓ DECLINE", "→ STABLE", "N/A")
SEVERITY_LIMITS = ((5, "low"), (20, "medium"), (50, "high"))   # '<=' limits
SEVERITY_ABOVE = "critical"
RATING_LIMITS = ((90, "Excellent 🏆"), (75, "Good 👍"), (60, "Fair ⚠️"), (40, "Poor 👎"))
RATING_BELOW = "Critical 🚨"
# ---------------------------------------------------------------------------


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def value_class(revenue: Column | str, high: float = VALUE_HIGH_ABOVE,
                medium: float = VALUE_MEDIUM_FROM, labels=VALUE_LABELS,
                high_inclusive: bool = False) -> Column:
    """Three-way class.  HIGH is '>' by default (the array rules) and '>='
    with ``high_inclusive`` (the customer segment); MEDIUM is '>='.  A NULL
    revenue falls through to the last label, as NaN does in the reference."""
    r = _c(revenue)
    hi = (r >= high) if high_inclusive else (r > high)
    return F.when(hi, labels[0]).when(r >= medium, labels[1]).otherwise(labels[2])


def segment(total: Column | str, high: float = SEGMENT_HIGH_FROM,
            medium: float = SEGMENT_MEDIUM_FROM) -> Column:
    return value_class(total, high, medium, VALUE_LABELS, high_inclusive=True)


def trend_stable(change: Column | str) -> Column:
    """Sign of the change; no previous value is STABLE."""
    d = _c(change)
    return (F.when(d > 0, TREND_LABELS[0]).when(d < 0, TREND_LABELS[1])
            .otherwise(TREND_LABELS[2]))


def trend_arrow(change: Column | str) -> Column:
    """Sign of the change with arrows; no previous value is N/A."""
    d = _c(change)
    g, dcl, st, na = TREND_ARROW_LABELS
    return F.when(d > 0, g).when(d < 0, dcl).when(d == 0, st).otherwise(na)


def severity(pct: Column | str) -> Column:
    p = _c(pct)
    out = None
    for limit, label in SEVERITY_LIMITS:
        out = F.when(p <= limit, label) if out is None else out.when(p <= limit, label)
    return out.otherwise(SEVERITY_ABOVE)


def quality_rating(score: Column | str) -> Column:
    s = _c(score)
    out = None
    for limit, label in RATING_LIMITS:
        out = F.when(s >= limit, label) if out is None else out.when(s >= limit, label)
    return out.otherwise(RATING_BELOW)
