"""Scalar column expressions (JVM-side, no Python UDFs).

Every function takes and returns ``Column`` so callers compose them inside a
single projection that stays in whole-stage codegen.  All casts and date
parses use the ``try_`` forms: Spark 4 runs ANSI mode, where a bad value
would otherwise fail the job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
NONE_SENTINEL = "None"          # literal text meaning "empty list"
UNKNOWN = "Unknown"             # placeholder city/state
DEFAULT_MEMBERSHIP_YEARS = 5.0  # used when a membership date does not parse
DAYS_PER_YEAR = 365.25
AMPLIFY_POWER = 2.5
DEFAULT_AS_OF = "2026-01-01"    # stands in for the reference's wall clock


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_list(col, sentinel: str = NONE_SENTINEL, null_safe: bool = False) -> Column:
    """number of comma-separated entries; the sentinel counts as 0.

    Matches Python ``len(s.split(','))``: an empty string counts 1 and a
    trailing comma adds an empty entry.  With ``null_safe`` a NULL is 0,
    otherwise NULL stays NULL (the reference fails on it).
    """
    c = _c(col)
    n = F.size(F.split(c, ",", -1)).cast("long")
    out = F.when(c == F.lit(sentinel), F.lit(0).cast("long")).otherwise(n)
    if null_safe:
        out = F.when(c.isNull(), F.lit(0).cast("long")).otherwise(out)
    return out


def map_key_count(col) -> Column:
    """number of keys of a map column; NULL counts 0."""
    return F.coalesce(F.size(_c(col)).cast("long"), F.lit(0).cast("long"))


def raw_token_count(col) -> Column:
    """comma-token count where NULL or '' is 0 and blank tokens count."""
    c = _c(col)
    return (F.when(c.isNull() | (c == F.lit("")), F.lit(0).cast("long"))
            .otherwise(F.size(F.split(c, ",", -1)).cast("long")))


def token_list(col) -> Column:
    """split on commas, trim, drop blanks; NULL gives an empty array."""
    parts = F.transform(F.split(F.coalesce(_c(col), F.lit("")), ",", -1), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def nonblank_token_count(col) -> Column:
    """number of non-blank comma tokens."""
    return F.size(token_list(col)).cast("long")


def year_difference(col, as_of: str = DEFAULT_AS_OF, fmt: str = "yyyy-MM-dd") -> Column:
    """``year(as_of) - year(date)`` for a date text in ``fmt``."""
    as_of_year = _dt.date.fromisoformat(as_of).year
    return (F.lit(as_of_year) - F.year(F.try_to_date(_c(col), fmt))).cast("long")


def membership_years(col, as_of: str = DEFAULT_AS_OF,
                     default: float = DEFAULT_MEMBERSHIP_YEARS) -> Column:
    """F8: whole days since a ``yyyy-M`` or ``yyyy`` date over 365.25.

    Texts matching neither pattern (a full ``yyyy-MM-dd`` included) and NULL
    give ``default``.
    """
    c = _c(col)
    d = F.coalesce(F.try_to_date(c, "yyyy-M"), F.try_to_date(c, "yyyy"))
    days = F.datediff(F.lit(as_of).cast("date"), d)
    return F.coalesce(days.cast("double") / F.lit(DAYS_PER_YEAR), F.lit(float(default)))


def safe_double(col, default: float = 0.0) -> Column:
    """number from text or number; NULL or unparsable gives ``default``."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(float(default)))


def log1p_count(col) -> Column:
    """F10."""
    return F.log1p(_c(col).cast("double"))


def abs_error(pred, truth) -> Column:
    """F11."""
    return F.abs(_c(pred) - _c(truth))


# Error-bin edges and labels, left-closed ([0,1) ... [4, inf)).
ERROR_BIN_EDGES = [0.0, 1.0, 2.0, 3.0, 4.0]
ERROR_BIN_LABELS = [">=0 and <1", ">=1 and <2", ">=2 and <3", ">=3 and <4", ">=4"]


def error_bin(col) -> Column:
    """left-closed bin index 0..4; NULL/NaN/negative give NULL (left out)."""
    c = _c(col)
    idx = F.least(F.floor(c), F.lit(4)).cast("long")
    return F.when(c.isNull() | F.isnan(c) | (c < 0), F.lit(None).cast("long")).otherwise(idx)


def amplify(col, power: float = AMPLIFY_POWER) -> Column:
    """case amplification ``|w| ** p``."""
    return F.pow(F.abs(_c(col)), F.lit(float(power)))


def clamp(col, lo: float, hi: float) -> Column:
    """F15."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), _c(col)))


def logistic_alpha(n, v, x0, y0, k1: float = 0.01, k2: float = 0.05) -> Column:
    """F16: ``0.5*sigmoid(-k1(n-x0)) + 0.5*sigmoid(-k2(v-y0))`` clamped to [0,1]."""
    a_n = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(float(k1)) * (_c(n).cast("double") - _c(x0))))
    a_v = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(float(k2)) * (_c(v).cast("double") - _c(y0))))
    return clamp(F.lit(0.5) * a_n + F.lit(0.5) * a_v, 0.0, 1.0)


def linear_blend(alpha, a, b) -> Column:
    """``alpha*a + (1-alpha)*b``."""
    return _c(alpha) * _c(a) + (F.lit(1.0) - _c(alpha)) * _c(b)


def stars_from_quantity(col) -> Column:
    """Fixture rule: ``ceil(quantity/10)`` as a double 1..5."""
    return F.ceil(_c(col) / F.lit(10.0)).cast("double")
