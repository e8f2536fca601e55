"""Column -> Column helpers.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; none of it is a Python UDF. Spark 4 runs with ANSI
mode on, so every place where the source data may be malformed uses a
``try_*`` function and yields NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the studied pipeline's for identical results.
# ---------------------------------------------------------------------------
DATE_FORMAT = "yyyy-MM-dd"
YEAR_PATTERN = r"^\d{4}$"
RATING_PATTERN = r"^\d+\.?\d*$"
TITLE_STRIP_PATTERN = r"[^a-z0-9\s]"
TRUE_TOKENS = ("Yes", "yes", "TRUE", "1")
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
EPOCH_TIMESTAMP = "1900-01-01 00:00:00"
ENRICHMENT_STATUSES = ("SUCCESS", "FUZZY_MATCH", "NOT_FOUND", "ERROR")
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str = DATE_FORMAT) -> Column:
    """Text -> DATE with ``fmt``; malformed or impossible dates -> NULL."""
    return F.try_to_date(_col(c), fmt)


def safe_date(c) -> Column:
    """SAFE_CAST(x AS DATE) — NULL where the cast fails."""
    return _col(c).try_cast("date")


def safe_year(c) -> Column:
    """Exactly four digits -> INT, anything else -> NULL."""
    c = _col(c)
    return F.when(c.rlike(YEAR_PATTERN), c.try_cast("int"))


def safe_rating(c) -> Column:
    """Unsigned decimal text -> FLOAT, else NULL. No 0.5–5 bound."""
    c = _col(c)
    return F.when(c.rlike(RATING_PATTERN), c.try_cast("float"))


def flag_tokens(c, tokens=TRUE_TOKENS) -> Column:
    """P5: membership in the accepted true-token set; NULL stays NULL."""
    return _col(c).isin(*tokens)


def normalize_title(c) -> Column:
    """Lower -> trim -> delete every char outside [a-z0-9 whitespace]."""
    return F.regexp_replace(F.trim(F.lower(_col(c))), TITLE_STRIP_PATTERN, "")


def split_tags(c, sep: str = ",") -> Column:
    """Split on the separator; items are not trimmed; '' -> ['']."""
    return F.split(_col(c), sep)


def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined text casts, NULL replaced by a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN))
             for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def month_name(c) -> Column:
    """Full English month name."""
    return F.date_format(_col(c), "MMMM")


def day_name(c) -> Column:
    """Full English day name."""
    return F.date_format(_col(c), "EEEE")


def day_of_week(c) -> Column:
    """P20: 1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_col(c))


def year_quarter(c) -> Column:
    """P21: 'YYYY-Qn'."""
    c = _col(c)
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def is_weekend(c) -> Column:
    """Sunday or Saturday."""
    return day_of_week(c).isin(1, 7)


def week_of_year_sunday(c) -> Column:
    """Sunday-based week number 0–53 (strftime %U), not ISO weeks."""
    c = _col(c)
    return F.floor((F.dayofyear(c) + F.lit(7) - F.dayofweek(c)) / F.lit(7)).cast("int")


def epoch_timestamp() -> Column:
    """The 1900-01-01 floor used when a high-water mark has no rows."""
    return F.lit(EPOCH_TIMESTAMP).cast("timestamp")


def safe_divide(numerator, denominator) -> Column:
    """P25: NULL when the denominator is 0 or NULL."""
    return F.try_divide(_col(numerator), F.nullif(_col(denominator), F.lit(0)))


def zero_to_null(c) -> Column:
    """0 (or NULL) -> NULL, otherwise the value."""
    return F.nullif(_col(c), F.lit(0))


def year_prefix(c) -> Column:
    """Year from the first four characters of a date text, only if digits."""
    head = F.substring(_col(c), 1, 4)
    return F.when(head.rlike(YEAR_PATTERN), head.try_cast("int"))
