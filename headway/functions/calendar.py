"""Calendar and time-of-day expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time-of-day periods as half-open hour ranges [start, end).
# Any other integer hour (including >= 24 and negatives) is "Night";
# a missing hour is "Unknown".
TIME_PERIODS = [
    ("Early Morning", 5, 7),
    ("AM Rush", 7, 10),
    ("Midday", 10, 16),
    ("PM Rush", 16, 20),
    ("Evening", 20, 24),
]
NIGHT = "Night"
UNKNOWN = "Unknown"

# Rush hours are 7-9 and 16-19 inclusive.
RUSH_RANGES = [(7, 9), (16, 19)]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_of_week_mon0(date) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(date)).cast("int")


def day_of_week_sun0(date) -> Column:
    """0 = Sunday ... 6 = Saturday (the SQL tables' convention)."""
    return (F.dayofweek(_c(date)) - 1).cast("int")


def day_name(date) -> Column:
    return F.date_format(_c(date), "EEEE")


def month_name(date) -> Column:
    return F.date_format(_c(date), "MMM")


def year_month(date) -> Column:
    return F.date_format(_c(date), "yyyy-MM")


def iso_week(date) -> Column:
    return F.weekofyear(_c(date)).cast("int")


def is_weekend(date) -> Column:
    return (F.weekday(_c(date)) >= 5).cast("int")


def is_rush_hour(hour) -> Column:
    h = _c(hour)
    cond = None
    for lo, hi in RUSH_RANGES:
        c = h.between(lo, hi)
        cond = c if cond is None else (cond | c)
    return F.coalesce(cond.cast("int"), F.lit(0))


def time_period(hour) -> Column:
    h = _c(hour)
    expr = F.when(h.isNull(), F.lit(UNKNOWN))
    for label, lo, hi in TIME_PERIODS:
        expr = expr.when((h >= lo) & (h < hi), F.lit(label))
    return expr.otherwise(F.lit(NIGHT))


def hour_from_time_text(time) -> Column:
    """Hour of a clock text.

    ``H:MM`` / ``HH:MM`` with a valid clock reading gives its hour; otherwise the
    first two characters read as a number (so ``07:05:00`` -> 7, ``25:10`` -> 25,
    ``-1:00`` -> -1); otherwise 0.
    """
    t = _c(time).cast("string")
    clock = r"^(\d{1,2}):(\d{1,2})$"
    hh = F.regexp_extract(t, clock, 1)
    mm = F.regexp_extract(t, clock, 2)
    strict = F.when(
        t.rlike(clock) & (hh.try_cast("int") <= 23) & (mm.try_cast("int") <= 59),
        hh.try_cast("int"),
    )
    # the first two characters count only when they are a plain decimal number
    # (Java-style suffixes such as "1d" or special words are not numbers here)
    lead = F.substring(t, 1, 2)
    plain = lead.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$")
    fallback = F.when(plain, lead.try_cast("double")).cast("int")
    return F.coalesce(strict, fallback, F.lit(0)).cast("int")
