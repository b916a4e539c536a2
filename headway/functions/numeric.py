"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def r(x, places: int) -> Column:
    """Round a double to ``places`` decimals by scale -> round -> unscale.

    ``F.round(x, p)`` rounds the shortest decimal text of ``x`` (so 1.005 -> 1.01),
    while SQL engines that scale first give 1.0.  Scaling first and rounding to an
    integer (half away from zero) gives the same answer as those engines on every
    value, so every rounded output in the library goes through this helper.
    """
    scale = float(10 ** places)
    return F.round(_c(x) * F.lit(scale)) / F.lit(scale)


def pct(x) -> Column:
    """Mean of a 0/1 column as a percentage (not rounded)."""
    return F.avg(_c(x)) * F.lit(100.0)


# Texts read as numbers: optional sign, digits with an optional point or a
# leading point, an optional exponent, or an infinity word; spaces around.
PLAIN_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|Inf|INF|infinity|Infinity)\s*$"
INFINITY_WORD = r"^\s*[+-]?[iI]"


def parse_number(text) -> Column:
    """Text -> double, null unless the text is a plain number (no ``1d``-style suffixes).

    A number too large for a double is no number; only an infinity word is infinite.
    """
    t = _c(text).cast("string")
    v = t.try_cast("double")
    finite = F.abs(v) < F.lit(float("inf"))
    return F.when(t.rlike(PLAIN_NUMBER) & (finite | t.rlike(INFINITY_WORD)), v)
