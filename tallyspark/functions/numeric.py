"""Money, ratio and rounding expressions.

Money stays DECIMAL through every sum so totals are exact; it becomes DOUBLE
only at presentation.  Ratios are computed in DOUBLE and rounded half away
from zero on the scaled value, an expression that gives the same bits in any
IEEE engine (Spark's ``round`` rounds the shortest decimal representation,
which disagrees with other engines at exact ties).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _c(c).cast("double")


def round_half_away(c: Column | str, digits: int) -> Column:
    x = _c(c).cast("double")
    scale = float(10 ** digits)
    return F.when(x < 0, -F.floor(-x * scale + 0.5)).otherwise(F.floor(x * scale + 0.5)) / scale


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den in DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    """round(num / den * 100, digits), NULL on a zero denominator."""
    return round_half_away(ratio(num, den) * 100.0, digits)
