"""Lenient string -> typed parsers: bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number, optionally signed, with optional exponent and
# surrounding whitespace.  Spark's casts also accept suffixes such as "12d";
# the guard rejects them.
NUMBER_RE = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
# y-M-d with 1-2 digit month/day and nothing around it.
DATE_RE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"

# First and last whole day of a 64-bit nanosecond timestamp.
FIRST_DATE, LAST_DATE = "1677-09-22", "2262-04-11"
# Parsed numbers keep 20 digits before and 8 behind the point; nothing is cut to
# cents or whole units.
NUMBER_TYPE = "decimal(28,8)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """String -> DECIMAL(28,8), fractions included; what is not a number -> NULL."""
    c = _c(c)
    return F.when(c.rlike(NUMBER_RE), c.try_cast(NUMBER_TYPE))


def to_date_lenient(c: Column | str) -> Column:
    """String -> DATE for y-M-d text; invalid calendar dates, and dates that a
    nanosecond timestamp cannot hold, -> NULL."""
    c = _c(c)
    d = F.when(c.rlike(DATE_RE), c.try_cast("date"))
    return F.when(d.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")), d)


def to_bool_exact(c: Column | str) -> Column:
    """Exact map "True" -> true, "False" -> false, anything else -> NULL."""
    c = _c(c)
    return F.when(c == "True", F.lit(True)).when(c == "False", F.lit(False))
