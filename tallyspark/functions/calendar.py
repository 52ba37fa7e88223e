"""Calendar attributes of a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(c: Column | str) -> Column:
    """yyyymmdd as INT."""
    d = F.col(c) if isinstance(c, str) else c
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The dim_date attributes: ISO week with calendar year, Monday = 0."""
    return [
        date_id(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    ]
