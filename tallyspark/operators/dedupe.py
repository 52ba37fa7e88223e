"""Keep-first dedupe by key in input order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str | list[str], order: str | list[str] = "_ord") -> DataFrame:
    """The first row of every key in ``order``; NULL keys form one group.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so a hot key sends at most one row per map task across the
    network.  ``dropDuplicates`` would keep an arbitrary survivor.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc() for o in orders])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """One row: rows beyond the first per key (NULL keys are one group).

    Counted with a keyed aggregate (map-side combine) rather than a window,
    so a hot key never lands whole in one task.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
