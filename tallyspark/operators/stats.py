"""Exact median without gathering a column in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, col: str, out: str = "median",
                 accuracy: int = 100_000, band: int = 10) -> DataFrame:
    """One-row DataFrame with the exact median of ``col`` (NULLs ignored).

    For an even count the two middle values are averaged as
    ``(a + b) * 0.5`` in the column's own type, so DECIMAL input stays exact.

    Plan, all distributed:
      1. one aggregate, used as a scalar subquery: n and approximate
         quantiles at 0.5 ± band/accuracy (GK sketch, rank error <=
         n/accuracy, so the band is 10x wider than the error and always holds
         the two middle ranks);
      2. one keyed aggregate: rows below the band, rows above it, and the
         distinct values inside it with their counts;
      3. a running count over that small result finds the values at ranks
         floor((n-1)/2) and floor(n/2).
    Only step 3 is single-task, over about 2·band/accuracy·n values at most.
    A band that misses the middle ranks raises an error instead of returning
    a wrong value.
    """
    v = F.col("_v")
    vals = df.select(F.col(col).alias("_v")).filter(v.isNotNull())
    d = band / accuracy
    stats = vals.agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", [max(0.5 - d, 0.0), min(0.5 + d, 1.0)], accuracy).alias("_q"),
    ).select(F.struct("_n", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))).scalar()
    # the scalar is projected once; its fields are read from that column
    tagged = vals.select("_v", stats.alias("_s"))
    lo, hi = F.col("_s._lo"), F.col("_s._hi")
    zone = F.when(v < lo, F.lit(0)).when(v > hi, F.lit(2)).otherwise(F.lit(1))
    hist = (tagged.groupBy(zone.alias("_zone"), F.when(zone == 1, v).alias("_bv"), F.col("_s._n").alias("_n"))
                  .agg(F.count(F.lit(1)).alias("_c")))
    w = Window.orderBy("_zone", "_bv").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_end", F.sum("_c").over(w)).withColumn("_start", F.col("_end") - F.col("_c"))
    k1 = F.floor((F.col("_n") - 1) / 2)
    k2 = F.floor(F.col("_n") / 2)
    at = lambda k: F.max(F.when((F.col("_zone") == 1) & (F.col("_start") <= k) & (k < F.col("_end")), F.col("_bv")))
    picked = cum.agg(at(k1).alias("_a"), at(k2).alias("_b"), F.max("_n").alias("_n"))
    found = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    value = (F.col("_a") + F.col("_b")) * F.lit(Decimal("0.5"))
    return picked.select(
        F.when(F.col("_n").isNull(), F.lit(None))
         .when(found, value)
         .otherwise(F.raise_error(F.lit("exact_median: quantile band missed the middle ranks")))
         .alias(out))
