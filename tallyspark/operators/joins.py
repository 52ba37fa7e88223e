"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def null_safe_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left ⟕ right`` on ``key`` where NULL matches NULL (pandas merge).

    ``right`` must be unique on ``key`` (a deduped dimension), so no left row
    is multiplied.  Catalyst plans ``<=>`` as an equi-join on
    (coalesce(key), isnull(key)): a broadcast hash join when the dimension is
    small (AQE measures it at run time), otherwise a sort-merge join.  In the
    sort-merge case every NULL key lands in one partition; AQE's skew-join
    rule splits that partition of the left (streamed) side across tasks and
    replicates the matching right rows, which for the NULL key is at most one
    row.  One join instead of a NULL / non-NULL split keeps the left input
    computed once.
    """
    right_cols = [c for c in right.columns if c != key]
    r = right.withColumnRenamed(key, "_rk")
    joined = left.join(r, left[key].eqNullSafe(r["_rk"]), "left")
    return joined.select(*left.columns, *right_cols)
