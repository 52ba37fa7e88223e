"""Row fingerprint for raw-layer lineage and incremental loads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(*cols: str) -> Column:
    """md5 hex of the '|'-joined values, NULL written as 'nan'.

    ``concat_ws`` skips NULLs, so a marker is needed to keep ("a", NULL, "b")
    apart from ("a", "b").
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))
