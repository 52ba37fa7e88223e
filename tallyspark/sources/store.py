"""Sinks and loads: landing CSV files, incremental appends, merging sources,
exporting web orders to the raw order layout."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import shuffles_dropped
from tallyspark.sources.raw import RAW_COLUMNS, business_columns, scan_csv, to_raw


SLICES = 4  # of a whole history that is appended to


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read back: what reads it several times computes it once."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, order: str | None = "_ord") -> None:
    """Write text columns as CSV with a header, keeping whitespace as is.

    With ``order`` the rows are range-sorted first, so part files named in
    sequence hold the rows in that order (file order is meaningful to
    keep-first dedupe).
    """
    if order:
        df = df.orderBy(order).drop(order)
    with shuffles_dropped(df.sparkSession):
        (df.write.mode("overwrite").option("header", True).option("escape", '"')
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
           .csv(path))


def land_inputs(raw_inputs: dict[str, DataFrame], landing: str) -> dict[str, str]:
    """Write business columns of raw inputs as CSV files: the landing zone a
    refresh reads from."""
    paths = {}
    for name, df in raw_inputs.items():
        p = f"{landing}/{name}"
        write_csv(df.select(*RAW_COLUMNS[name], "_ord"), p)
        paths[name] = p
    return paths


def scan_landing(spark: SparkSession, paths: dict[str, str], loaded_at: _dt.datetime) -> dict[str, DataFrame]:
    return {name: to_raw(scan_csv(spark, p, RAW_COLUMNS[name]), RAW_COLUMNS[name], loaded_at)
            for name, p in paths.items()}


def incremental_append(existing_raw: DataFrame, incoming_raw: DataFrame) -> DataFrame:
    """Rows of ``incoming_raw`` whose business fingerprint is not loaded yet,
    first occurrence per fingerprint within the batch (for ``mode=append``).

    The loaded history grows with every load, the batch does not.  So the
    history is first cut down to the batch's fingerprints with a semi-join
    (a broadcast of the batch's distinct hashes when AQE finds them small,
    filtering the history scan map-side), and only that remainder meets the
    batch in the anti-join; the whole history is never shuffled.

    The fingerprint covers business columns only; the reference's also
    covers the load time, which changes every run and so never matches.  Two
    different rows can have one fingerprint (its parts are only joined), so
    rows are equal when their business columns are, NULL like NULL.
    """
    from tallyspark.operators.dedupe import keep_first
    columns = business_columns(incoming_raw)
    batch_hashes = incoming_raw.select("_row_hash")
    seen = existing_raw.select("_row_hash", *columns).join(batch_hashes, "_row_hash", "left_semi")
    seen = seen.select(*[F.col(c).alias(f"_seen_{c}") for c in seen.columns])
    # the fingerprint alone is the join key, by which ``seen`` lies already; a sum of both sides' columns is no key
    equal = F.lit(0)
    for c in columns:
        equal = equal + incoming_raw[c].eqNullSafe(seen[f"_seen_{c}"]).cast("int")
    same = (incoming_raw["_row_hash"] == seen["_seen__row_hash"]) & (equal == len(columns))
    return keep_first(incoming_raw.join(seen, same, "left_anti"), ["_row_hash", *columns])


def appended(existing_raw: DataFrame, incoming_raw: DataFrame, path: str, slices: int = SLICES) -> DataFrame:
    """``incremental_append`` of whole inputs, one slice of the fingerprints after the other, written below ``path``.

    Equal rows have one fingerprint and so lie in one slice.  Only one slice at a time is in shuffle files; the inputs are read once per slice."""
    spark = incoming_raw.sparkSession
    at = F.pmod(F.xxhash64("_row_hash"), F.lit(slices))
    out = None
    with shuffles_dropped(spark):
        for i in range(slices):
            part = written(incremental_append(existing_raw.where(at == i), incoming_raw.where(at == i)), f"{path}/{i}")
            out = part if out is None else out.unionAll(part)
    return out


def union_in_order(frames: list[DataFrame]) -> DataFrame:
    """Concatenate sources in priority order (earlier frame = earlier in the
    file).  ``_ord`` becomes (source index, each source's own order), so a
    keep-first dedupe after the union prefers earlier sources."""
    fields = [f"s{i}" for i in range(len(frames))]
    types = [f.schema["_ord"].dataType for f in frames]
    out = None
    for i, f in enumerate(frames):
        parts = [F.lit(i).alias("src")]
        for j, name in enumerate(fields):
            parts.append((F.col("_ord") if j == i else F.lit(None).cast(types[j])).alias(name))
        g = f.withColumn("_ord", F.struct(*parts))
        out = g if out is None else out.unionByName(g)
    return out


def in_sequence(frames: list[DataFrame]) -> DataFrame:
    """Concatenate inputs of one kind, earlier frames first.  Their ``_ord``
    have one type, and that of the result is the same for any number of
    frames, so loads of different times can be put in sequence again."""
    out = None
    for i, f in enumerate(frames):
        g = f.withColumn("_ord", F.struct(F.lit(i).alias("source"), F.col("_ord").alias("at")))
        out = g if out is None else out.unionByName(g)
    return out


def web_export(store: DataFrame) -> DataFrame:
    """Stored web orders in the raw order layout (7 text columns), ordered by id."""
    return store.select(
        "order_id", "customer_id", "sku",
        F.col("quantity").cast("string").alias("quantity"),
        F.col("unit_price").cast("string").alias("unit_price"),
        F.col("order_date").cast("string").alias("order_date"),
        "channel",
        F.struct(F.col("id").alias("id")).alias("_ord"))


def web_orders_as_raw(spark: SparkSession, store: DataFrame, landing: str, loaded_at: _dt.datetime) -> DataFrame:
    """Export web orders to CSV (the batch file of the refresh) and scan it
    back as a raw order input."""
    write_csv(web_export(store), landing)
    return to_raw(scan_csv(spark, landing, RAW_COLUMNS["orders"]), RAW_COLUMNS["orders"], loaded_at)


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one and not the other (multiset), as one count.

    Each distinct row counts by how many more times one side has it; both sides are shuffled once."""
    cols = a.columns
    signed = a.select(*cols, F.lit(1).alias("_side")).union(b.select(*cols, F.lit(-1).alias("_side")))
    more = signed.groupBy(*cols).agg(F.abs(F.sum("_side")).alias("_more"))
    return more.agg(F.coalesce(F.sum("_more"), F.lit(0)).cast("bigint").alias("diff_rows"))
