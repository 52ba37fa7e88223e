"""Raw layer: CSV scan with explicit string schema, null tokens and lineage.

Raw tables keep every input row, add where it came from (``_source_file``),
when it was loaded (``_loaded_at``, one value per run, passed in so that a
rerun is reproducible) and a business-column fingerprint (``_row_hash``) that
incremental loads compare against.  ``_ord`` keeps the input order that
keep-first dedupe needs; it is stamped at the scan, before any shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.hashing import row_hash
from tallyspark.functions.text import nullify_tokens
from tallyspark.sources import csvrecords

# Business columns of the three raw inputs, in file order.
ORDER_COLUMNS = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel"]
CUSTOMER_COLUMNS = ["customer_id", "name", "country", "segment", "created_at"]
PRODUCT_COLUMNS = ["sku", "category", "cost", "active"]
RAW_COLUMNS = {"orders": ORDER_COLUMNS, "customers": CUSTOMER_COLUMNS, "products": PRODUCT_COLUMNS}


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def scan_csv(spark: SparkSession, path: str, columns: list[str], malformed: str = "fail") -> DataFrame:
    """Read CSV files with a header as all-string columns (never inferSchema).

    Columns are taken by header name, whatever their order; a missing one is
    an error, and so is a file whose header differs from the first one's.
    Doubled quotes inside quoted cells are unescaped, and line feeds inside them stay.

    A record with more cells than the header is an error when it is read
    (``malformed="fail"``) or left out (``"drop"``) and told by ``malformed_rows``; one with
    fewer has NULLs at its end.

    A first pass over the files finds whether there are such records or cells with line feeds; without them
    Spark's own reader takes the files line by line, else ``csvrecords`` does.

    ``_ord`` = (file path, split start, position within the split): the row
    order of the files, stable on recomputation.
    """
    found = csvrecords.survey(spark, path)
    df = (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
          .option("enforceSchema", False).option("escape", '"').csv(path))
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    most = found.agg(F.max("opens").alias("opens"), F.max("fields").alias("fields")).first()
    if not most.opens and (most.fields or 0) <= len(df.columns):
        return df.select(
            *columns,
            F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos")).alias("_ord"),
            F.col("_metadata.file_name").alias("_source_file"),
        )
    rows = csvrecords.parsed(spark, path, df.columns, found)
    if malformed == "drop":
        rows = rows.where(F.col("_cells") <= len(df.columns))
    else:
        told = F.concat(F.lit(f"record with more than {len(df.columns)} cells in "), F.col("_file"), F.lit(": "), F.substring("_record", 1, 200))
        rows = rows.withColumn("_file", F.when(F.col("_cells") > len(df.columns), F.raise_error(told)).otherwise(F.col("_file")))
    place = [F.col(f"_{c}").alias(c) for c in ("file", "block", "pos")]
    return rows.select(*columns, F.struct(*place).alias("_ord"), F.col("_name").alias("_source_file"))


def malformed_rows(spark: SparkSession, path: str) -> DataFrame:
    """file, block, pos, cells, record of the records with more cells than their header."""
    found = csvrecords.survey(spark, path)
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    rows = csvrecords.parsed(spark, path, header, found)
    return rows.where(F.col("_cells") > len(header)).select(*[F.col(f"_{c}").alias(c) for c in ("file", "block", "pos", "cells", "record")])


def to_raw(df: DataFrame, columns: list[str], loaded_at: _dt.datetime | str | None = None) -> DataFrame:
    """Normalise null tokens and add lineage columns to a scanned input."""
    if loaded_at is None:
        loaded_at = _dt.datetime(1970, 1, 1)
    ts = F.lit(loaded_at).cast("timestamp") if isinstance(loaded_at, str) else F.lit(loaded_at)
    cleaned = df.select(*[nullify_tokens(c).alias(c) for c in columns], "_ord", "_source_file")
    return cleaned.select(
        *columns, "_ord", "_source_file",
        ts.alias("_loaded_at"),
        row_hash(*columns).alias("_row_hash"),
    )


def business_columns(df: DataFrame) -> list[str]:
    """Drop metadata: every column whose name starts with '_'."""
    return [c for c in df.columns if not c.startswith("_")]
