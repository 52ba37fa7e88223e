"""Inline raw inputs for unit tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.plans.pipeline import Pipeline
from tallyspark.sources.raw import CUSTOMER_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS, to_raw


def raw(spark, columns, rows):
    """String rows in file order -> raw frame with _ord and lineage."""
    schema = ", ".join(f"{c} string" for c in columns) + ", _pos long"
    data = [tuple(r) + (i,) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, schema)
    df = df.select(*columns, F.struct(F.col("_pos").alias("pos")).alias("_ord"),
                   F.lit("inline.csv").alias("_source_file"))
    return to_raw(df, columns)


def orders(spark, rows):
    return raw(spark, ORDER_COLUMNS, rows)


def customers(spark, rows):
    return raw(spark, CUSTOMER_COLUMNS, rows)


def products(spark, rows):
    return raw(spark, PRODUCT_COLUMNS, rows)


def pipeline(spark, order_rows, customer_rows, product_rows):
    return Pipeline.from_frames(orders(spark, order_rows), customers(spark, customer_rows),
                                products(spark, product_rows))


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]
