"""Reading the given Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale-factor folder; column pruning and filter
    pushdown happen at the scan because callers select/filter lazily."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
