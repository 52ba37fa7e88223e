"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyspark.session import ensure_checkpoint_dir

# Words are maximal runs of characters other than space, TAB, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
FEW_KEYS = 1_000_000  # 64-bit keys that may be broadcast, counted before


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; sizes the partitions of what follows."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def slices(texts: pa.Array, most: int):
    """(place of the first, texts as Python strings) of runs of up to ``most`` bytes, or of one longer text; NULL is empty."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    done = np.cumsum(size)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(done, done[a] - size[a] + most, "right")))
        yield a, texts.slice(a, b - a).to_pylist()
        a = b


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key that every row has: its id or, without one, a hash of its text above all ids in use."""
    return F.coalesce(F.col(doc_id).cast("long"), F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(1 << 62)))


def without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``gone`` (one column).  The keys are written first; few of them are broadcast, so ``docs`` is not shuffled."""
    gone = cut(gone.toDF("__w_key").distinct())
    few = gone.count() <= FEW_KEYS
    return docs.join(F.broadcast(gone) if few else gone, key == gone["__w_key"], "left_anti")


def one_each(docs: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """One row of every ``key``, that with the smallest text; only rows of keys that come twice are put in order."""
    keys = docs.select(key.alias("__o_key")).groupBy("__o_key").count().where("count > 1").select("__o_key")
    keys = cut(keys)
    n = keys.count()
    if not n:
        return docs
    hinted = F.broadcast(keys) if n <= FEW_KEYS else keys
    twice = docs.join(hinted, key == keys["__o_key"], "left_semi").withColumn("__o_key", key)
    first = Window.partitionBy("__o_key").orderBy(F.col(text).asc_nulls_first())
    twice = twice.withColumn("__o_n", F.row_number().over(first)).where("__o_n = 1").drop("__o_n", "__o_key")
    return docs.join(hinted, key == keys["__o_key"], "left_anti").unionByName(twice)


# The functions of this package travel to the executors by value, so workers need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules["tallyspark.llm"])
