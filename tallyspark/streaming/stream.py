"""Continuous order intake with Structured Streaming.

A file source (JSON, explicit all-string schema) feeds ``foreachBatch``,
which runs the batch intake for every micro-batch: validate, keep the first
submission per id, anti-join against the stored orders, assign ids after the
stored maximum and append.  Rejected rows go to their own table.

The JSON holds the seven form fields only; the order of submissions is
stamped at the scan (file path, position in the file) before any shuffle.

Uniqueness lives in the stored table, not in streaming state, so the key set
can grow without bound; ``orderstore`` finds a batch's ids there and knows the
highest id given without reading the history.  Every micro-batch is a batch of its own in the
store and a folder of its own in the rejected table, named by the query's id and the epoch, and
overwrites it; when it is replayed after a failure it reads the store without
that batch, so both tables end up as after one run.  One writer (this query)
decides ids, which keeps them dense and ordered.  Rejected rows keep every
submitted value as it came.  After ``orderstore.BATCHES`` batches the store is compacted.

A delete adds the ids of the removed rows to a table in the store, and
readers of the store leave those rows out until a compaction drops them.  A deleted order id can be submitted
again; it gets a new id, since ids count on from the highest one ever given.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.session import scratch_path
from tallyspark.sources import commitlog
from tallyspark.sources.store import written
from tallyspark.streaming import intake, orderstore
from tallyspark.streaming.orderstore import BATCH, create_store, delete_stored, read_store

__all__ = ["create_store", "delete_stored", "make_batch_writer", "read_store", "run_intake_stream"]

CANDIDATE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in intake.CANDIDATE_COLUMNS])

def scanned(rows: DataFrame) -> DataFrame:
    """Submitted fields with the file and split they come from."""
    return rows.select(*intake.CANDIDATE_COLUMNS, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def stamped(batch: DataFrame) -> DataFrame:
    """Candidates with ``_ord``, their place among the files, and ``_raw``, the values as submitted."""
    place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("pos"))
    return batch.select(*intake.CANDIDATE_COLUMNS, place.alias("_ord"), F.struct(*intake.CANDIDATE_COLUMNS).alias("_raw"))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that the checkpoint gives its query; another checkpoint has another one."""
    return json.loads("".join(r.value for r in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]


def make_batch_writer(store_path: str, rejected_path: str, checkpoint: str, rules: intake.IntakeRules,
                      created_at: _dt.datetime | None = None, compact_after: int | None = orderstore.BATCHES):
    """``rules.as_of`` and ``created_at`` are fixed where given; otherwise each micro-batch takes its own day and time."""
    def process(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        folder = f"{query_id(spark, checkpoint)}-{epoch_id}"
        g = orderstore.current(spark, store_path)
        # written, not cached: each reader takes the columns it needs, and no place among the files is told twice
        held = scratch_path(spark, "validated")
        try:
            validated = written(intake.validate(stamped(batch), rules if rules.as_of else replace(rules, as_of=now.date())), held)
            known = orderstore.stored(spark, g, validated.where("is_valid").select("order_id"), without=folder)
            accepted, conflicts = intake.accept(validated, known)
            new_rows = intake.insert(accepted, None, created_at or now, after=orderstore.high_water(spark, g, without=folder))
            rejected = (validated.filter(~F.col("is_valid")).unionByName(conflicts)
                        .select(*[F.col(f"_raw.{c}").alias(c) for c in intake.CANDIDATE_COLUMNS], "errors",
                                F.lit(epoch_id).cast("bigint").alias("epoch_id")))
            orderstore.write_batch(spark, g, folder, new_rows,
                                   before_commit=lambda: rejected.write.mode("overwrite").parquet(f"{rejected_path}/{BATCH}={folder}"))
        finally:
            fs, p = commitlog.hadoop_path(spark, held)
            fs.delete(p, True)
        if compact_after and len(orderstore.batches(spark, g)) > compact_after:
            orderstore.compact(spark, store_path)
    return process


def run_intake_stream(spark: SparkSession, source_dir: str, out_dir: str, rules: intake.IntakeRules,
                      created_at: _dt.datetime | None = None, max_files_per_trigger: int | None = None,
                      processing_time: str | None = None, compact_after: int | None = orderstore.BATCHES):
    """Consume order files from ``source_dir``.

    By default every file present is processed (``availableNow``) and the
    call returns the paths of the store, the rejected table and the
    checkpoint; rerunning with the same checkpoint processes only new files.
    With ``processing_time`` (e.g. ``"1 minute"``) the query keeps running
    on that trigger and the started ``StreamingQuery`` is returned with the
    paths as ``(query, paths)``.
    """
    paths = {k: os.path.join(out_dir, k) for k in ("store", "rejected", "checkpoint")}
    create_store(spark, paths["store"])
    reader = spark.readStream.schema(CANDIDATE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = scanned(reader.json(source_dir))
    writer = (stream.writeStream
              .foreachBatch(make_batch_writer(paths["store"], paths["rejected"], paths["checkpoint"], rules, created_at, compact_after))
              .option("checkpointLocation", paths["checkpoint"]))
    if processing_time:
        return writer.trigger(processingTime=processing_time).start(), paths
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return paths
