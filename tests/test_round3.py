"""Steps that are computed once, and cheaper forms of shared helpers."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.parse import to_date_lenient
from tallyspark.functions.text import strip_ws
from tallyspark.plans.catalog import QUERIES
from tallyspark.session import ensure_checkpoint_dir
from tallyspark.sources import store as S
from tallyspark.streaming import intake as J
from tallyspark.streaming.stream import read_store, run_intake_stream
from tests import helpers as H
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,scans", [("highlights", 0), ("ref_integrity", 0), ("layer_counts", 1)])
def test_flagged_orders_are_computed_once(spark, name, scans):
    """What is left to run reads the order lines for their own count only."""
    assert plan(QUERIES[name](spark, SF_SMALL)).count("lineitem.parquet") == scans


def test_strip_ws_is_python_strip(spark):
    edges = ["", " ", "\t\n\x0b\f\r", "\x1c\x1d\x1e\x1f", "\xa0", "\x85", "  ", " 　\t", "​", "\x00", "é"]
    texts = [a + m + b for a in edges for b in edges for m in ("", "x", "x y", "x\xa0y", "ß")] + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", strip_ws("t").alias("s")).collect()}
    assert got == {i: t if t is None else t.strip() for i, t in enumerate(texts)}


def test_dates_are_parsed_as_before(spark):
    texts = ["1999-1-2", "1999-01-02", "2000-02-29", "1999-02-29", "2025-13-40", "0000-01-01", "1677-09-21", "1677-09-22", "2262-04-12", "1999-1-2 ", "1999-01-02T00", "99-1-2", "n/d", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.d for r in df.coalesce(1).select(to_date_lenient("t").alias("d")).collect()]
    day = dt.date
    assert got == [day(1999, 1, 2), day(1999, 1, 2), day(2000, 2, 29), None, None, None, None, day(1677, 9, 22), *[None] * 7]


def test_append_joins_on_the_fingerprint_alone(spark):
    row = lambda k, sku="a": (k, "c", sku, "1", "2", "1999-01-01", None)
    old, new = H.orders(spark, [row("O1"), row("O2")]), H.orders(spark, [row("O1"), row("O2", "b"), row("O3"), row("O3")])
    # O2 of the load has the fingerprint of the one before it and other columns
    prints = {r.order_id: r._row_hash for r in old.collect()}
    new = new.withColumn("_row_hash", F.when(F.col("order_id") == "O2", F.lit(prints["O2"])).otherwise(F.col("_row_hash")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = S.incremental_append(old, new)
        assert re.search(r"Join \[_row_hash#\d+\], \[_seen__row_hash#\d+\], LeftAnti", plan(out))
        assert sorted(r.order_id for r in out.collect()) == ["O2", "O3"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stream_keeps_no_batch_in_memory(spark, tmp_path, monkeypatch):
    rows = [(f"W{i % 40}", "C0001", "SKU0001", "1" if i % 7 else "x", "2.5", "1999-01-01", "retail") for i in range(60)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in J.CANDIDATE_COLUMNS)).coalesce(1).write.json(f"{tmp_path}/in")
    held = []
    from tallyspark.streaming import orderstore
    write = orderstore.write_batch

    def watched(spark, g, batch, rows, before_commit=None):
        held.append(plan(rows) + spark._jsparkSession.sharedState().cacheManager().isEmpty().__str__())
        return write(spark, g, batch, rows, before_commit)

    monkeypatch.setattr(orderstore, "write_batch", watched)
    spark.catalog.clearCache()
    paths = run_intake_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", J.IntakeRules(as_of=dt.date(2020, 1, 1)), dt.datetime(1970, 1, 1))
    assert held and all(h.endswith("True") and "InMemoryTableScan" not in h for h in held)
    assert read_store(spark, paths["store"]).count() == len({r[0] for r in rows if r[3] == "1"})
    assert read_store(spark, paths["store"]).count() + spark.read.parquet(paths["rejected"]).count() == len(rows)
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not [d for d in os.listdir(f"{base}/tallyspark") if d.startswith("validated-")]
