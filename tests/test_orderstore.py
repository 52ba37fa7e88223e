"""The store of web orders: lookups by key, ids, deletes, compaction."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyspark.sources import commitlog
from tallyspark.streaming import intake as J
from tallyspark.streaming import orderstore as S
from tallyspark.streaming.stream import make_batch_writer, run_intake_stream, scanned

RULES = J.IntakeRules(as_of=dt.date(2026, 1, 1))
NOW = dt.datetime(2025, 2, 1)


def orders(spark, low, high):
    """Store rows with ids low..high-1; order id ``O<id>``."""
    return spark.range(low, high).select("id", F.concat(F.lit("O"), "id").alias("order_id"), F.lit("C0001").alias("customer_id"), F.lit("SKU0001").alias("sku"), F.lit(1).alias("quantity"),
                                         F.lit("2.5").cast("decimal(18,10)").alias("unit_price"), F.lit(dt.date(2025, 1, 1)).alias("order_date"), F.lit("retail").alias("channel"), F.lit(NOW).alias("created_at"))


def ids(spark, *numbers):
    return spark.createDataFrame([(f"O{n}",) for n in numbers], "order_id string")


def rows(df):
    return sorted((r.id, r.order_id) for r in df.collect())


def scans(df):
    """(files, rows) that the file scans of a run query read."""
    df.collect()
    todo, files, n = [df._jdf.queryExecution().executedPlan()], 0, 0
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        if name == "FileSourceScanExec" and "order_key" in p.toString():
            files += p.metrics().apply("numFiles").value()
            n += p.metrics().apply("numOutputRows").value()
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return files, n


@pytest.fixture(scope="module")
def thousand(spark, tmp_path_factory):
    """A store of 1,000 batches of 30 rows in 8 buckets, written at once."""
    path = str(tmp_path_factory.mktemp("many") / "store")
    S.create_store(spark, path, buckets=8)
    g = S.current(spark, path)
    many = S.keyed(orders(spark, 1, 30_001), 8).withColumn(S.BATCH, F.concat(F.lit("q-"), F.floor((F.col("id") - 1) / 30)))
    many.repartition(8, S.BUCKET).sortWithinPartitions(S.BATCH, S.BUCKET, S.KEY).write.mode("append").partitionBy(S.BATCH, S.BUCKET).parquet(g.rows)
    S.records(many, [S.BATCH, S.BUCKET], True).repartition(8, S.BATCH).write.mode("append").partitionBy(S.BATCH).parquet(g.commits)
    return path


def test_a_micro_batch_reads_only_folders_its_keys_hit(spark, thousand):
    g = S.current(spark, thousand)
    assert len(S.batches(spark, g)) == 1000
    fresh = ids(spark, *range(100_000, 101_000))
    assert S.hit_folders(spark, g, fresh) == []
    assert S.stored(spark, g, fresh).count() == 0
    known = [5, 17, 9_000, 30_000]
    batch = ids(spark, *known, *range(200_000, 200_996))
    folders = S.hit_folders(spark, g, batch)
    want = {(r[0], r[1]) for r in S.keyed(orders(spark, 1, 30_001), 8).where(F.col("id").isin(known)).select(F.concat(F.lit("q-"), F.floor((F.col("id") - 1) / 30)), S.BUCKET).collect()}
    assert {tuple(f.split("=")[1].split("/")[0] if i == 0 else int(f.rsplit("=", 1)[1]) for i in (0, 1)) for f in folders} == want
    found = S.stored(spark, g, batch)
    assert rows(found) == [(n, f"O{n}") for n in known]
    files, _ = scans(found)
    assert files == len(want)
    # the next id comes from the records
    assert all("/commits/" in f for f in S.commits(spark, g).inputFiles())
    assert S.high_water(spark, g) == 30_000 and S.high_water(spark, g, without="q-999") == 29_970
    assert rows(S.find_orders(spark, thousand, spark.createDataFrame([("o77",), ("nope",)], "order_id string"))) == [(77, "O77")]


def test_a_thousand_batches_become_one(spark, thousand):
    before = rows(S.read_store(spark, thousand))
    S.delete_stored(spark, thousand, ids(spark, 3, 29_999)).collect()
    S.compact(spark, thousand)
    g = S.current(spark, thousand)
    # one merged batch, and the last batch of the query with its delete
    assert sorted(S.batches(spark, g)) == [S.COMPACTED, "q-999"]
    assert sum(f.endswith(".parquet") for _, _, fs in os.walk(g.path) for f in fs) <= 3 * S.FIRST_BUCKETS + 12
    assert rows(S.read_store(spark, thousand)) == [r for r in before if r[0] not in (3, 29_999)]
    assert S.high_water(spark, g) == 30_000
    report = S.delete_stored(spark, thousand, ids(spark, 3, 4))
    assert sorted(tuple(r) for r in report.collect()) == [("O3", 0), ("O4", 1)]


def test_one_order_skips_pages_and_files(spark, tmp_path):
    path = str(tmp_path / "store")
    S.create_store(spark, path, buckets=2)
    S.write_batch(spark, S.current(spark, path), "first", orders(spark, 1, 200_001))
    found = S.find_order(spark, path, "o1234")
    files, n = scans(found)
    assert rows(found) == [(1234, "O1234")]
    assert files == 1 and n <= 25_000  # of 200,000 rows in two files
    assert S.find_order(spark, path, "X1").count() == 0


def form(n, price="2"):
    return {"order_id": f"O{n}", "customer_id": "C0001", "sku": "SKU0001", "quantity": "2", "unit_price": price, "order_date": "2025-01-15", "channel": "retail"}


def test_compaction_changes_nothing_that_readers_see(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i in range(5):
        (src / f"{i}.json").write_text("\n".join(json.dumps(form(n)) for n in range(i * 4, i * 4 + 5)))  # one id of the drop before
        paths = run_intake_stream(spark, str(src), out, RULES, NOW, compact_after=None)
    store = paths["store"]
    assert rows(S.read_store(spark, store)) == [(n + 1, f"O{n}") for n in range(21)]
    S.delete_stored(spark, store, ids(spark, 2, 20)).collect()
    old = S.current(spark, store)
    begun = S.read_store(spark, store)
    listing = lambda: [tuple(r) for r in J.list_orders(S.read_store(spark, store), 7, 2).collect()]
    seen, page = rows(begun), listing()
    S.compact(spark, store)
    new = S.current(spark, store)
    assert new != old and rows(S.read_store(spark, store)) == seen and listing() == page
    assert rows(begun) == seen  # still reads the generation it began on
    assert S.high_water(spark, new) == 21
    assert rows(S.find_orders(spark, store, ids(spark, 2, 3, 20))) == [(4, "O3")]
    # a replay of the last epoch gives the same rows and ids, and its deleted row stays deleted
    schema = ", ".join(f"{c} string" for c in J.CANDIDATE_COLUMNS)
    last = scanned(spark.read.schema(schema).json(str(src / "4.json")))
    make_batch_writer(store, paths["rejected"], paths["checkpoint"], RULES, NOW)(last, 4)
    assert rows(S.read_store(spark, store)) == seen and listing() == page
    # the stream goes on: stored ids are refused, deleted ones get new ids
    (src / "9.json").write_text("\n".join(json.dumps(form(n)) for n in (0, 2, 19, 20, 50)))
    run_intake_stream(spark, str(src), out, RULES, NOW, compact_after=1)
    assert [r for r in rows(S.read_store(spark, store)) if r not in seen] == [(22, "O2"), (23, "O20"), (24, "O50")]
    assert S.current(spark, store) != new  # compacted by the stream
    S.compact(spark, store)
    assert not os.path.exists(old.path) and len([d for d in os.listdir(store) if d.startswith("generation-")]) == 2


def test_a_delete_that_meets_a_compaction_is_kept(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    S.create_store(spark, path)
    S.write_batch(spark, S.current(spark, path), "first", orders(spark, 1, 50))
    # a compaction between the delete's lookup and its write
    real, calls = S.current, []

    def current(spark_, path_):
        calls.append(1)
        g = real(spark_, path_)
        if len(calls) == 1:
            monkeypatch.setattr(S, "current", real)
            S.compact(spark, path)
        return g

    monkeypatch.setattr(S, "current", current)
    assert [tuple(r) for r in S.delete_stored(spark, path, ids(spark, 7)).collect()] == [("O7", 1)]
    assert (7, "O7") not in rows(S.read_store(spark, path)) and S.read_store(spark, path).count() == 48
    # a delete while the merge runs
    publish, once = S._start, []

    def start(*a):
        if not once:
            once.append(1)
            S.delete_stored(spark, path, ids(spark, 8)).collect()
        return publish(*a)

    monkeypatch.setattr(S, "_start", start)
    S.compact(spark, path)
    assert S.read_store(spark, path).count() == 47 and (8, "O8") not in rows(S.read_store(spark, path))


def test_log_numbers_are_given_once(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "_log")
    assert commitlog.append(spark, log, "a") == 1
    real = commitlog.last_number
    stale = real(spark, log)
    assert commitlog.append(spark, log, "b") == 2
    monkeypatch.setattr(commitlog, "last_number", lambda *a: stale)  # read before b was there
    assert commitlog.append(spark, log, "c") == 3
    assert commitlog.latest(spark, log) == "c"
    assert sorted(r.value for r in spark.read.text(log).collect()) == ["000000000001 a", "000000000002 b", "000000000003 c"]
