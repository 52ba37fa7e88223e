"""The stored web orders, found by key: hash buckets, commit records, compaction.

A store is a series of generations; the last entry of its generation log names
the current one, its number of buckets and the highest id given before it.  A
generation holds

* ``rows``: one folder per batch and, in it, per bucket of the order id's hash;
  files are sorted by that hash and carry Parquet Bloom filters on the order
  id, so that row groups without a wanted id are skipped;
* ``commits``: one small record per batch and bucket: number of rows, lowest and
  highest id, and the sorted 32-bit fingerprints of its keys (NULL in large
  batches).  It is written last; a batch without one is not read;
* ``deleted``: ids of removed rows, which readers leave out.

Keys are looked up in the records first: only folders whose bucket and
fingerprints they hit are read, and the next id comes from the records'
highest, so the cost of a micro-batch follows the batch and not the history.

Compaction writes the live rows of all batches, but for the last one of each
query, as one batch of a new generation, whose bucket count follows its rows, and
then adds the generation to the log.  A reader that has begun on the old one
goes on undisturbed: the generation before the current one is kept.  The last
batch of a query stays a batch of its own, with its deletes, since its query
may replay it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources import commitlog
from tallyspark.streaming import intake

BATCH, BUCKET, KEY = "batch_id", "bucket", "order_key"
ROWS_SCHEMA = T.StructType([*intake.STORE_SCHEMA.fields, T.StructField(KEY, T.LongType()),
                            T.StructField(BATCH, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
RECORD_SCHEMA = f"{BUCKET} int, n long, low_id long, high_id long, prints array<int>, {BATCH} string"
DELETED_SCHEMA = f"id long, order_id string, {BATCH} string"
FIRST_BUCKETS, MOST_BUCKETS = 16, 4096
ROWS_PER_BUCKET = 1 << 20
PRINTS = 4096            # fingerprints kept for a folder, about
BATCHES = 32             # batches of a generation before it is compacted
COMPACTED = "compacted"


@dataclass(frozen=True)
class Generation:
    path: str
    buckets: int
    given: int           # highest id given to rows that are no longer in a batch of their own

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def commits(self) -> str:
        return f"{self.path}/commits"

    @property
    def deleted(self) -> str:
        return f"{self.path}/deleted"


def _log(path: str) -> str:
    return f"{path}/_generations"


def current(spark: SparkSession, path: str) -> Generation:
    """The generation that the log names last.  A store is created before it is read, so a path without one is an error, never an empty store."""
    name, buckets, given = commitlog.latest(spark, _log(path)).split(" ")
    return Generation(f"{path}/{name}", int(buckets), int(given))


def _start(spark: SparkSession, path: str, buckets: int, given: int) -> Generation:
    """A new generation with an empty batch and no deletes; not in the log yet."""
    g = Generation(f"{path}/generation-{uuid.uuid4().hex[:12]}", buckets, given)
    write_batch(spark, g, "none", intake.empty_store(spark))
    intake.empty_store(spark).select("id", "order_id").write.parquet(f"{g.deleted}/{BATCH}=none")
    return g


def _publish(spark: SparkSession, path: str, g: Generation) -> None:
    commitlog.append(spark, _log(path), f"{g.path.rsplit('/', 1)[1]} {g.buckets} {g.given}")


def create_store(spark: SparkSession, path: str, buckets: int = FIRST_BUCKETS) -> None:
    """An empty store; changes nothing where there is one."""
    if not commitlog.exists(spark, _log(path)):
        _publish(spark, path, _start(spark, path, buckets, 0))


# -- writing ---------------------------------------------------------------------

def keyed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn(KEY, F.xxhash64("order_id")).withColumn(BUCKET, F.pmod(KEY, F.lit(buckets)).cast("int"))


def fingerprint():
    return F.shiftright(KEY, 32).cast("int")


def write_rows(rows: DataFrame, folder: str, by: list[str], mode: str = "overwrite") -> None:
    """Keyed rows, one sorted file per bucket (hashes spread the keys, so no bucket is hot)."""
    (rows.repartition(*by).sortWithinPartitions(*by, KEY).write.mode(mode).partitionBy(*by)
     .option("parquet.bloom.filter.enabled#order_id", "true").parquet(folder))


def records(rows: DataFrame, by: list[str], small: bool) -> DataFrame:
    """Commit records of written rows."""
    prints = F.sort_array(F.collect_set(fingerprint())) if small else F.lit(None).cast("array<int>")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low_id"), F.max("id").alias("high_id"), prints.alias("prints"))


def write_batch(spark: SparkSession, g: Generation, batch: str, rows: DataFrame, before_commit=None) -> int:
    """Write ``rows`` as a batch of the generation, over one of that name; its commit record comes last.  Number of rows."""
    folder = f"{g.rows}/{BATCH}={batch}"
    write_rows(keyed(rows, g.buckets), folder, [BUCKET])
    # an empty batch leaves no file that a schema could be read from
    written = spark.read.schema(T.StructType([f for f in ROWS_SCHEMA.fields if f.name != BATCH])).parquet(folder)
    n = written.count()  # from the files' footers
    if before_commit:
        before_commit()
    records(written, [BUCKET], n <= PRINTS * g.buckets).coalesce(1).write.mode("overwrite").parquet(f"{g.commits}/{BATCH}={batch}")
    return n


# -- reading ---------------------------------------------------------------------

def commits(spark: SparkSession, g: Generation, without: str | None = None) -> DataFrame:
    found = spark.read.schema(RECORD_SCHEMA).parquet(g.commits)
    return found if without is None else found.where(F.col(BATCH) != without)


def high_water(spark: SparkSession, g: Generation, without: str | None = None) -> int:
    """The highest id ever given (but for those of batch ``without``), from the records alone."""
    return max(g.given, commits(spark, g, without).agg(F.max("high_id")).first()[0] or 0)


def batches(spark: SparkSession, g: Generation) -> list[str]:
    """Committed batches; compaction bounds their number."""
    return [r[0] for r in commits(spark, g).select(BATCH).distinct().collect()]


def _live(spark: SparkSession, g: Generation, rows: DataFrame) -> DataFrame:
    gone = spark.read.schema(DELETED_SCHEMA).parquet(g.deleted).select("id")
    return rows.join(gone, "id", "left_anti").select(*rows.columns)


def read_store(spark: SparkSession, path: str, without: str | None = None, deleted: bool = False) -> DataFrame:
    """The stored orders (of all batches but ``without``), with the deleted ones if asked."""
    g = current(spark, path)
    names = [b for b in batches(spark, g) if b != without]
    rows = spark.read.schema(ROWS_SCHEMA).parquet(g.rows).where(F.col(BATCH).isin(names)).select(*intake.STORE_SCHEMA.names)
    return rows if deleted else _live(spark, g, rows)


def hit_folders(spark: SparkSession, g: Generation, keys: DataFrame, without: str | None = None) -> list[str]:
    """Folders of the batches and buckets that may hold one of the order ids ``keys``."""
    k = keyed(keys.select("order_id").where("order_id IS NOT NULL"), g.buckets).select(BUCKET, fingerprint().alias("print")).persist()
    per = {r[BUCKET]: r["count"] for r in k.groupBy(BUCKET).count().collect()}  # at most one row per bucket
    c = commits(spark, g, without).where(F.col(BUCKET).isin(list(per)))
    if max(per.values(), default=0) <= PRINTS:
        wanted = k.groupBy(BUCKET).agg(F.collect_set("print").alias("wanted"))
        c = c.join(wanted, BUCKET).where(F.col("prints").isNull() | F.arrays_overlap("prints", "wanted"))
    found = [f"{g.rows}/{BATCH}={r[0]}/{BUCKET}={r[1]}" for r in c.select(BATCH, BUCKET).distinct().collect()]
    k.unpersist()
    return found


def stored(spark: SparkSession, g: Generation, keys: DataFrame, without: str | None = None, deleted: bool = False) -> DataFrame:
    """Stored rows of the order ids ``keys``; only the folders they hit are read."""
    folders = hit_folders(spark, g, keys, without)
    if not folders:
        return intake.empty_store(spark)
    rows = spark.read.schema(ROWS_SCHEMA).option("basePath", g.rows).parquet(*folders)
    k = keyed(keys.select("order_id").distinct(), g.buckets)
    rows = rows.join(k, [BUCKET, KEY, "order_id"], "left_semi").select(*intake.STORE_SCHEMA.names)
    return rows if deleted else _live(spark, g, rows)


def find_orders(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "order_id") -> DataFrame:
    """Lookup of stored orders by id (upper-cased), as answered to a caller."""
    return intake.response(stored(spark, current(spark, path), keys.select(F.upper(key_col).alias("order_id"))))


def find_order(spark: SparkSession, path: str, order_id: str) -> DataFrame:
    """One order: the id itself is pushed down, so Bloom filters and sorted hashes skip row groups of its bucket."""
    g, wanted = current(spark, path), order_id.upper()
    folders = hit_folders(spark, g, spark.createDataFrame([(wanted,)], "order_id string"))
    if not folders:
        return intake.response(intake.empty_store(spark))
    rows = spark.read.schema(ROWS_SCHEMA).option("basePath", g.rows).parquet(*folders)
    h = spark.range(1).select(F.xxhash64(F.lit(wanted))).first()[0]
    return intake.response(_live(spark, g, rows.where((F.col(KEY) == h) & (F.col("order_id") == wanted))))


# -- deletes and compaction ------------------------------------------------------

def delete_stored(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "order_id") -> DataFrame:
    """Remove orders from the store by order id; (order_id, deleted) per requested id, 0 = not found.

    A generation published meanwhile may have missed the delete, which is then made there too."""
    k = keys.select(F.upper(key_col).alias("order_id")).distinct()
    name, g = str(uuid.uuid4()), current(spark, path)
    folder = f"{g.deleted}/{BATCH}={name}"
    stored(spark, g, k).select("id", "order_id").write.parquet(folder)
    first = folder
    while (now := current(spark, path)) != g:
        g = now
        gone = spark.read.schema("id long, order_id string").parquet(first)
        stored(spark, g, k).join(gone, ["id", "order_id"], "left_semi").select("id", "order_id").write.mode("overwrite").parquet(f"{g.deleted}/{BATCH}={name}")
    return intake.delete_report(k, spark.read.schema("id long, order_id string").parquet(first))


def replayable(names: list[str]) -> set[str]:
    """The last batch, ``query-epoch``, of every query."""
    last: dict[str, int] = {}
    for name in names:
        query, _, epoch = name.rpartition("-")
        if query and epoch.isdigit():
            last[query] = max(last.get(query, -1), int(epoch))
    return {f"{q}-{e}" for q, e in last.items()}


def _deletes(spark: SparkSession, g: Generation) -> list[str]:
    fs, p = commitlog.hadoop_path(spark, g.deleted)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def compact(spark: SparkSession, path: str, keep_generations: int = 2) -> Generation:
    """Merge batches and deletes into a new generation, publish it, and drop generations but the last ``keep_generations``.

    A delete that comes while the merge runs starts it again; one that comes later finds the new generation."""
    while True:
        g = current(spark, path)
        seen = _deletes(spark, g)
        names = batches(spark, g)
        kept = sorted(replayable(names))
        merged = [b for b in names if b not in kept]
        given = max(g.given, commits(spark, g).where(F.col(BATCH).isin(merged)).agg(F.max("high_id")).first()[0] or 0)
        rows = spark.read.schema(ROWS_SCHEMA).parquet(g.rows)
        total = commits(spark, g).agg(F.sum("n")).first()[0] or 0
        buckets = FIRST_BUCKETS
        while buckets < MOST_BUCKETS and buckets * ROWS_PER_BUCKET < total:
            buckets *= 2
        new = _start(spark, path, buckets, given)
        write_batch(spark, new, COMPACTED, _live(spark, g, rows.where(F.col(BATCH).isin(merged)).select(*intake.STORE_SCHEMA.names)))
        for b in kept:
            write_batch(spark, new, b, rows.where(F.col(BATCH) == b).select(*intake.STORE_SCHEMA.names))
        own = rows.where(F.col(BATCH).isin(kept)).select("id")
        (spark.read.schema(DELETED_SCHEMA).parquet(g.deleted).select("id", "order_id").join(own, "id", "left_semi")
         .write.parquet(f"{new.deleted}/{BATCH}={COMPACTED}"))
        if current(spark, path) == g and _deletes(spark, g) == seen:
            _publish(spark, path, new)
            break
        _drop(spark, new.path)
    drop_generations(spark, path, keep_generations)
    return new


def _drop(spark: SparkSession, folder: str) -> None:
    fs, p = commitlog.hadoop_path(spark, folder)
    fs.delete(p, True)


def drop_generations(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove published generations but the last ``keep``; readers of those go on."""
    names = [r.value.split(" ")[1] for r in spark.read.text(_log(path)).orderBy("value").collect()]  # one line per compaction
    for name in names[:-keep]:
        if commitlog.exists(spark, f"{path}/{name}"):
            _drop(spark, f"{path}/{name}")
