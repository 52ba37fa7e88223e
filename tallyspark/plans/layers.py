"""Versions of the published tables: folders, finished layers, manifests, the publish log.

A run writes the layers of one version into ``root/version``.  A layer is
finished when its marker ``_layers/<name>`` is there, which holds its schema
and rows per partition; a run that takes up an unpublished version reads
finished layers back and writes the others.  When all are there, a manifest
(``_manifest``, one JSON text) says for every table and partition which
version's folder holds it, so an unchanged partition is named and not copied;
an entry in the publish log then makes the version current.
"""

from __future__ import annotations

import datetime as _dt
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.plans import counters
from tallyspark.plans.counters import Counted
from tallyspark.sources import commitlog
from tallyspark.sources.store import in_sequence

PUBLISH_LOG = "_published"
AT_ONCE = 4              # layers written at the same time where none needs another

# table -> the column its folders are named by, if that is not a column of the table
HIDDEN = {"stg_orders": "year", "orders_quarantine": "year", "_flagged_orders": "year", "_watch": "year", "mart_monthly_summary": "year",
          "mart_customer_lifetime": "part", "mart_product_performance": "part", "_state_customer": "part", "_state_product": "part"}


# -- publish log -----------------------------------------------------------------

def published(spark: SparkSession, root: str) -> list[tuple[str, str | None]]:
    """(version, base) in order of publishing; one short line each."""
    if not commitlog.exists(spark, f"{root}/{PUBLISH_LOG}"):
        return []
    lines = sorted(r.value for r in spark.read.text(f"{root}/{PUBLISH_LOG}").collect())
    return [(w[1], w[2] if len(w) > 2 else None) for w in (line.split(" ") for line in lines)]


def current_version(spark: SparkSession, root: str) -> str:
    return commitlog.latest(spark, f"{root}/{PUBLISH_LOG}").split(" ")[0]


def load_chain(spark: SparkSession, root: str, version: str) -> list[str]:
    """The versions whose loads make up ``version``, oldest first."""
    base = dict(published(spark, root))
    if version not in base:
        raise ValueError(f"version {version} is not published in {root}")
    chain = []
    while version:
        chain.insert(0, version)
        version = base[version]
    return chain


# -- reading ---------------------------------------------------------------------

class Table:
    """Where the partitions of a table lie: ``parts`` of (version, folder, rows); the folder of a whole table is ''."""

    def __init__(self, spark: SparkSession, root: str, name: str, parts: list, schema: str):
        self.spark, self.root, self.name = spark, root, name
        self.parts = [tuple(p) for p in parts]
        self.schema = T.StructType.fromJson(json.loads(schema))
        self.json = schema

    @property
    def rows(self) -> int:
        return sum(n for _, _, n in self.parts)

    def where(self, folders) -> "Table":
        """Only some partitions; the others are not even listed."""
        return Table(self.spark, self.root, self.name, [p for p in self.parts if p[1] in set(folders)], self.json)

    def replaced(self, new: "Table") -> "Table":
        """This table with the partitions of ``new`` in the place of its own."""
        theirs = {f for _, f, _ in new.parts}
        return Table(self.spark, self.root, self.name, [p for p in self.parts if p[1] not in theirs] + new.parts, new.json)

    def followed(self, new: "Table") -> "Table":
        """This table and the rows of ``new`` after its own."""
        return Table(self.spark, self.root, self.name, self.parts + new.parts, self.json)

    def frames(self) -> list[DataFrame]:
        """One frame per version that holds partitions, in order of the parts."""
        owners: dict[str, list[str]] = {}
        for owner, folder, _ in self.parts:
            owners.setdefault(owner, []).append(folder)
        out = []
        for owner, folders in owners.items():
            path = f"{self.root}/{owner}/{self.name}"
            rows = self.spark.read.schema(self.schema).option("basePath", path).parquet(*[f"{path}/{f}".rstrip("/") for f in folders])
            out.append(rows.select(*self.schema.names))
        return out

    def read(self, hidden: bool = False) -> DataFrame:
        """All rows; with the folder column if ``hidden``."""
        frames = self.frames()
        if not frames:
            out = self.spark.createDataFrame([], self.schema)
        elif self.name.startswith("raw_"):
            out = in_sequence(frames) if len(frames) > 1 else frames[0]
        else:
            out = frames[0]
            for f in frames[1:]:
                out = out.unionByName(f)
        return out if hidden or self.name not in HIDDEN else out.drop(HIDDEN[self.name])


def manifest(spark: SparkSession, root: str, version: str) -> dict[str, Table]:
    tables = json.loads(commitlog.read_text(spark, f"{root}/{version}/_manifest"))
    return {name: Table(spark, root, name, t["parts"], t["schema"]) for name, t in tables.items()}


# -- writing ---------------------------------------------------------------------

def write(df: DataFrame, path: str, part: str | None) -> None:
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(part) if part else w).parquet(path)


class Run:
    """The writing of one version.  A published version is refused; an unpublished one is taken up, with the same arguments."""

    def __init__(self, spark: SparkSession, root: str, version: str, run_ts: _dt.datetime, base: str | None = None):
        if " " in version:
            raise ValueError("a version name has no blanks")
        known = dict(published(spark, root))
        if base and base not in known:
            raise ValueError(f"version {base} is not published in {root}")
        if version in known:
            raise FileExistsError(f"version {version} is published in {root}; a version is written once")
        self.spark, self.root, self.version, self.run_ts, self.base = spark, root, version, run_ts, base
        self.dir, self.done, self.seen = f"{root}/{version}", {}, {}
        given = json.dumps({"run_ts": run_ts.isoformat(), "base": base})
        begun = self._marker("_run")
        if begun is None:
            commitlog.write_text(spark, f"{self.dir}/_layers/_run", given)
        elif begun != given:
            raise ValueError(f"version {version} was begun with {begun}, not {given}")

    def _marker(self, name: str) -> str | None:
        path = f"{self.dir}/_layers/{name}"
        return commitlog.read_text(self.spark, path) if commitlog.exists(self.spark, path) else None

    def layer(self, name: str, df: DataFrame, part: str | None = None, seen: dict[str, Counted] | None = None) -> Table:
        """Write ``df`` unless it has been, and say where it lies.  A written layer is a lineage cut.  ``seen`` are counters its plan observes."""
        marker = self._marker(name)
        if marker is None:
            path = f"{self.dir}/{name}"
            write(df, path, part)
            rows = self.spark.read.schema(df.schema).parquet(path)  # counted from the files' footers
            if part:
                parts = sorted((self.version, f"{part}={r[0]}", r[1]) for r in rows.groupBy(part).count().collect())
            else:
                parts = [(self.version, "", rows.count())]
            values = {k: c.values(sum(p[2] for p in parts)) for k, c in (seen or {}).items()}
            marker = json.dumps({"parts": parts, "schema": df.schema.json(), "seen": values})
            commitlog.write_text(self.spark, f"{self.dir}/_layers/{name}", marker)
        t = json.loads(marker)
        self.done[name] = Table(self.spark, self.root, name, t["parts"], t["schema"])
        self.seen |= t.get("seen", {})
        return self.done[name]

    def together(self, *layers: tuple) -> list[Table]:
        """Layers that do not need each other, several at once."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return list(pool.map(lambda a: self.layer(*a), layers))

    def publish(self, tables: dict[str, Table], counts: dict[str, int], quality: list[tuple]) -> None:
        log = [(k, int(v)) for k, v in counts.items()]
        (self.spark.createDataFrame(log, "table_name string, rows long").withColumn("run_ts", F.lit(self.run_ts))
         .withColumn("version", F.lit(self.version)).coalesce(1).write.mode("overwrite").parquet(f"{self.dir}/_run_log"))
        self.spark.createDataFrame(quality, counters.SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.dir}/{counters.FOLDER}")
        commitlog.write_text(self.spark, f"{self.dir}/_manifest", json.dumps({n: {"parts": t.parts, "schema": t.json} for n, t in tables.items()}))
        commitlog.append(self.spark, f"{self.root}/{PUBLISH_LOG}", f"{self.version} {self.base or ''}".rstrip())
