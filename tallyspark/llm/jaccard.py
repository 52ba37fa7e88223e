"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its word shingles.  Sets are ordered from rare to
frequent tokens.  Two sets that reach the threshold share their first common
token inside both prefixes, and their first two common tokens inside prefixes
one longer.  So a rare first common token is found under that token alone; when
it is frequent (above ``frequent`` documents), so is the second, and the pair
is found under the combination of both.  Every candidate is verified on the
whole sets.

Counts, prefixes, candidates and verification are passes over texts dealt once
by document id (see ``anchors``); between them travel arrays of hashes.  Equal
sets are one class, of which the smallest id takes part.  A list of up to
``SMALL`` documents is verified pair by pair; a longer one first against a
leader.  Long lists whose documents are then still in different components
are joined once more: lists that share documents form clusters, their sets
meet in blocks, and overlaps are counted from postings.  So groups of copies
are not expanded into all pairs, and no link between components is lost.

Edge cases: NULL and empty texts have no set and link with nothing; with fewer
words than a shingle the whole sequence is the one shingle; rows with a NULL
id are left out, as nothing can name them; repeated rows are one node (an
id stands for one text); empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm.anchors import WIRE, Powers, Repeats, Sums, Words, as_table, dealt, gathered, inside, mixed, row
from tallyspark.llm.common import cut, table, text_bytes
from tallyspark.llm.components import components

SHINGLE = 5
PERCENT = 75
FREQUENT = 4096
SMALL = 8
BLOCK = 2048  # documents of a cluster that meet in one task
COUNT, CLASS, MEMBER, ENTRY, ASK, SHIP, WANT, SET, LIST, LINK = range(10)


def shingles(body: bytes, tokens: Words, powers: Powers, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text whose A-Z are lower-cased."""
    words, _ = tokens([body.lower()])  # bytes.lower() changes A-Z alone
    if not len(words):
        return words
    sums = Sums(words, powers)
    return np.unique(mixed((sums.grams(width) if len(words) >= width else sums.of(np.array([0]), np.array([len(words)]))) + np.uint64(len(words) < width)))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class JaccardJoin:
    def __init__(self, parts: int, buckets: int, percent: int = PERCENT, frequent: int = FREQUENT, small: int = SMALL, width: int = SHINGLE):
        self.parts, self.buckets, self.percent, self.frequent, self.small, self.width = parts, buckets, percent, frequent, small, width

    def sets(self, table: pa.Table, only: set | None = None):
        tokens, powers = Words(), Powers()
        for doc, body in zip(table["doc_id"].to_pylist(), table["body"].to_pylist(), strict=True):
            if only is None or doc in only:
                yield doc, shingles(body, tokens, powers, self.width)

    def counts_out(self, table: pa.Table) -> pa.Table:
        """Pass 1: how many documents of the part hold each token, and a digest of each set."""
        part = table["part"][0].as_py()
        docs, sizes, digests, sets = [], [], [], []
        for doc, s in self.sets(table):
            docs.append(doc)
            sizes.append(len(s))
            with np.errstate(over="ignore"):
                digests.append(mixed(np.array([mixed(s * np.uint64(3)).sum(dtype=np.uint64) + np.uint64(len(s)), s.sum(dtype=np.uint64)], np.uint64)))
            sets.append(s)
        tokens, n = np.unique(np.concatenate(sets), return_counts=True)
        digest = np.array(digests, np.uint64)
        return as_table(dealt(part, COUNT, self.buckets, tokens, (tokens >> np.uint64(32)).astype(np.uint32), n.astype(np.uint32))
                        + dealt(part, CLASS, self.buckets, digest[:, 0], digest[:, 0], digest[:, 1], np.array(docs, np.int64), np.array(sizes, np.int64)))

    def counts_in(self, table: pa.Table) -> pa.Table:
        """To each part: counts of its tokens that two documents hold, and the smallest document of each set."""
        bucket = table["bucket"][0].as_py()
        kind = table["kind"].to_numpy()
        out = []
        counts = table.filter(pa.array(kind == COUNT))
        if counts.num_rows:
            parts, edges, (keys, n) = gathered(counts, np.uint32, np.uint32)
            seen, at = np.unique(keys, return_inverse=True)
            total = np.bincount(at, n, len(seen)).astype(np.uint32)[at]
            for i, part in enumerate(parts):
                s = slice(edges[i], edges[i + 1])
                t = total[s] > 1
                if t.any():
                    out.append(row(part, bucket, COUNT, keys[s][t], total[s][t]))
        classes = table.filter(pa.array(kind == CLASS))
        if classes.num_rows:
            parts, edges, (one, two, docs, sizes) = gathered(classes, np.uint64, np.uint64, np.int64, np.int64)
            order = np.lexsort((docs, sizes, two, one))
            new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])))
            first = np.empty(len(docs), np.int64)
            first[order] = docs[order][new][np.cumsum(new) - 1]
            first = np.where(sizes > 0, first, docs)
            for i, part in enumerate(parts):
                s = slice(edges[i], edges[i + 1])
                out.append(row(part, bucket, MEMBER, docs[s], sizes[s], first[s]))
        return as_table(out)

    def prefixes_out(self, table: pa.Table, replies: pa.Table) -> pa.Table:
        """Pass 2: rare tokens of each prefix alone, frequent ones in pairs."""
        part = Repeats.part_of(table, replies)
        out, known, counts, firsts = [], [], [], set()
        for r in replies.select(["bucket", "kind", "x", "y", "z"]).to_pylist():
            if r["kind"] == COUNT:
                known.append((np.frombuffer(r["x"], np.uint32).astype(np.uint64) << np.uint64(32)) | np.uint64(r["bucket"]))
                counts.append(np.frombuffer(r["y"], np.uint32))
            else:
                docs, _, first = (np.frombuffer(r[c], np.int64) for c in "xyz")
                firsts.update(docs[docs == first].tolist())
                out.append(row(part, r["bucket"], MEMBER, r["x"], r["y"], r["z"]))  # goes through to the result
        known = np.concatenate(known) if known else np.zeros(0, np.uint64)
        counts = np.concatenate(counts) if counts else np.zeros(0, np.uint32)
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        keys, docs, sizes = [], [], []
        for doc, s in self.sets(table, firsts):
            n = len(s)
            if not n:
                continue
            at = inside((s & np.uint64(0xFFFFFFFF00000000)) | ((s & np.uint64(0xFFFFFFFF)) % np.uint64(self.buckets)), known)
            count = np.where(at >= 0, counts[at], 1) if len(known) else np.ones(n, np.uint32)
            length = n - -(-self.percent * n // 100) + 1
            if (count < 2).sum() > length:
                continue  # nothing but tokens of its own
            line = np.lexsort((s, count))[:length + 1]
            c, t = count[line], s[line]
            found = [t[:length][(c[:length] > 1) & (c[:length] <= self.frequent)]]
            often = t[c > self.frequent]
            if len(often) > 1:
                i, j = np.triu_indices(len(often), 1)
                found.append(mixed(often[i] * np.uint64(3) + often[j]))
            found = np.concatenate(found)
            keys.append(found)
            docs.append(np.full(len(found), doc, np.int64))
            sizes.append(np.full(len(found), n, np.int32))
        if keys:
            keys = np.concatenate(keys)
            out += dealt(part, ENTRY, self.buckets, keys, keys, np.concatenate(docs), np.concatenate(sizes))
        return as_table(out)

    def fits(self, small, large):
        return 100 * small >= self.percent * large

    def lists_in(self, table: pa.Table) -> pa.Table:
        """Candidates of each list: all pairs of a short one, leader and members of a long one."""
        bucket = table["bucket"][0].as_py()
        kind = table["kind"].to_numpy()
        out = [row(r["part"], bucket, MEMBER, r["x"], r["y"], r["z"]) for r in table.filter(pa.array(kind == MEMBER)).to_pylist()]
        entries = table.filter(pa.array(kind == ENTRY))
        if not entries.num_rows:
            return as_table(out)
        parts, edges, (keys, docs, sizes) = gathered(entries, np.uint64, np.int64, np.int32)
        home = np.repeat(np.array(parts, np.int32), np.diff(edges))
        order = np.lexsort((docs, sizes, keys))
        keys, docs, sizes, home = keys[order], docs[order], sizes[order], home[order]
        cut_at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        pairs, long, lists = set(), {}, {}
        for lo, hi in zip(cut_at[:-1], cut_at[1:], strict=True):
            if hi - lo < 2:
                continue
            if hi - lo <= self.small:
                for i in range(lo, hi):
                    for j in range(i + 1, hi):
                        if docs[i] != docs[j] and self.fits(int(sizes[i]), int(sizes[j])):
                            pairs.add((int(home[i]), int(docs[i]), int(home[j]), int(docs[j])))
                continue
            lists.setdefault(docs[lo:hi].tobytes(), (docs[lo:hi], sizes[lo:hi]))
            i = lo
            while i < hi:
                stop = lo + int(np.searchsorted(sizes[lo:hi] * self.percent, 100 * int(sizes[i]), side="right"))
                pairs.update((int(home[i]), int(docs[i]), int(home[j]), int(docs[j])) for j in range(i + 1, stop) if docs[j] != docs[i])
                i = max(stop, i + 1)
            long.update(zip(docs[lo:hi].tolist(), home[lo:hi].tolist(), strict=True))
        if pairs:
            p = np.array(sorted(pairs), np.int64)
            for part in np.unique(p[:, 0]):
                q = p[p[:, 0] == part]
                out.append(row(int(part), bucket, ASK, q[:, 1], q[:, 2].astype(np.int32), q[:, 3]))
        if long:
            want = np.array(sorted((h, d) for d, h in long.items()), np.int64)
            for part in np.unique(want[:, 0]):
                out.append(row(int(part), bucket, WANT, want[want[:, 0] == part][:, 1]))
        for d, n in lists.values():
            out.append(row(int(home[0]), bucket, LIST, d, n.astype(np.int32)))
        return as_table(out)

    def ship(self, table: pa.Table, asked: pa.Table) -> pa.Table:
        """Pass 3: the set of each asked document to the parts of its partners."""
        part = Repeats.part_of(table, asked)
        out, pairs, want = [], set(), set()
        for r in asked.select(["bucket", "kind", "x", "y", "z"]).to_pylist():
            if r["kind"] == ASK:
                pairs.update(zip(np.frombuffer(r["x"], np.int64).tolist(), np.frombuffer(r["y"], np.int32).tolist(), np.frombuffer(r["z"], np.int64).tolist(), strict=True))
            elif r["kind"] == WANT:
                want.update(np.frombuffer(r["x"], np.int64).tolist())
            else:
                out.append(row(part, r["bucket"], r["kind"], r["x"], r["y"], r["z"]))
        if not table.num_rows or not (pairs or want):
            return as_table(out)
        to = {}
        for a, home, b in pairs:
            to.setdefault(a, {}).setdefault(home, []).append(b)
        for doc, s in self.sets(table, to.keys() | want):
            for home, partners in to.pop(doc, {}).items():
                out.append(row(home, 0, SHIP, np.array([doc], np.int64), s, np.array(partners, np.int64)))
            if doc in want:
                want.discard(doc)
                out.append(row(part, 0, SET, np.array([doc], np.int64), s))
        return as_table(out)

    def verify(self, table: pa.Table, shipped: pa.Table) -> pa.Table:
        """Pass 4: the sets that came against those of the part."""
        part = Repeats.part_of(table, shipped)
        out, jobs = [], {}
        for r in shipped.select(["bucket", "kind", "x", "y", "z"]).to_pylist():
            if r["kind"] == SHIP:
                a, s = int(np.frombuffer(r["x"], np.int64)[0]), np.frombuffer(r["y"], np.uint64)
                for b in np.frombuffer(r["z"], np.int64).tolist():
                    jobs.setdefault(b, []).append((a, s))
            else:
                out.append(row(part, r["bucket"], r["kind"], r["x"], r["y"], r["z"]))
        links = []
        for doc, s in self.sets(table, jobs.keys()):
            links += [(a, doc) for a, other in jobs.pop(doc, ()) if similar(other, s, self.percent)]
        if links:
            links = np.array(links, np.int64)
            out.append(row(part, 0, LINK, links[:, 0], links[:, 1]))
        return as_table(out)

    # What is left: documents of one cluster of long lists that are in different components -----------

    def across(self, table: pa.Table) -> pa.Table:
        """Links between components among the documents of one pair of blocks; overlaps are counted from postings, pairs are never listed."""
        docs, comps, sides = (table[c].to_numpy() for c in ("doc", "component", "side"))
        sets = [np.frombuffer(b, np.uint64) for b in table["body"].to_pylist()]
        size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), size)
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(token, kind="stable")
        posting, first = owner[order], np.searchsorted(token[order], np.arange(token.max() + 2))
        two_sided = len(np.unique(sides)) > 1
        _, root = np.unique(comps, return_inverse=True)
        a, b = [], []
        edge = np.concatenate(([0], np.cumsum(size)))
        for i in range(len(sets)):
            if two_sided and sides[i]:
                continue
            mine = token[edge[i]:edge[i + 1]]
            both = np.bincount(np.concatenate([posting[first[t]:first[t + 1]] for t in mine]), minlength=len(sets))
            hit = (100 * both >= self.percent * (size[i] + size - both)) & (root != root[i])
            if two_sided:
                hit &= sides > 0
            for j in np.flatnonzero(hit):
                if root[j] != root[i]:
                    a.append(docs[i])
                    b.append(docs[j])
                    root[root == root[j]] = root[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def opened(kind: int, names: tuple[str, ...], types: tuple):
    """Rows of one kind with their arrays laid out, for mapInArrow."""
    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                columns = [np.frombuffer(r[c], k) for c, k in zip("xyz", types, strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], list(names))
    return lambda df: df.where(F.col("kind") == kind).mapInArrow(read, ", ".join(f"{n} long" for n in names))


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, frequent: int = FREQUENT, small: int = SMALL,
                 part_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, links): doc_id, n_shingles, class_id, component_id per distinct document, and the verified links (a, b) that make the components."""
    total = text_bytes(docs, text)
    size = part_bytes or min(64 << 20, max(2 << 20, int(total**0.5) * 128))
    join = JaccardJoin(max(1, total // size), max(1, total // (4 * size)), percent, frequent, small)
    base = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    by_part = base.select(F.pmod(F.xxhash64("doc_id"), F.lit(join.parts)).cast("int").alias("part"), "doc_id", "body").groupBy("part")
    r1 = by_part.applyInArrow(lambda t: join.counts_out(t), WIRE).groupBy("bucket").applyInArrow(lambda t: join.counts_in(t), WIRE)
    r2 = by_part.cogroup(r1.groupBy("part")).applyInArrow(lambda t, r: join.prefixes_out(t, r), WIRE).groupBy("bucket").applyInArrow(lambda t: join.lists_in(t), WIRE)
    r3 = by_part.cogroup(r2.groupBy("part")).applyInArrow(lambda t, r: join.ship(t, r), WIRE)
    found = cut(by_part.cogroup(r3.groupBy("part")).applyInArrow(lambda t, r: join.verify(t, r), WIRE))
    members = opened(MEMBER, ("doc", "size", "class"), (np.int64,) * 3)(found).distinct()
    links = cut(opened(LINK, ("a", "b"), (np.int64,) * 2)(found).distinct())
    joined = components(links)

    # long lists once more, now that most of their documents share a component
    lists = found.where(F.col("kind") == LIST).select(F.xxhash64("x").alias("list"), "kind", "x", "y").dropDuplicates(["list"])
    def spelled(batches):
        for batch in batches:
            for r in batch.to_pylist():
                d, n = np.frombuffer(r["x"], np.int64), np.frombuffer(r["y"], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), r["list"], np.int64)), pa.array(d), pa.array(n.astype(np.int64))], ["list", "doc", "size"])
    entries = lists.mapInArrow(spelled, "list long, doc long, size long")
    entries = entries.join(joined.select(F.col("node").alias("doc"), "component"), "doc", "left").select("list", "doc", "size", F.coalesce("component", "doc").alias("component"))
    divided = entries.groupBy("list").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("doc").alias("head")).where("lo <> hi").select("list", "head")
    spokes = cut(entries.join(divided, "list").select("head", "doc", "component"))
    if spokes.head(1):
        # lists that share documents form a cluster; its documents are dealt into blocks, and every two blocks meet once
        cluster = components(spokes.where("head <> doc").select(F.col("head").alias("a"), F.col("doc").alias("b")))
        held = spokes.select("doc", "component").distinct().join(cluster.select(F.col("node").alias("doc"), F.col("component").alias("cluster")), "doc")
        blocks = held.groupBy("cluster").agg((F.floor(F.count(F.lit(1)) / BLOCK) + 1).cast("int").alias("blocks"))
        held = held.join(blocks, "cluster").withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        def read_sets(batches):
            for batch in batches:
                ids = [int(np.frombuffer(x, np.int64)[0]) for x in batch["x"].to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), batch["y"]], ["doc", "body"])
        sets = found.where(F.col("kind") == SET).select("x", "y").mapInArrow(read_sets, "doc long, body binary").dropDuplicates(["doc"])
        meet = held.join(sets, "doc").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        meet = meet.select("cluster", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "doc", "component", "body")
        more = meet.groupBy("cluster", "i", "j").applyInArrow(lambda t: join.across(t), "a long, b long")
        links = cut(links.unionAll(more))
        joined = components(links)
    named = members.join(joined.select(F.col("node").alias("class"), "component"), "class", "left")
    return named.select(F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("class").alias("class_id"), F.coalesce("component", "class").alias("component_id")), links


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))[0].select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i+4], chr(32))) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, 'whole ' || md5(array_to_string(w, chr(32))) FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
r AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(c) FROM r WHERE r.a = d.doc_id)::BIGINT AS component_id FROM d LEFT JOIN n USING (doc_id)
"""
