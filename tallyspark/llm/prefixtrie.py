"""Conversation prefix trie by whole-sequence collapse.

Rebuilt conversations that are equal as a whole become one weighted sequence
with the list of conversations that end there.  Sequences that are a proper
prefix of another one are dropped by an anti-join; the others are the leaves.
Only distinct sequences are laid out turn by turn, and prefixes are aggregated
by weight.

A turn travels as the SHA-256 of its role and text; texts never leave the scan.
A prefix is named by its depth and four sums, modulo 2^40, of hashes of
(place, turn digest).  Sums need no order, so the turns of one long
conversation are spread over many tasks: places come from a range sort with
offsets per partition, and running sums are taken in blocks of ``BLOCK`` turns
with offsets per block.

Subtree sums use owners: the smallest member of a node owns it, and the nodes
that a sequence owns are the lower end of its path.  Every sequence carries
what it owns from a depth downwards, so a node's subtree is one aggregate over
the sequences through it; no pairs of nodes and ancestors are listed.

SHA-256 of an end list is sequential, so the ids of equal conversations (8
bytes each, sorted by Spark, spilling) stream through one task; nothing of a
group is held in memory.

Edge cases: rows without a conv_id are left out; NULL turns come first, NULL
role or text is empty; rows with the same turn are ordered by their digest,
and repeated rows are turns of their own; conversations
left without turns are members of the root; an empty table gives an empty
result, without a root; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyspark.llm.common import cut, table

FAMILY = 20              # conversations that share a head
HEADS = 4                # a head has 0 to HEADS - 1 turns
BLOCK = 4096             # turns of one conversation summed at once
SUMS = 4
MASK = (1 << 40) - 1
NOTHING = hashlib.sha256(b"").hexdigest()
GAP = np.zeros(256, bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True


def count_words(text: pa.Array) -> np.ndarray:
    """Words of every text of an Arrow array without NULLs."""
    text = text.cast(pa.large_string())
    if not len(text):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)[ends[0]:ends[-1]] if text.buffers()[2] and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    word = ~GAP[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    held = ends[:-1] < ends[1:]
    starts = ends[:-1][held]
    first[starts] = word[starts]
    out = np.zeros(len(text), np.int64)
    if len(starts):
        out[held] = np.add.reduceat(first, starts, dtype=np.int64)
    return out


def digested(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, digest of role and text, words of the text."""
    def run(batches):
        for batch in batches:
            digest = [hashlib.sha256(f"{r}\n{t}".encode("utf-8", "surrogatepass")).digest() for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), pa.array(digest, pa.binary()), pa.array(count_words(batch.column("text")), pa.int64())],
                                             ["conv_id", "turn", "digest", "words"])

    # the length of the role keeps (role, text) apart from other cuts of the same characters
    role = F.coalesce(F.col(role), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.concat(F.char_length(role).cast("string"), F.lit(":"), role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, digest binary, words long")


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, i, digest, words) of every rebuilt turn, i from 1, and the ids of all conversations."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = cut(cut(turns).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    # one row per conversation and partition it lies in
    spans = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    line = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(line), F.lit(0)) - F.col("first") + 1)
    convs = spans.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("h", head_length(F.col("conv_id")))
    bases = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = (convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
             .select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")))
    spans = spans.join(convs, "conv_id").select("conv_id", "part", "before", "h", "taken")
    turns = placed.join(spans, ["conv_id", "part"]).withColumn("pos", F.col("at") + F.col("before"))
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).select(F.col("conv_id").alias("base"), F.col("pos").alias("i"), "digest", "words")
    lent = convs.where("taken > 0").join(heads, "base").where("i <= taken").select("conv_id", "i", "digest", "words")
    own = turns.where("pos > h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("i"), "digest", "words")
    return own.unionByName(lent), convs.select("conv_id")


def term(k: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(k), "i", "digest"), 24)


def path(*sums: Column) -> Column:
    return F.struct(*[s.bitwiseAND(F.lit(MASK)).alias(f"s{k}") for k, s in enumerate(sums)])


def collapse(ends: DataFrame) -> DataFrame:
    """rep (smallest id), length, path, weight and ends_sha256 of every distinct sequence of (conv_id, length, path)."""
    keys = ["length", *[f"s{k}" for k in range(SUMS)]]
    schema = "rep long, weight long, ends_sha256 string, " + ", ".join(f"{k} long" for k in keys)
    flat = ends.select("conv_id", "length", "path.*").repartition(*keys).sortWithinPartitions(*keys, "conv_id")

    def run(batches):
        key, rep, weight, digest, out = None, 0, 0, None, []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.string()] + [pa.int64()] * len(keys))],
                                                   ["rep", "weight", "ends_sha256", *keys])
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_pylist()
            table = np.stack([batch.column(k).to_numpy() for k in keys], 1)
            starts = [0, *(np.flatnonzero((table[1:] != table[:-1]).any(1)) + 1).tolist()]
            for a, b in zip(starts, [*starts[1:], len(ids)]):
                new = tuple(table[a].tolist())
                joined = ",".join(map(str, ids[a:b])).encode()
                if new == key:
                    digest.update(b"," + joined)
                    weight += b - a
                    continue
                if key is not None:
                    out.append((rep, weight, digest.hexdigest(), *key))
                key, rep, weight, digest = new, ids[a], b - a, hashlib.sha256(joined)
            if len(out) > 10_000:
                yield flush()
                out = []
        if key is not None:
            out.append((rep, weight, digest.hexdigest(), *key))
            yield flush()

    return flat.mapInArrow(run, schema).select("rep", "weight", "ends_sha256", "length", path(*[F.col(f"s{k}") for k in range(SUMS)]).alias("path"))


def running(rows: DataFrame, key: str, at: str, values: list[str], mask: int = -1) -> DataFrame:
    """Sums of ``values`` over the rows of ``key`` up to and with ``at``, as ``sum_<value>``; block sums are cut to ``mask``.
    No window holds more than BLOCK rows of a key, or one row per block."""
    block = F.floor(F.col(at) / BLOCK).alias("block")
    inside = Window.partitionBy(key, "block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    line = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(key, block).agg(*[F.sum(v).bitwiseAND(F.lit(mask).cast("long")).alias(f"all_{v}") for v in values])
    blocks = blocks.select(key, "block", *[F.coalesce(F.sum(f"all_{v}").over(line), F.lit(0)).alias(f"off_{v}") for v in values])
    local = rows.select("*", block).select("*", *[F.sum(v).over(inside).alias(f"in_{v}") for v in values])
    return local.join(blocks, [key, "block"]).select(*rows.columns, *[(F.col(f"in_{v}") + F.col(f"off_{v}")).alias(f"sum_{v}") for v in values])


def laid_out(turns: DataFrame, sequences: DataFrame) -> DataFrame:
    """(rep, i, path, above, words, weight, length) of every prefix of the distinct sequences; i = 0 is the root."""
    terms = [f"t{k}" for k in range(SUMS)]
    # a long sequence meets its turns block by block
    wanted = sequences.select(F.col("rep").alias("conv_id"), "weight", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / BLOCK))).alias("b"))
    rows = turns.withColumn("b", F.floor(F.col("i") / BLOCK)).join(wanted, ["conv_id", "b"])
    rows = rows.select(F.col("conv_id").alias("rep"), "i", "words", "weight", "length", *[term(k).alias(t) for k, t in enumerate(terms)])
    rows = running(rows, "rep", "i", terms, MASK)
    rows = rows.select("rep", "i", "words", "weight", "length", path(*[F.col(f"sum_{t}") for t in terms]).alias("path"), path(*[F.col(f"sum_{t}") - F.col(t) for t in terms]).alias("above"))
    zero = F.lit(0).cast("long")
    nil = path(*[zero] * SUMS)
    return rows.unionByName(sequences.select("rep", zero.alias("i"), zero.alias("words"), "weight", "length", nil.alias("path"), nil.alias("above")))


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    turns, convs = rebuilt(digested(turns, conv_id, turn, role, text))
    turns = cut(turns)
    # whole sequences: sums of all turns of a conversation, by block so that none overflows
    names = [f"s{k}" for k in range(SUMS)]
    whole = turns.groupBy("conv_id", F.floor(F.col("i") / BLOCK).alias("b")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(term(k)).bitwiseAND(F.lit(MASK)).alias(s) for k, s in enumerate(names)])
    whole = whole.groupBy("conv_id").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])
    ends = convs.join(whole, "conv_id", "left").select("conv_id", zero("n").alias("length"), path(*[zero(s) for s in names]).alias("path"))
    sequences = cut(collapse(ends))

    rows = cut(laid_out(turns, sequences))
    proper = rows.where("i < length").select(F.col("i").alias("length"), "path").distinct()
    leaves = sequences.join(proper, ["length", "path"], "left_anti").select("rep", F.col("length").alias("i"), F.lit(1).cast("long").alias("leaf"))
    nodes = cut(rows.groupBy("i", "path").agg(F.sum("weight").alias("n_convs"), F.min("rep").alias("owner"), F.max("words").alias("words"), F.first("above").alias("above")))

    # a sequence carries what it owns from the bottom of its path upwards
    owned = nodes.select(F.col("owner").alias("rep"), "i", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    held = rows.select("rep", "i", "path", (F.col("length") - F.col("i")).alias("up")).join(owned, ["rep", "i"], "left").join(leaves, ["rep", "i"], "left")
    held = running(held.select("rep", "i", "up", "path", zero("saved").alias("saved"), zero("leaf").alias("leaf")), "rep", "up", ["saved", "leaf"])
    below = held.groupBy("i", "path").agg(F.sum("sum_saved").alias("saved_tokens"), F.sum("sum_leaf").alias("n_leaves"))

    children = nodes.where("i > 0").groupBy((F.col("i") - 1).alias("i"), F.col("above").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    # every first turn hangs on the root: its owner is one value; other hot parents are split by AQE's skew join
    parents = nodes.where("i > 0").select((F.col("i") + 1).alias("i"), F.col("path").alias("above"), F.col("owner").alias("parent"))
    root = nodes.where("i = 0").select("owner").scalar()
    ended = sequences.select(F.col("length").alias("i"), "path", "ends_sha256")
    out = nodes.join(below, ["i", "path"]).join(children, ["i", "path"], "left").join(ended, ["i", "path"], "left").join(parents, ["i", "above"], "left")
    return out.select(F.col("owner").alias("conv_id"), F.col("i").alias("depth"), F.when(F.col("i") == 1, root).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs",
                      zero("n_children").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT k, CASE WHEN k % 2 = 1 THEN xor(k // 2, 3988292384) ELSE k // 2 END AS v FROM (SELECT unnest(range(256))::BIGINT AS k)),
s2 AS (SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM bits), s3 AS (SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM s2),
s4 AS (SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM s3), s5 AS (SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM s4),
s6 AS (SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM s5), s7 AS (SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM s6),
s8 AS (SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM s7),
crc AS (SELECT list(v ORDER BY k) AS t FROM s8),
convs AS (SELECT DISTINCT conv_id FROM turns),
hashed AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: xor(a // 256, t[1 + (xor(a, b) & 255)])), 4294967295) % 4 AS h FROM convs, crc),
rebuilt AS (SELECT h.conv_id, h, pos AS i, role, text FROM hashed h JOIN turns b ON b.conv_id = h.conv_id - h.conv_id % 20 AND b.pos <= h.h
  UNION ALL SELECT h.conv_id, h, 1000000000 + pos, role, text FROM hashed h JOIN turns o ON o.conv_id = h.conv_id AND o.pos > h.h),
whole AS (SELECT c.conv_id, coalesce(list({'r': role, 't': text} ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS seq FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, unnest(range(len(seq) + 1)) AS depth, seq FROM whole),
keyed AS (SELECT conv_id, depth, seq[1:depth] AS p, depth = len(seq) AS ends FROM prefixes),
nodes AS (SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(any_value(p[depth].t), '[^ 	-
]+')) END AS words FROM keyed GROUP BY p, depth),
kids AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
up AS (SELECT a.p[1:k] AS p, k AS depth, sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (WHERE kids.depth IS NULL) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM nodes) a LEFT JOIN kids ON kids.p = a.p AND kids.depth = a.depth GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN up ON up.p = n.p AND up.depth = n.depth LEFT JOIN kids ON kids.p = n.p AND kids.depth = n.depth
LEFT JOIN nodes m ON m.p = n.p[1:n.depth - 1] AND m.depth = n.depth - 1
"""
