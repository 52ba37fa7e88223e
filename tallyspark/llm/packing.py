"""Packing of documents into training sequences by vector best-fit.

A document becomes the ids of its text and one end id; only documents longer
than a sequence are cut, into pieces of a whole sequence and a rest.  A piece
needs three things of its sequence: tokens, one document, and attention cost
(the square of its length).  Pieces are dealt to shards by a hash of their
place in the input and each shard takes them longest first; the sequence is
chosen among those in which every need fits, by the smallest weighted norm of what
would stay free (``rule="norm"``) or the largest weighted dot-product of need
and free capacity (``rule="dot"``), and a new one is begun where none fits.

Texts are tokenised in one pass over the scan and are never shuffled; shards
hold about ``SHARD_TOKENS`` tokens and ``SHARD_PIECES`` pieces whatever the
input, so that what stays open at the end of a shard is about one
sequence in thousands.

Tokenising works by words between blanks, which the vocabulary's splitting never
crosses; each worker keeps the ids of up to about ``SEEN`` words.

Edge cases: a NULL or empty text is one piece with the end id alone; a NULL id
is kept; repeated rows are packed each on its own; a text of one run without blanks is
tokenised at once; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyspark.llm.common import cut, table

LENGTH = 2048
END_ID = 0
SHARD_TOKENS, SHARD_PIECES = 16_000_000, 65_536
SEEN = 1 << 20           # words whose ids a worker keeps
TOGETHER = 500           # unseen words encoded at once
SLICE = 1 << 22          # bytes of text taken at once; a longer text is taken alone
TAIL = re.compile(r"[.,]+\Z")
SIMPLE = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")


class Words:
    """Ids of words between ASCII blanks, as little-endian unsigned 32-bit numbers.

    Splitting never crosses a blank, so a text's ids are those of its words.  A word of plain lower-case letters is one
    unit that normalising leaves as it is; such words skip normalising and splitting.  Others are encoded in full,
    with a special token between them."""

    def __init__(self, vocabulary: str, separator: str = "<|endoftext|>"):
        from tokenizers import Tokenizer

        parts = json.loads(vocabulary)
        self.full, self.separator, self.seen = Tokenizer.from_str(vocabulary), separator, {"": b""}
        self.separator_id = self.full.token_to_id(separator)
        level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.plain = Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, level]}}))
        self.last = np.zeros(max(parts["model"]["vocab"].values()) + 1, bool)
        suffix = parts["model"]["end_of_word_suffix"]
        self.last[[i for token, i in parts["model"]["vocab"].items() if token.endswith(suffix)]] = True

    def ids(self, tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def store(self, words: list[str], ids: np.ndarray, starts: list[int], ends: list[int]) -> None:
        data = ids.tobytes()
        for w, a, b in zip(words, starts, ends, strict=True):
            self.seen[w] = data[4 * a:4 * b]

    def learn(self, words) -> None:
        simple, other = [], []
        for w in words:
            if SIMPLE.fullmatch(w):
                simple.append(w)
            elif "<|" in w:
                self.seen[w] = self.ids(self.full, w).tobytes()
            else:
                other.append(w)
        for at in range(0, len(simple), TOGETHER):
            part = simple[at:at + TOGETHER]
            ids = self.ids(self.plain, " ".join(part))
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            self.store(part, ids, [0, *ends[:-1]], ends)
        for at in range(0, len(other), TOGETHER):
            part = other[at:at + TOGETHER]
            ids = self.ids(self.full, self.separator.join(part))
            ends = np.flatnonzero(ids == self.separator_id).tolist()
            self.store(part, ids, [0, *[e + 1 for e in ends]], [*ends, len(ids)])

    def meet(self, words: list[str]) -> list[bytes]:
        """Ids of every word.  Unseen ones are learnt in lower case and without the stops and commas after their last letter, where splitting cuts them as well."""
        if len(self.seen) > SEEN:
            self.seen = {"": b""}
        parts = {}
        for w in words:
            if w not in self.seen:
                end = m.start() if w[-1:] in ".," and w.isascii() and (m := TAIL.search(w)) and w[:m.start()][-1:].isalpha() else len(w)
                core = w[:end]
                parts[w] = (core.lower() if core.isascii() and "<|" not in core else core, w[end:])
        self.learn({p for both in parts.values() for p in both}.difference(self.seen))
        for w, (core, tail) in parts.items():
            if tail or core != w:
                self.seen[w] = self.seen[core] + self.seen[tail]
        return [self.seen[w] for w in words]

    def encode(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no NULLs), each followed by ``end``, and where each text's ids end."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        known = [*self.meet(words.dictionary.to_pylist()), end]
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(size) - size
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        word = np.insert(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends, len(known) - 1)
        each = size[word]
        done = np.cumsum(each)
        at = np.repeat(first[word] - (done - each), each) + np.arange(done[-1] if len(done) else 0)
        return np.frombuffer(b"".join(known), "<u4")[at], done[ends + np.arange(len(ends))]


def worker_words(vocabulary) -> Words:
    """The words this worker process knows, kept between tasks; ``vocabulary`` is a broadcast text."""
    kept = sys.modules.setdefault("_words_of_worker", types.ModuleType("_words_of_worker")).__dict__.setdefault("known", {})
    key = (hashlib.sha256(vocabulary.value.encode()).hexdigest(), SEEN)
    if key not in kept:
        kept.clear()
        kept[key] = Words(vocabulary.value)
    return kept[key]


def slices(texts: pa.Array):
    """(first, one past last) of runs of up to SLICE bytes, or of one longer text."""
    done = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + SLICE, "right")))
        yield a, b
        a = b


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids: the ids of every document and its end id, cut where they exceed ``length``.

    ``ids`` are little-endian unsigned 32-bit numbers.  ``tokenizer`` is the path of the vocabulary on the driver."""
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())  # one file of fixed size
    stop = np.array([end_id], "<u4").tobytes()

    def run(batches):
        words = worker_words(vocabulary)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            for a, b in slices(texts):
                ids, ends = words.encode(texts.slice(a, b - a), stop)
                begins = np.concatenate([[0], ends[:-1]])
                n = -(-(ends - begins) // length)
                row = np.repeat(np.arange(b - a), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                at = begins[row] + piece * length
                size = np.minimum(ends[row] - at, length)
                offsets = np.append(at, ends[-1]).astype(np.int64) * 4
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(a + row)), pa.array(piece, pa.int32()), pa.array(piece * length, pa.int64()), pa.array(size, pa.int64()), data],
                                                 ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def best_fit(length: np.ndarray, capacity: tuple[int, int, int], weights=(1.0, 1.0, 1.0), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces in the order given; capacities are tokens, documents and attention cost."""
    need = np.stack([length, np.ones_like(length), length * length], 1)
    if len(need) and (need.max(0) > capacity).any():
        raise ValueError("a piece needs more than a whole sequence has")
    unit = np.sqrt(np.array(weights, float)) / np.array(capacity, float)
    left, name, n_open, n = np.empty((len(need), 3), np.int64), np.empty(len(need), np.int64), 0, 0
    sequence, offset = np.empty(len(need), np.int64), np.empty(len(need), np.int64)
    least = need.min(0) if len(need) else need
    for k, x in enumerate(need):
        fits = np.flatnonzero((left[:n_open] >= x).all(1))
        if len(fits):
            free = left[fits] * unit
            score = ((free - x * unit) ** 2).sum(1) if rule == "norm" else -(free @ (x * unit))
            b = fits[score.argmin()]
        else:
            b, n_open = n_open, n_open + 1
            left[b], name[b] = capacity, n
            n += 1
        sequence[k], offset[k] = name[b], capacity[0] - left[b, 0]
        left[b] -= x
        if (left[b] < least).any():  # nothing fits any more
            n_open -= 1
            left[b], name[b] = left[n_open], name[n_open]
    return sequence, offset


def place(rows: DataFrame, capacity: int = LENGTH, max_docs: int | None = None, max_cost: int | None = None, weights=(1.0, 1.0, 1.0), rule: str = "norm") -> DataFrame:
    """``rows`` (with a ``length`` of up to ``capacity``) with ``sequence_id`` and ``offset``.

    Without ``max_docs`` and ``max_cost`` their capacities are what ``capacity`` tokens need at most, which never binds."""
    limits = (capacity, max_docs or capacity, max_cost or capacity * capacity)
    # the place in the input tells equal rows apart; the written table fixes it
    rows = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    size = rows.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("n")).first()
    shards = max(1, -(-size.tokens // SHARD_TOKENS), -(-size.n // SHARD_PIECES))
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    rows = rows.withColumn("__shard", F.pmod(F.xxhash64("__row"), F.lit(shards)))

    def run(key, group):
        group = group.drop_columns(["__shard"]).sort_by([("length", "descending"), ("__row", "ascending")])
        sequence, offset = best_fit(group.column("length").to_numpy(), limits, weights, rule)
        return group.append_column("sequence_id", pa.array(sequence * shards + key[0].as_py())).append_column("offset", pa.array(offset))

    return rows.groupBy("__shard").applyInArrow(run, schema).drop("__row")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from rows of ``place`` that kept their ids."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    return packed.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutup = pieces(table(spark, sf_dir, "documents"), default_tokenizer())
    return place(cutup.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
