"""Suffix-array dedup over bytes with a run-length index.

Fragments that share an anchor but differ (see ``anchors``) meet in one
bucket, and there in one index of about ``INDEX_BYTES``.  A suffix array over them gives a Burrows-Wheeler transform,
which is kept as runs: head symbol, start, the LF target of its first row, and
a sample at each run (cut where neighbours stop sharing ``window`` bytes): the
smallest document of its rows.  Each fragment is streamed backwards through the
index by LF steps, which gives the row of every position; a bit per row and counts
per 64 rows tell its run.  No matching statistic
is computed: a position is marked when the class of its row, the rows whose
suffixes share ``window`` bytes by the ranks of the uncompressed suffix array,
holds a smaller document.  Marked
windows and fragments that whole earlier documents repeat are removed.

Anchors with more than ``HOT_FRAGMENTS`` different fragments are not gathered;
their windows are compared by hash, spread over all buckets.

Edge cases: NULL and empty texts have no bytes; NULL ids order after all
others; rows that share an id do not count as smaller than each other; matches
never cross documents; texts below 50 bytes have no window; empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm.anchors import Blocks, Bytes, Repeats, find_repeats, gathered, ranges, row
from tallyspark.llm.common import table

WINDOW = 50


INDEX_BYTES = 1 << 18  # text that one index is meant to have; only fragments of one anchor make it larger


def in_order(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys of up to ``bits`` bits, equal ones by place, and the sorted keys."""
    place = len(key).bit_length()
    if bits + place > 64:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    packed = np.sort(key << np.uint64(place) | np.arange(len(key), dtype=np.uint64))
    return (packed & np.uint64((1 << place) - 1)).astype(np.int64), packed >> np.uint64(place)


def last_true(flag: np.ndarray) -> np.ndarray:
    """Place of the last True up to each place."""
    return np.maximum.accumulate(np.where(flag, np.arange(len(flag)), 0))


class RunIndex:
    """Run-length index of texts; text j ends with a mark of its own, which sorts before every byte."""

    def __init__(self, texts: list[bytes], docs: np.ndarray, window: int):
        self.m = len(texts)
        lens = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lens + 1) - 1
        n = int(ends[-1]) + 1
        symbols = np.empty(n, np.int64)
        inner = np.ones(n, bool)
        inner[ends] = False
        symbols[inner] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + self.m
        symbols[ends] = np.arange(self.m)
        self.starts, self.ends, self.lens = ends - lens, ends, lens
        letters = np.frombuffer(b"".join(texts), np.uint8)
        seen = np.zeros(256, bool)
        seen[letters] = True
        codes = np.zeros(n, np.uint64)  # 0: a mark
        codes[inner] = np.cumsum(seen).astype(np.uint64)[letters]
        left = np.repeat(ends, lens + 1) - np.arange(n)  # symbols before the mark
        # first by as many symbols as a key holds beside its place, nothing after a mark
        bits, place = int(np.count_nonzero(seen)).bit_length() or 1, n.bit_length()
        width, half = max(1, min((64 - place) // bits, window, n)), None
        key = np.zeros(n, np.uint64)
        for j in range(width):
            key <<= np.uint64(bits)
            key[:n - j] |= np.where(left[:n - j] >= j, codes[j:], 0)
        at, key = in_order(key, width * bits)
        # equal up to a mark: in text order, so settled; others share the rank of their first
        new = np.concatenate(([True], key[1:] != key[:-1])) | (left[at] < width)
        rank = np.empty(n, np.int64)
        rank[at] = last_true(new)
        while True:
            at = at[~(new & np.concatenate((new[1:], [True])))]  # those that share a rank, in order
            if half is None and (width * 2 > window or not len(at)):
                half = (rank.copy(), width)  # ranks by the longest power of two of symbols that a window holds
            if not len(at):
                break
            # twice as many symbols: by the rank of what follows
            old = rank[at]
            by, key = in_order(old.astype(np.uint64) << np.uint64(place) | rank[at + width].astype(np.uint64), 2 * place)
            at = at[by]  # stays within its old rank, so ``old`` needs no new order
            new = np.concatenate(([True], key[1:] != key[:-1]))
            rank[at] = old + last_true(new) - last_true(np.concatenate(([True], old[1:] != old[:-1])))
            width *= 2
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        before = symbols[order - 1]
        # rows whose suffixes share the first ``window`` symbols
        head, wide = half
        tail = np.minimum(np.arange(n) + window - wide, n - 1)
        same = (head[order[1:]] == head[order[:-1]]) & (head[tail[order[1:]]] == head[tail[order[:-1]]])
        self.classes = np.flatnonzero(np.concatenate(([True], ~same)))
        # runs, cut at class borders, each with its smallest document
        cut = np.concatenate(([True], (before[1:] != before[:-1]) | ~same))
        self.run_start = np.flatnonzero(cut)
        self.run_head = before[self.run_start]
        size = np.diff(np.concatenate((self.run_start, [n])))
        of = np.repeat(docs, lens + 1)[order]
        self.run_low = np.minimum.reduceat(of, self.run_start)
        class_of = np.searchsorted(self.classes, self.run_start, side="right") - 1
        self.low = np.minimum.reduceat(self.run_low, np.searchsorted(self.run_start, self.classes))[class_of]
        # a bit per row where a run begins, and the runs before each word of 64 rows
        self.words = np.packbits(np.pad(cut, (0, -n % 64)), bitorder="little").view(np.uint64)
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words) - 1
        # LF of the first row of each run: symbols before it, then equal symbols above it
        by = np.argsort(self.run_head, kind="stable")
        self.run_lf = np.empty(len(by), np.int64)
        self.run_lf[by] = np.cumsum(size[by]) - size[by]

    def runs(self, rows: np.ndarray) -> np.ndarray:
        """Run of each row."""
        word = rows >> 6
        upto = np.uint64(0xFFFFFFFFFFFFFFFF) >> (63 - (rows & 63)).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & upto)

    def back(self, rows: np.ndarray, run: np.ndarray) -> np.ndarray:
        """Row of the suffix one symbol longer; ``run`` has the runs of ``rows``."""
        return self.run_lf[run] + rows - self.run_start[run]

    def stream(self):
        """For step 1, 2, ...: texts still running, the row of their position that many from the end, and its run.
        ``low`` of a run is the smallest document that has the first ``window`` symbols of its suffixes."""
        rows, live = np.arange(self.m), np.arange(self.m)  # the marks sort first, in text order
        run, step = self.runs(rows), 0
        while len(live):
            step += 1
            keep = self.lens[live] >= step
            if not keep.all():
                live, rows, run = live[keep], rows[keep], run[keep]
            if len(live):
                rows = self.back(rows, run)
                run = self.runs(rows)
                yield step, live, rows, run


def marked_windows(texts: list[bytes], docs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """A mask of the windows of all texts, end to end, that a text of a smaller document has too, and its edges."""
    index = RunIndex(texts, docs, window)
    edge = np.concatenate(([0], np.cumsum(np.maximum(index.lens - window + 1, 0))))
    flat = np.zeros(edge[-1], np.uint8)
    for step, live, _, run in index.stream():
        if step >= window:
            flat[edge[live] + index.lens[live] - step] = index.low[run] < docs[live]
    return flat, edge


def repeated_windows(texts: list[bytes], docs: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """Per text, a mask of its windows that a text of a smaller document has too."""
    flat, edge = marked_windows(texts, docs, window)
    return np.split(flat, edge[1:-1])


class ByteRepeats(Repeats):
    # a long gram: short ones repeat by chance as a corpus grows
    tokens, window, gram = Bytes, WINDOW, 28

    def cut_out(self, bodies: list[bytes], b: Blocks, which: np.ndarray) -> list[bytes]:
        blob = b"".join(bodies)
        return [blob[lo:hi] for lo, hi in zip(b.first[which].tolist(), (b.stop[which] + self.window - 1).tolist(), strict=True)]

    def matched(self, bucket: int, table: pa.Table) -> list[tuple]:
        """Fragments of one anchor are in one index; small anchors share one of about INDEX_BYTES."""
        parts, edges, (frags, docs, lens) = gathered(table, np.uint64, np.int64, np.int64)
        anchor, lens = lens >> 32, lens & 0xFFFFFFFF
        blob = b"".join(table["w"].to_pylist())
        start = np.cumsum(lens) - lens
        size = lens - self.window + 1
        edge = np.concatenate(([0], np.cumsum(size)))
        marks = np.zeros(edge[-1], np.uint8)
        to = anchor % max(1, len(blob) // INDEX_BYTES)
        by = np.argsort(to, kind="stable")
        for mine in np.split(by, np.flatnonzero(np.diff(to[by])) + 1):
            texts = [blob[a:z] for a, z in zip(start[mine].tolist(), (start + lens)[mine].tolist(), strict=True)]
            marks[ranges(edge[mine], edge[mine + 1])] = marked_windows(texts, docs[mine], self.window)[0]
        some = np.diff(np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))[edge]) > 0
        out = []
        for i, part in enumerate(parts):
            mine = np.arange(edges[i], edges[i + 1])[some[edges[i]:edges[i + 1]]]
            if len(mine):
                out.append(row(part, bucket, 4, frags[mine], size[mine], marks[ranges(edge[mine], edge[mine + 1])]))
        return out

    def keep(self, body: bytes, drop: np.ndarray | None) -> bytes:
        return body if drop is None else np.frombuffer(body, np.uint8)[~drop].tobytes()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (byte offsets, end exclusive) and the remaining bytes of every document."""
    found = find_repeats(docs, ByteRepeats, doc_id, text)
    return found.select("doc_id", F.col("n_tokens").alias("n_bytes"), "n_removed", F.arrays_zip(F.col("span_starts").alias("start"), F.col("span_ends").alias("end")).alias("spans"), "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
