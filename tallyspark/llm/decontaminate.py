"""Benchmark decontamination by latent semantic retrieval.

1. Inverse document frequencies of hashed words over the passages of all texts.
2. A randomised SVD of TF-IDF passages: tasks multiply their passages with a
   random matrix and back (one power step), the sums give an orthonormal
   basis, and a second sum its rotation and singular values.  The basis is fitted
   on every passage of all texts
   and of all benchmark items, whatever their block; every passage of every text is then searched.
3. Passages of the lengths near those of the items (``LENGTHS``), each a quarter
   apart, are projected (whitened by the singular values) and compared by cosine
   with all items of that length.
4. Candidates with enough words of the item are checked on words: the longest
   common subsequence with the item, and for paraphrases that the item's rarest
   words (its answer) occur.

The benchmark is the stated query set; it is taken in blocks of ``BLOCK`` items,
each compared with all rows.

Workers hold the words of ``SLICE`` bytes of texts at a time, or of one longer text.

Edge cases: NULL and empty texts and items match nothing; texts shorter than a
passage are one passage; repeated items are reported under each id; repeated
rows are reported once; rows with a NULL id are not reported; empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

import pickle
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm.anchors import ranges
from tallyspark.llm.common import row_key, slices, table, without

BUCKETS = 1 << 15
RANK, OVER = 64, 16
PASSAGE = 32
TOGETHER = 2048  # passages multiplied at once
MANY = 64  # occurrences in so many passages from which a bucket is summed by counts
FLUSH = 4  # products added up in single precision
PART = 1 << 19  # passages a task sums, at least; it sends BUCKETS x (RANK + OVER) numbers however few they are
LENGTHS = (1, 2, 4, 8, 16, 32, 48, 96, 192, 384)
BLOCK = 4096
COSINE = 0.4
EXACT, PARAPHRASE, ANSWER = 0.8, 0.5, 0.6   # shares of an item's words: in order; in order with its answer; of its answer
ANSWER_WORDS = 5
CHUNK = 8192  # words projected at once by the fit, and of a piece of a long text
GATHER = 1 << 14  # words of texts searched at once, at least
COSINES = 1 << 21  # cosines held at once
SLICE = 300_000  # bytes of texts, or one longer text, that a worker has in words at once
KNOWN = 1 << 16  # words whose bucket a worker keeps

# A-Z to lower case, other ASCII that is neither letter nor digit to a blank
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


# CRC-32 is linear: a byte adds the same bits wherever it stands that far from the end of its word, beside those of so many zero bytes
FAR = 64  # longest word whose bucket is found from arrays
ZEROS = np.array([zlib.crc32(bytes(n)) & 0xFFFF for n in range(FAR + 1)], np.uint16)
ADDS = np.array([(zlib.crc32(bytes([b]) + bytes(d)) ^ zlib.crc32(bytes(d + 1))) & 0xFFFF for d in range(FAR) for b in range(256)], np.uint16).reshape(FAR, 256)


def words_of(text: str | bytes | None) -> list[bytes]:
    return (text.encode() if isinstance(text, str) else text).translate(PLAIN).split() if text else []


def buckets_of(texts: list[bytes | None]) -> list[np.ndarray]:
    """Per text the buckets of its words, as ``Buckets`` has them."""
    blob = b" ".join([*(t or b"" for t in texts), b""]).translate(PLAIN)
    borders = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts)))
    ids, places, lo = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)], 0
    while lo < len(blob):  # whole words of SLICE bytes at a time
        hi = blob.rfind(b" ", lo, lo + SLICE) + 1 or blob.index(b" ", lo) + 1
        letters = np.frombuffer(blob, np.uint8, hi - lo, lo)
        inner = np.concatenate(([False], letters != 32))
        turn = np.flatnonzero(inner[1:] != inner[:-1])
        starts, stops = turn[::2], turn[1::2]
        size = np.minimum(stops - starts, FAR)
        # the longest first, so that words with a byte so far from their end are the first ones
        order = np.argsort((-size).astype(np.int8), kind="stable")
        last, sums = stops[order] - 1, ZEROS[size[order]]
        for far, n in enumerate(len(size) - np.cumsum(np.bincount(size, minlength=1))[:-1]):
            sums[:n] ^= ADDS[far].take(letters.take(last[:n] - far))
        found = np.empty_like(sums)
        found[order] = sums
        for i in np.flatnonzero(stops - starts > FAR).tolist():
            found[i] = zlib.crc32(blob[lo + starts[i]:lo + stops[i]]) & 0xFFFF
        ids.append(found % np.uint16(BUCKETS))
        places.append(starts + lo)
        lo = hi
    return np.split(np.concatenate(ids), np.searchsorted(np.concatenate(places), borders[:-1]))


class Buckets(dict):
    def __missing__(self, word):
        if len(self) >= KNOWN:
            self.clear()
        value = self[word] = zlib.crc32(word) % BUCKETS
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def lcs(masks: dict[bytes, int], m: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence, by bits; ``masks`` has the places of each word of the other side."""
    full = (1 << m) - 1
    v = full
    for w in words:
        y = v & masks.get(w, 0)
        v = ((v + y) | (v - y)) & full
    return m - v.bit_count()


def cut_up(docs: DataFrame, text: str = "text") -> DataFrame:
    """ids: per text with words the buckets of its words as 16-bit numbers, in passages of PASSAGE, each in order; the last one is filled up with BUCKETS."""
    def run(batches):
        for batch in batches:
            for _, texts in slices(batch["text"], SLICE):
                out = []
                for words in buckets_of(texts):
                    if len(words):
                        ids = np.full(-(-len(words) // PASSAGE) * PASSAGE, BUCKETS, np.uint16)
                        ids[:len(words)] = words
                        out.append(np.sort(ids.reshape(-1, PASSAGE), axis=1).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    return docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "ids binary")


def passages(batches, together: int = TOGETHER):
    """Arrays (passages, PASSAGE) of buckets, of up to ``together`` passages."""
    for batch in batches:
        ids = np.frombuffer(b"".join(batch["ids"].to_pylist()), np.uint16).reshape(-1, PASSAGE)
        yield from (ids[a:a + together] for a in range(0, len(ids), together))


def weights(ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of some passages and the TF-IDF of each passage, of length 1: what ``lengths``, ``projected`` and ``spread`` multiply with, written out."""
    seen = np.zeros(BUCKETS + 1, bool)
    seen[ids] = True
    at = np.flatnonzero(seen)
    place = np.empty(BUCKETS + 1, np.int64)
    place[at] = np.arange(0, len(at) * len(ids), len(ids))
    # a row for each bucket, as both products take them
    w = np.bincount((place[ids] + np.arange(len(ids))[:, None]).ravel(), idf[ids].ravel(), len(ids) * len(at)).astype(np.float32).reshape(len(at), len(ids))
    w /= np.maximum(np.sqrt(np.einsum("ij,ij->j", w, w)), 1e-9)
    return at, w.T


def lengths(ids: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Length of the TF-IDF of each passage; its buckets are in order."""
    new = np.ones(ids.shape, bool)
    np.not_equal(ids[:, 1:], ids[:, :-1], out=new[:, 1:])
    first = np.flatnonzero(new)
    weight = np.diff(first, append=ids.size) * idf[ids.ravel()[first]]
    return np.maximum(np.sqrt(np.bincount(first // ids.shape[1], weight * weight, len(ids))), 1e-9)


def projected(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per passage the sum of the rows of its buckets, CHUNK words at a time."""
    out, step = np.empty((len(ids), table.shape[1]), table.dtype), max(CHUNK // ids.shape[1], 1)
    for a in range(0, len(ids), step):
        table.take(ids[a:a + step], axis=0).sum(axis=1, out=out[a:a + step])
    return out


def spread(out: np.ndarray, ids: np.ndarray, values: np.ndarray) -> None:
    """Adds the row of each passage to the rows of its buckets, as often as these occur in it; each row of ``out`` is touched once."""
    order = np.argsort(ids, axis=None, kind="stable")
    word, owner = ids.ravel()[order], order // ids.shape[1]
    first = np.flatnonzero(np.diff(word, prepend=np.uint16(word[0] ^ 1)))
    count = np.diff(first, append=len(word))
    most = np.argsort(-count, kind="stable")
    first, count = first[most], count[most]
    total = np.empty((len(first), values.shape[1]), values.dtype)
    many = int(np.searchsorted(-count, -MANY))
    # the n-th occurrence of each bucket
    total[many:] = values.take(owner[first[many:]], axis=0)
    for n in range(1, int(count[many]) if many < len(count) else 0):
        upto = int(np.searchsorted(-count, -n))
        total[many:upto] += values.take(owner[first[many:upto] + n], axis=0)
    if many:
        own = owner[ranges(first[:many], first[:many] + count[:many])]
        times = np.bincount(np.repeat(np.arange(many) * len(ids), count[:many]) + own, minlength=many * len(ids))
        total[:many] = times.astype(values.dtype).reshape(many, len(ids)) @ values
    out[word[first]] += total


def frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches):
        found, n = np.zeros(BUCKETS + 1, np.int64), 0
        for ids in passages(batches, CHUNK // PASSAGE):
            # each bucket of a passage once
            found += np.bincount(ids[:, 0], minlength=BUCKETS + 1) + np.bincount(ids[:, 1:][ids[:, 1:] != ids[:, :-1]], minlength=BUCKETS + 1)
            n += len(ids)
        at = np.flatnonzero(found[:BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(found[at], n))], ["bucket", "n"])

    rows = rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS + 1 rows
    df = np.zeros(BUCKETS, np.int64)
    total = 0
    for r in rows:
        if r.bucket < 0:
            total = r.n
        else:
            df[r.bucket] = r.n
    return df, total


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages each bucket occurs, and the number of passages."""
    return frequencies(cut_up(docs))


def summed(rows: DataFrame, product, shape: tuple[int, int]) -> np.ndarray:
    """Sum over tasks of the matrices that ``product(total, passages)`` adds to, added up in slices of rows."""
    step = 256

    def run(batches):
        total, part = np.zeros(shape, np.float64), np.zeros(shape, np.float32)
        for n, ids in enumerate(passages(batches), 1):
            product(part, ids)
            if n % FLUSH == 0:
                total += part
                part[:] = 0
        total += part
        for lo in range(0, shape[0], step):
            yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int64()), pa.array([total[lo:lo + step].tobytes()], pa.binary())], ["lo", "part"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.float64) for v in t["part"].to_pylist())
        return pa.table({"lo": t["lo"][:1], "part": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(run, "lo long, part binary").groupBy("lo").applyInArrow(add, "lo long, part binary").collect()
    out = np.zeros(shape)
    for r in parts:
        out[r.lo:r.lo + step] = np.frombuffer(r.part, np.float64).reshape(-1, shape[1])
    return out


def latent_basis(rows: DataFrame, idf: np.ndarray, total: int) -> np.ndarray:
    """Words to latent coordinates: right singular vectors over singular values, rows scaled by IDF.  ``rows`` are those of ``cut_up``, of about ``total`` passages."""
    rows = rows.coalesce(8 + total // PART)
    width = RANK + OVER
    idf = np.append(idf, 0)  # words that fill a passage up weigh nothing
    single = idf.astype(np.float32)[:, None]
    omega = np.random.default_rng(11).normal(size=(BUCKETS + 1, width)).astype(np.float32)
    omega *= single

    def there_and_back(out, ids):
        spread(out, ids, projected(ids, omega) / np.square(lengths(ids, idf)).astype(np.float32)[:, None])

    back = summed(rows, there_and_back, (BUCKETS + 1, width))[:BUCKETS]
    back *= idf[:BUCKETS, None]
    basis, _ = np.linalg.qr(back)
    del back, omega  # the driver holds few of these at once
    flat = np.zeros((BUCKETS + 1, width), np.float32)
    flat[:BUCKETS] = basis
    flat *= single

    def gram(out, ids):
        b = projected(ids, flat) / lengths(ids, idf).astype(np.float32)[:, None]
        out += b.T @ b

    value, vector = np.linalg.eigh(summed(rows, gram, (width, width)))
    top = np.argsort(-value)[:RANK]
    scale = np.where(value[top] > 1e-9, 1 / np.sqrt(np.maximum(value[top], 1e-9)), 0)
    return (idf[:BUCKETS, None] * (basis @ vector[:, top] * scale)).astype(np.float32)


def bits_of(ids: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Bits: the buckets of each row."""
    bits = np.zeros((rows, BUCKETS // 8), np.uint8)
    np.bitwise_or.at(bits.reshape(-1), row * (BUCKETS // 8) + (ids >> 3), (1 << (ids & 7)).astype(np.uint8))
    return bits


class Search:
    """Items of one block, ready to be compared with texts."""

    def __init__(self, items: list[tuple[int, list[bytes]]], basis: np.ndarray, idf: np.ndarray):
        self.rows = np.vstack([basis, np.zeros((1, basis.shape[1]), basis.dtype)])  # words that fill a unit up add nothing
        self.items = []
        buckets = Buckets()
        for item_id, words in items:
            masks: dict[bytes, int] = {}
            for i, w in enumerate(words):
                masks[w] = masks.get(w, 0) | 1 << i
            rare = sorted(set(words), key=lambda w: (-idf[buckets[w]], w))[:ANSWER_WORDS]
            self.items.append((item_id, len(words), masks, rare))
        self.size = np.array([n for _, n, _, _ in self.items], np.int64)
        self.held = np.zeros((len(items), BUCKETS // 8), np.uint8)  # bits: the buckets of each item
        for row, (_, words) in zip(self.held, items, strict=True):
            at = buckets.of(words)
            np.bitwise_or.at(row, at >> 3, (1 << (at & 7)).astype(np.uint8))
        self.buckets = np.concatenate([buckets.of(words) for _, words in items])
        group = np.array([int(np.argmin([abs(n - m) for m in LENGTHS])) for _, n, _, _ in self.items], np.int64)
        self.groups = []
        for g, length in enumerate(LENGTHS):
            at = np.flatnonzero(group == g)
            if len(at):  # only lengths near that of an item are compared
                vec = np.array([basis[buckets.of(items[i][1])].sum(0) for i in at])
                self.groups.append((length, at, (vec / np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)).astype(np.float32)))

    def candidates(self, ids: np.ndarray, edges: np.ndarray):
        """Arrays (text, item, first word, last word, cosine) of passages near an item in the latent space; text t is ids[edges[t]:edges[t + 1]]."""
        size = np.diff(edges)
        # sums of units of words, counted from the beginning of each text, and of 2, 4, 8 ... units; the last unit is filled up with nothing
        unit = int(np.gcd.reduce([max(length // 4, 1) for length, _, _ in self.groups]))
        units = -(-size // unit)
        begin = np.cumsum(units) - units
        filled = np.full(int(units.sum()) * unit, BUCKETS, np.int64)
        filled[np.arange(len(ids)) + np.repeat(begin * unit - edges[:-1], size)] = ids
        sums = [self.rows.take(filled[::unit], axis=0)]
        for n in range(1, unit):
            sums[0] += self.rows.take(filled[n::unit], axis=0)
        longest = self.groups[-1][0]
        while 2 << len(sums) - 1 <= min(longest // unit, len(sums[0])):
            half = 1 << len(sums) - 1
            sums.append(sums[-1][half:] + sums[-1][:-half])
        # texts shorter than a passage are one passage
        short = np.flatnonzero(size < longest)
        whole = np.zeros((len(size), self.rows.shape[1]), np.float32)
        if len(short):
            whole[short] = np.add.reduceat(sums[0].take(ranges(begin[short], (begin + units)[short]), axis=0), np.cumsum(units[short]) - units[short], axis=0)
        for length, at, vec in self.groups:
            step = max(length // 4, 1)
            count = np.maximum(size - length, 0) // step + 1 + (np.maximum(size - length, 0) % step > 0)  # the last one ends with the text
            owner = np.repeat(np.arange(len(size)), count)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            first = np.minimum(nth * step, np.maximum(size - length, 0)[owner])
            start = edges[owner] + first
            stop = np.minimum(start + length, edges[owner + 1])
            part = size[owner] < length
            lo = np.where(part, 0, begin[owner] - -first // unit)
            here = None
            for k in range(len(sums)):
                if length // unit >> k & 1:
                    some = sums[k].take(lo, axis=0, mode="clip")  # what is clipped is set below
                    here = some if here is None else np.add(here, some, out=here)
                    lo += 1 << k
            if here is None or part.any():
                here = whole[owner] if here is None else here
                here[part] = whole[owner[part]]
            odd = np.flatnonzero(first % unit)  # the last of a text, from before a unit
            for a in range(0, len(odd), max(CHUNK // unit, 1)):
                some = odd[a:a + max(CHUNK // unit, 1)]
                place = start[some, None] + np.arange(unit - 1)
                before = place < (start[some] + -first[some] % unit)[:, None]
                here[some] += self.rows.take(np.where(before, ids[np.minimum(place, len(ids) - 1)], BUCKETS), axis=0).sum(axis=1)
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", here, here)), 1e-9)
            most = max(COSINES // len(at), 1)
            for a in range(0, len(here), most):
                cosine, long = here[a:a + most] @ vec.T, norm[a:a + most]
                near = np.flatnonzero(cosine.max(axis=1) > COSINE * long)
                hit, which = np.nonzero(cosine[near] > COSINE * long[near, None])
                h = near[hit]
                cosine = cosine[h, which] / long[h]
                h += a
                yield owner[h], at[which], first[h], stop[h] - edges[owner[h]], cosine

    def close(self, ids: np.ndarray, edges: np.ndarray, t: np.ndarray, i: np.ndarray, lo: np.ndarray, hi: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which candidates have half of the item's words near, by bucket; those that reach into another piece of their text all may."""
        half, size = self.size[i] // 2, edges[t + 1] - edges[t]
        first, last = np.maximum(lo - half, 0), np.minimum(hi + half, size)
        more = (lo < half) & (before[t] > 0) | (hi + half > size) & (after[t] > 0)
        found = np.zeros(len(t), bool)
        for a in range(0, len(t), 256):
            part = slice(a, a + 256)
            n = np.arange(len(t[part]))
            near = ids[ranges((edges[t] + first)[part], (edges[t] + last)[part])]
            found[part] = self.present(bits_of(near, np.repeat(n, (last - first)[part]), len(n)), n, i[part], more[part])
        return found

    def present(self, bits: np.ndarray, t: np.ndarray, i: np.ndarray, more: np.ndarray) -> np.ndarray:
        """Which candidates have half of the item's words, by bucket, in row t of ``bits``, a bound of the LCS; rows with ``more`` words around all may."""
        of = t * len(self.size) + i
        enough = np.zeros(len(bits) * len(self.size), bool)
        enough[of] = True
        pair = np.flatnonzero(enough)
        text, item = pair // len(self.size), pair % len(self.size)
        stop = np.cumsum(self.size)
        word = self.buckets[ranges((stop - self.size)[item], stop[item])]
        held = bits[np.repeat(text, self.size[item]), word >> 3] >> (word & 7).astype(np.uint8) & 1
        count = np.diff(np.concatenate(([0], np.cumsum(held, dtype=np.int64)))[np.concatenate(([0], np.cumsum(self.size[item])))])
        enough[pair] = (count >= PARAPHRASE * self.size[item]) | more[text]
        return enough[of]

    def possible(self, ids: np.ndarray, edges: np.ndarray, t: np.ndarray, i: np.ndarray, lo: np.ndarray, hi: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which candidates have enough words near whose bucket is one of the item's, a bound of the LCS; words of the text before or after its piece count as such."""
        half = self.size[i] // 2
        first, last = lo - half, hi + half
        size = edges[t + 1] - edges[t]
        found = np.minimum(np.maximum(-first, 0), before[t]) + np.minimum(np.maximum(last - size, 0), after[t])
        first, last = edges[t] + np.maximum(first, 0), edges[t] + np.minimum(last, size)
        byte, bit = (ids >> 3).astype(np.int64), (1 << (ids & 7)).astype(np.uint8)
        held, row = self.held.reshape(-1), i * self.held.shape[1]
        for at in range(0, int((last - first).max(initial=0)), 32):
            place = (first + at)[:, None] + np.arange(32)
            within = held.take(row[:, None] + byte.take(place, mode="clip")) & bit.take(place, mode="clip") != 0
            within &= place < last[:, None]
            found += np.count_nonzero(within, axis=1)
        return found >= PARAPHRASE * self.size[i]

    def matches(self, texts: list[list[bytes]], buckets: Buckets):
        """``found`` for texts in words."""
        return self.found([buckets.of(words) for words in texts], texts.__getitem__)

    def found(self, texts: list[np.ndarray], words):
        """(text, item id, LCS, words of the item, cosine) of the items that texts hold, given by their buckets; ``words(t)`` has
        the words of text t, asked for only where an item may be.  A text above CHUNK words is taken in overlapping pieces."""
        best: dict[tuple[int, int], tuple[int, float]] = {}
        pieces, held = [], 0

        def flush():
            edges = np.cumsum([0, *(len(i) for _, _, i in pieces)])
            ids = np.concatenate([i for _, _, i in pieces])
            before = np.array([shift for _, shift, _ in pieces])
            after = np.array([len(texts[owner]) - shift - len(i) for owner, shift, i in pieces])
            bits = bits_of(ids, np.repeat(np.arange(len(pieces)), np.diff(edges)), len(pieces))
            for found in self.candidates(ids, edges):
                for at in range(0, len(found[0]), CHUNK):
                    part = [column[at:at + CHUNK] for column in found]
                    left = self.present(bits, *part[:2], before + after > 0)
                    part = [column[left] for column in part]
                    for bound in (self.possible, self.close):
                        left = bound(ids, edges, *part[:4], before, after)
                        part = [column[left] for column in part]
                    verify(*(column.tolist() for column in part))
            pieces.clear()

        def verify(*columns):
            for t, i, lo, hi, cosine in zip(*columns, strict=True):
                owner, shift, _ = pieces[t]
                _, m, masks, rare = self.items[i]
                near = words(owner)[max(0, shift + lo - m // 2):shift + hi + m // 2]
                # places of the item whose word is near at all: a bound of the LCS that costs a tenth of it
                if sum(masks[w].bit_count() for w in masks.keys() & set(near)) < PARAPHRASE * m:
                    continue
                common = lcs(masks, m, near)
                enough = common >= EXACT * m or common >= PARAPHRASE * m and sum(w in near for w in rare) >= ANSWER * len(rare)
                if enough and (common, cosine) > best.get((owner, i), (0, 0.0)):
                    best[owner, i] = (common, cosine)

        for owner, ids in enumerate(texts):
            for lo in range(0, max(len(ids) - LENGTHS[-1], min(len(ids), 1)), CHUNK):
                pieces.append((owner, lo, ids[lo:lo + CHUNK + LENGTHS[-1]]))
                held += len(pieces[-1][2])
                if held >= GATHER:
                    flush()
                    held = 0
        if pieces:
            flush()
        return [(owner, self.items[i][0], common, self.items[i][1], cosine) for (owner, i), (common, cosine) in best.items()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, lcs, item_words, cosine: every text that holds an item, exactly or paraphrased."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    asked = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where("id IS NOT NULL")
    queue = asked.orderBy("id", "text")
    # two bytes a word, read by the frequencies and the sums of the basis; items too are cut up before, so that no task of a sum needs two workers
    ids, more = (cut_up(rows).persist(StorageLevel.DISK_ONLY) for rows in (docs, asked))
    try:
        df, total = frequencies(ids)
        idf = np.log((total + 1) / (df + 1)) + 0.1
        basis = latent_basis(ids.unionAll(more), idf, total) if more.count() else None  # of the items of all blocks
    finally:
        ids.unpersist()
        more.unpersist()
    schema = "doc_id long, item_id long, lcs long, item_words long, cosine double"
    out, after = None, None
    while True:
        # the next block of whole ids
        rows = queue.where(F.col("id") > after if after is not None else F.lit(True)).limit(block).collect()
        if not rows:
            return out if out is not None else docs.sparkSession.range(0).select(*[F.col("id").cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")])
        after = rows[-1].id
        items = [(r.id, w) for r in queue.where(F.col("id").between(rows[0].id, after)).collect() if (w := words_of(r.text))]
        if not items:
            continue
        search = Search(items, basis, idf)
        shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(search))  # BUCKETS x RANK numbers and one block of items; its class travels along

        def run(batches, shared=shared):
            search = pickle.loads(shared.value)
            for batch in batches:
                ids = batch["doc_id"].to_pylist()
                found = []
                for a, texts in slices(batch["text"].cast(pa.binary()), SLICE):
                    words = cache(lambda t, texts=texts: words_of(texts[t]))
                    found += [(ids[a + t], *m) for t, *m in search.found(buckets_of(texts), words)]
                columns = list(zip(*found, strict=True)) if found else [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "lcs", "item_words", "cosine"])

        here = docs.mapInArrow(run, schema)
        out = here if out is None else out.unionAll(here)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without a benchmark item, with their own columns; rows without an id are judged by their text."""
    keyed = docs.select(row_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    return without(docs, row_key(doc_id, text), find_leaks(keyed, benchmark, "key").select("doc_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("lcs").alias("lcs"), F.max("item_words").alias("item_words"), F.round(F.max("cosine"), 4).alias("cosine"))
