"""Repeats across documents: winnowed anchors and the three rounds that compare them.

Tokens are words or bytes.  Every window of ``window`` tokens selects one anchor:
the gram of ``gram`` tokens in it with the smallest hash, leftmost first.
Equal windows select equal anchors, so all occurrences of a window meet under
its anchor.  Neighbouring windows with the same anchor occurrence form a
block; the block's fragment is the text that these windows cover.

1. Anchors: which of them occur in two documents or more.
2. Fragments of those: the smallest document of each, and whether the anchor
   has other fragments too.  A fragment met in a smaller document is a repeat
   as a whole.
3. Fragments that share an anchor but differ are extended from the anchor both
   ways, window by window (subclasses say how).

Texts are dealt once into parts by document id; the rounds send back only
arrays of hashes between parts and buckets, one row per (part, bucket).  Each
part sends a key once, however often it holds it, so a hot anchor costs one
entry per part.  Keys are spread by hash; the size of a part and of a bucket
depends on the bytes of all texts, not on groups.

A part's documents are read in chunks of ``TOGETHER`` bytes, or of one longer
document, laid end to end; windows never cross a border.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyspark.llm.common import slices, text_bytes

LAST = np.iinfo(np.int64).max  # order of a NULL document id: after all others
BASE = 0x9E3779B97F4A7C15 | 1
WIRE = "part int, bucket int, kind int, x binary, y binary, z binary, w binary"
HOT_FRAGMENTS = 4096  # an anchor with more fragments is compared by window hash instead of being gathered
TOGETHER = 1 << 16  # bytes of documents that are hashed at once, or one longer document
KEEP, EXTEND, SPREAD = 0, 1, 2


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up), 1 << 14)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


class Sums:
    """Hash of any stretch of a token array from prefix sums."""

    def __init__(self, tokens: np.ndarray, powers: Powers):
        n = len(tokens)
        powers.upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tokens * powers.up[:n], out=self.sums[1:])
        self.down = powers.down

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))  # a 64-bit number for each byte
IN_WORD = np.ones(256, bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False  # where bytes.split() parts: TAB, LF, VT, FF, CR and space
LONG_WORD = 64  # bytes; longer words are hashed one by one, as sums modulo 2**64 are weak over long stretches

WORDS_TOGETHER = 1 << 14


class Words:
    """Word tokens: 64-bit hashes of the words of a UTF-8 text, from sums over its bytes."""

    def __init__(self):
        self.powers = Powers()

    def __call__(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all bodies, end to end, and how many each has."""
        blob = b" ".join([*bodies, b""])
        letters = np.frombuffer(blob, np.uint8)
        turn = np.flatnonzero(np.diff(np.concatenate(([False], IN_WORD[letters])).view(np.int8)))  # the blob ends with a space
        starts, ends = turn[::2], turn[1::2]
        tokens = np.empty(len(starts), np.uint64)
        for w in range(0, len(starts), WORDS_TOGETHER):  # eight bytes a letter are held for these only
            a, z = starts[w:w + WORDS_TOGETHER], ends[w:w + WORDS_TOGETHER]
            tokens[w:w + WORDS_TOGETHER] = Sums(LETTERS[letters[a[0]:z[-1]]], self.powers).of(a - a[0], z - a[0])
        tokens = mixed(tokens + np.uint64(BASE))
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            tokens[i] = xxhash.xxh3_64_intdigest(blob[starts[i]:ends[i]])
        borders = np.cumsum(np.fromiter((len(body) + 1 for body in bodies), np.int64, len(bodies)))
        return tokens, np.diff(np.searchsorted(starts, borders), prepend=0)


class Bytes:
    def __call__(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return LETTERS[np.frombuffer(b"".join(bodies), np.uint8)], np.fromiter(map(len, bodies), np.int64, len(bodies))


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its end (exclusive), laid end to end."""
    size = ends - starts
    done = np.cumsum(size)
    return np.repeat(starts - (done - size), size) + np.arange(int(done[-1]) if len(done) else 0)


class Blocks:
    """The blocks of documents laid end to end: windows [first, stop) of document ``owner`` share the anchor at ``at``."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, window: int, gram: int, powers: Powers):
        self.n, self.window, self.sizes = len(tokens), window, sizes
        self.edges = np.concatenate(([0], np.cumsum(sizes)))
        m = len(tokens) - window + 1
        self.m = max(m, 0)
        if m <= 0:
            self.first = self.stop = self.at = self.owner = np.zeros(0, np.int64)
            self.anchor = self.fragment = np.zeros(0, np.uint64)
            return
        self.sums = Sums(tokens, powers)
        grams = mixed(self.sums.grams(gram))
        order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        at = (sliding_min(order, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inner = owner[:m] == owner[window - 1:]  # windows within one document
        cut = at[1:] != at[:-1]
        self.first = np.flatnonzero(inner & np.concatenate(([True], cut | ~inner[:-1])))
        self.stop = np.flatnonzero(inner & np.concatenate((cut | ~inner[1:], [True]))) + 1
        self.owner = owner[self.first]
        self.at = at[self.first]
        self.anchor = grams[self.at]
        # the anchor's own high half was picked as a minimum, so it is mixed again before it serves as a key
        self.anchor = mixed(self.anchor + np.uint64(BASE))
        width = (self.stop - self.first + window - 1).astype(np.uint64)
        shift = (self.at - self.first).astype(np.uint64)
        self.fragment = mixed(self.sums.of(self.first, self.stop + window - 1) ^ mixed(width * np.uint64(BASE) + shift))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows of some blocks, block by block."""
        at = ranges(self.first[which], self.stop[which])
        return at, mixed(self.sums.of(at, at + self.window) + np.uint64(1)) if len(at) else np.zeros(0, np.uint64)


def runs(flag: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of True, cut at ``edges``."""
    cut = np.zeros(len(flag) + 1, bool)
    cut[edges] = True
    return np.flatnonzero(flag & (cut[:-1] | np.concatenate(([True], ~flag[:-1])))), np.flatnonzero(flag & (cut[1:] | np.concatenate((~flag[1:], [True])))) + 1


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of n tokens under windows of ``width`` that begin where ``starts`` (a mask) is set."""
    step = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(starts)  # each once, so plain indexing adds
    step[at] += 1
    step[at + width] -= 1
    return np.cumsum(step[:n]) > 0


def inside(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted table, -1 where it is missing."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def row(part: int, bucket: int, kind: int, *columns) -> tuple:
    packed = [c if isinstance(c, bytes) else np.ascontiguousarray(c).tobytes() for c in columns]
    return (part, bucket, kind, *packed, *[b""] * (4 - len(packed)))


def as_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 4
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("part", "bucket", "kind", "x", "y", "z", "w"), columns, kinds, strict=True)})


def dealt(part: int, kind: int, buckets: int, key: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    """One row per bucket with the entries whose key falls in it."""
    if not len(key):
        return []
    to = (key & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
    order = np.argsort(to, kind="stable")
    to = to[order]
    cuts = np.flatnonzero(to[1:] != to[:-1]) + 1
    edges = np.concatenate(([0], cuts, [len(to)]))
    held = [c[order] for c in columns]
    return [row(part, int(to[a]), kind, *[c[a:b] for c in held]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def gathered(table: pa.Table, *kinds) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """Parts, edges of each part's entries, and the columns of a bucket laid end to end."""
    columns = [[np.frombuffer(v, k) for v in table[n].to_pylist()] for n, k in zip("xyzw", kinds, strict=False)]
    edges = np.concatenate(([0], np.cumsum([len(v) for v in columns[0]]))).astype(np.int64)
    return table["part"].to_pylist(), edges, [np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(columns, kinds, strict=True)]


def held_by_kind(table: pa.Table, kind: int, *kinds) -> list[np.ndarray]:
    """Columns of a part's replies of one kind, laid end to end."""
    rows = table.filter(pa.compute.equal(table["kind"], kind)) if table.num_rows else table
    return gathered(rows, *kinds)[2]


class Repeats:
    """Rounds of the search; a subclass sets tokens, window, gram and how fragments are extended."""

    tokens = Bytes
    window = 50
    gram = 16
    spread_always = False

    def __init__(self, parts: int, buckets: int, hot: int = HOT_FRAGMENTS):
        self.parts, self.buckets, self.hot = parts, buckets, hot

    # Documents of a part -----------------------------------------------------------------------

    def documents(self, table: pa.Table):
        """(ids, order of each id, bodies, blocks) of up to TOGETHER bytes of documents, or of one longer document."""
        powers, tokens = Powers(), self.tokens()
        for batch in table.select(["doc_id", "body"]).to_batches():
            for a, bodies in slices(batch["body"], TOGETHER):
                ids = batch["doc_id"].slice(a, len(bodies))
                yield ids, pa.compute.fill_null(ids, LAST).to_numpy(), bodies, Blocks(*tokens(bodies), self.window, self.gram, powers)

    def anchors_out(self, table: pa.Table) -> pa.Table:
        """Round 1: each anchor of the part, twice when two of its documents have it."""
        part = table["part"][0].as_py()
        keys, owners, done = [], [], 0
        for ids, _, _, b in self.documents(table):
            keys.append(b.anchor)
            owners.append(b.owner + done)
            done += len(ids)
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        if not len(keys):
            return as_table([])
        order = np.argsort(keys)
        keys, owners = keys[order], owners[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        two = np.minimum.reduceat(owners, first) != np.maximum.reduceat(owners, first)
        keys = np.repeat(keys[first], 1 + two)
        return as_table(dealt(part, 1, self.buckets, keys, (keys >> np.uint64(32)).astype(np.uint32)))

    def anchors_in(self, table: pa.Table) -> pa.Table:
        """To each part, those of its anchors that two documents have (upper halves; a rare chance match only costs work)."""
        bucket = table["bucket"][0].as_py()
        parts, edges, (keys,) = gathered(table, np.uint32)
        seen, n = np.unique(keys, return_counts=True)
        twice = n[np.searchsorted(seen, keys)] > 1
        out = []
        for i, part in enumerate(parts):
            mine = keys[edges[i]:edges[i + 1]][twice[edges[i]:edges[i + 1]]]
            if len(mine):
                out.append(row(part, bucket, 1, np.unique(mine)))
        return as_table(out)

    def fragments_out(self, table: pa.Table, replies: pa.Table) -> pa.Table:
        """Round 2: fragments of repeated anchors with the smallest document of the part."""
        part = self.part_of(table, replies)
        if not table.num_rows or not replies.num_rows:
            return as_table([])
        known = {}
        for bucket, x in zip(replies["bucket"].to_pylist(), replies["x"].to_pylist(), strict=True):
            known[bucket] = np.frombuffer(x, np.uint32).astype(np.uint64)
        table_of = np.sort(np.concatenate([(v << np.uint64(32)) | np.uint64(b) for b, v in known.items()]))
        anchors, frags, docs = [], [], []
        for _, order, _, b in self.documents(table):
            key = (b.anchor & np.uint64(0xFFFFFFFF00000000)) | ((b.anchor & np.uint64(0xFFFFFFFF)) % np.uint64(self.buckets))
            hit = inside(key, table_of) >= 0
            anchors.append(b.anchor[hit])
            frags.append(b.fragment[hit])
            docs.append(order[b.owner[hit]])
        anchors, frags, docs = np.concatenate(anchors), np.concatenate(frags), np.concatenate(docs)
        order = np.lexsort((docs, frags))
        anchors, frags, docs = anchors[order], frags[order], docs[order]
        first = np.concatenate(([True], frags[1:] != frags[:-1])) if len(frags) else np.zeros(0, bool)
        # a copy inside the part still has to hear of the smallest document, which is in the part itself
        return as_table(dealt(part, 2, self.buckets, anchors[first], (anchors[first] >> np.uint64(32)).astype(np.uint32), frags[first], docs[first],
                              np.diff(np.concatenate((np.flatnonzero(first), [len(frags)]))).clip(max=2).astype(np.uint8)))

    def fragments_in(self, table: pa.Table) -> pa.Table:
        """To each part: its fragments that a smaller document has, or that need extending."""
        bucket = table["bucket"][0].as_py()
        parts, edges, (anchors, frags, docs, copies) = gathered(table, np.uint32, np.uint64, np.int64, np.uint8)
        order = np.lexsort((docs, frags, anchors))
        a, f, d = anchors[order], frags[order], docs[order]
        new = np.concatenate(([True], (f[1:] != f[:-1]) | (a[1:] != a[:-1])))
        which = np.cumsum(new) - 1  # number of the distinct fragment
        lowest = d[new]
        group = np.cumsum(np.concatenate(([True], a[new][1:] != a[new][:-1]))) - 1
        many = np.bincount(group)[group]  # distinct fragments under the same anchor
        act = np.where(many < 2, KEEP, np.where(self.spread_always | (many > self.hot), SPREAD, EXTEND)).astype(np.uint8)
        back = np.empty(len(order), np.int64)
        back[order] = which
        low, act = lowest[back], act[back]
        tell = (act != KEEP) | (low < docs) | (copies > 1)
        out = []
        for i, part in enumerate(parts):
            s = slice(edges[i], edges[i + 1])
            t = tell[s]
            if t.any():
                out.append(row(part, bucket, 2, frags[s][t], low[s][t], act[s][t], anchors[s][t]))
        return as_table(out)

    @staticmethod
    def part_of(*tables: pa.Table) -> int:
        return next(t["part"][0].as_py() for t in tables if t.num_rows)

    @staticmethod
    def known_fragments(replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        frags, low, act = held_by_kind(replies, 2, np.uint64, np.int64, np.uint8)
        order = np.argsort(frags)
        return frags[order], low[order], act[order]

    def extend_out(self, table: pa.Table, replies: pa.Table) -> pa.Table:
        """Round 3: what the fragments that differ under a shared anchor consist of."""
        part = self.part_of(table, replies)
        if not table.num_rows or not replies.num_rows:
            return as_table([])
        frags, low, act = self.known_fragments(replies)
        keys, docs, whole = [], [], {}
        for _, order, bodies, b in self.documents(table):
            at = inside(b.fragment, frags)
            mine = np.flatnonzero(at >= 0)
            mine = mine[low[at[mine]] == order[b.owner[mine]]]
            spread = mine[act[at[mine]] == SPREAD]
            keys.append(b.windows(spread)[1])
            docs.append(np.repeat(order[b.owner[spread]], b.stop[spread] - b.first[spread]))
            gather = mine[act[at[mine]] == EXTEND]
            if len(gather):
                whole |= zip(b.fragment[gather].tolist(), zip(b.anchor[gather].tolist(), order[b.owner[gather]].tolist(), self.cut_out(bodies, b, gather), strict=True), strict=True)
        out = []
        keys, docs = np.concatenate(keys), np.concatenate(docs)
        if len(keys):
            order = np.lexsort((docs, keys))
            keys, docs = keys[order], docs[order]
            first = np.concatenate(([True], keys[1:] != keys[:-1]))
            copies = np.diff(np.concatenate((np.flatnonzero(first), [len(keys)]))).clip(max=2).astype(np.uint8)
            out += dealt(part, 3, self.buckets, keys[first], keys[first], docs[first], copies)
        if whole:
            frag = np.fromiter(whole, np.uint64, len(whole))
            anchor, doc = (np.array([v[j] for v in whole.values()], k) for j, k in ((0, np.uint64), (1, np.int64)))
            texts = [v[2] for v in whole.values()]
            to = (anchor & np.uint64(0xFFFFFFFF)) % np.uint64(self.buckets)
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            for bucket in np.unique(to):
                at = np.flatnonzero(to == bucket)
                out.append(row(part, int(bucket), 4, frag[at], doc[at], size[at] | (anchor[at] >> np.uint64(33) << np.uint64(32)).view(np.int64), b"".join(texts[i] for i in at.tolist())))
        return as_table(out)

    def extend_in(self, table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        kind = table["kind"].to_numpy()
        out = []
        spread = table.filter(pa.array(kind == 3))
        if spread.num_rows:
            parts, edges, (keys, docs, copies) = gathered(spread, np.uint64, np.int64, np.uint8)
            order = np.lexsort((docs, keys))
            k = keys[order]
            new = np.concatenate(([True], k[1:] != k[:-1]))
            low = np.empty(len(k), np.int64)
            low[order] = docs[order][new][np.cumsum(new) - 1]
            for i, part in enumerate(parts):
                s = slice(edges[i], edges[i + 1])
                tell = (low[s] < docs[s]) | (copies[s] > 1)
                if tell.any():
                    out.append(row(part, bucket, 3, keys[s][tell], low[s][tell]))
        gather = table.filter(pa.array(kind == 4))
        if gather.num_rows:
            out += self.matched(bucket, gather)
        return as_table(out)

    def cut_out(self, bodies: list[bytes], b: Blocks, which: np.ndarray) -> list[bytes]:
        raise NotImplementedError

    def matched(self, bucket: int, table: pa.Table) -> list[tuple]:
        """Replies to fragments (x), their documents (y), sizes and, above 32 bits, 31 bits of their anchors (z) and texts (w)."""
        raise NotImplementedError

    # Result -------------------------------------------------------------------------------------

    def repeated_windows(self, order: np.ndarray, b: Blocks, frags, low, act, keys, key_low, marked, mark_at, marks) -> np.ndarray:
        """Mask of the windows that a smaller document has too."""
        mark = np.zeros(b.m, bool)
        at = inside(b.fragment, frags)
        held = np.flatnonzero(at >= 0)
        at, order = at[held], order[b.owner]
        earlier = low[at] < order[held]
        whole = held[earlier]
        mark[ranges(b.first[whole], b.stop[whole])] = True
        spread = held[~earlier & (act[at] == SPREAD)]
        place, key = b.windows(spread)
        w = inside(key, keys)
        known = w >= 0
        mark[place[known]] = key_low[w[known]] < np.repeat(order[spread], b.stop[spread] - b.first[spread])[known]
        gather = held[~earlier & (act[at] == EXTEND)]
        got = inside(b.fragment[gather], marked)
        gather, got = gather[got >= 0], got[got >= 0]
        mark[ranges(b.first[gather], b.stop[gather])] = marks[ranges(mark_at[got], mark_at[got] + b.stop[gather] - b.first[gather])]
        return mark

    def finish(self, table: pa.Table, replies: pa.Table) -> pa.Table:
        frags, low, act = self.known_fragments(replies)
        keys, key_low = held_by_kind(replies, 3, np.uint64, np.int64)
        by = np.argsort(keys)
        keys, key_low = keys[by], key_low[by]
        marked, size, marks = held_by_kind(replies, 4, np.uint64, np.int64, np.uint8)
        by = np.argsort(marked)
        marked, mark_at, marks = marked[by], (np.cumsum(size) - size)[by], marks.astype(bool)
        ids, n, gone, starts, ends, spans, kept = [pa.array([], pa.int64())], [], [], [], [], [], []
        for doc_id, order, bodies, b in self.documents(table):
            mark = self.repeated_windows(order, b, frags, low, act, keys, key_low, marked, mark_at, marks)
            mark |= self.repeated_here(b)
            drop = covered(mark, self.window, b.n)
            a, z = runs(drop, b.edges)
            owner = np.searchsorted(b.edges, a, "right") - 1
            ids.append(doc_id)
            n.append(b.sizes)
            gone.append(np.diff(np.concatenate(([0], np.cumsum(drop)))[b.edges]))
            starts.append(a - b.edges[owner])
            ends.append(z - b.edges[owner])
            spans.append(np.bincount(owner, minlength=len(bodies)))
            kept += [self.keep(body, drop[lo:hi] if some else None) for body, lo, hi, some in zip(bodies, b.edges[:-1].tolist(), b.edges[1:].tolist(), spans[-1].tolist(), strict=True)]
        n, gone, starts, ends, spans = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (n, gone, starts, ends, spans))
        offsets = pa.array(np.concatenate(([0], np.cumsum(spans))), pa.int32())
        return pa.table({
            "doc_id": pa.concat_arrays(ids), "n_tokens": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
            "span_starts": pa.ListArray.from_arrays(offsets, pa.array(starts, pa.int64())), "span_ends": pa.ListArray.from_arrays(offsets, pa.array(ends, pa.int64())), "kept": pa.array(kept, pa.binary())})

    def repeated_here(self, b: Blocks) -> np.ndarray:
        """Windows repeated inside the document that count as repeats; none by default."""
        return np.zeros(b.m, bool)

    def keep(self, body: bytes, drop: np.ndarray | None) -> bytes:
        """What is left of a body without the tokens of ``drop`` (None: all stay)."""
        raise NotImplementedError


def find_repeats(docs: DataFrame, kind: type[Repeats], doc_id: str = "doc_id", text: str = "text", part_bytes: int | None = None) -> DataFrame:
    """doc_id, n_tokens, n_removed, span_starts, span_ends, kept for every row of ``docs``.

    ``part_bytes`` is the text a task holds at once; by default it grows with
    the square root of all texts from 2 to 64 MB, so that a part still sends
    several keys to each bucket at any size.
    """
    total = text_bytes(docs, text)
    size = part_bytes or min(64 << 20, max(2 << 20, int(total**0.5) * 128))
    search = kind(max(1, total // size), max(1, total // (4 * size)))
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    base = base.select(F.pmod(F.xxhash64("doc_id"), F.lit(search.parts)).cast("int").alias("part"), "doc_id", "body")
    by_part = base.groupBy("part")
    r1 = by_part.applyInArrow(lambda t: search.anchors_out(t), WIRE).groupBy("bucket").applyInArrow(lambda t: search.anchors_in(t), WIRE)
    r2 = by_part.cogroup(r1.groupBy("part")).applyInArrow(lambda t, r: search.fragments_out(t, r), WIRE).groupBy("bucket").applyInArrow(lambda t: search.fragments_in(t), WIRE)
    r3 = by_part.cogroup(r2.groupBy("part")).applyInArrow(lambda t, r: search.extend_out(t, r), WIRE).groupBy("bucket").applyInArrow(lambda t: search.extend_in(t), WIRE)
    out = "doc_id long, n_tokens long, n_removed long, span_starts array<long>, span_ends array<long>, kept binary"
    return by_part.cogroup(r2.unionAll(r3).groupBy("part")).applyInArrow(lambda t, r: search.finish(t, r), out)
