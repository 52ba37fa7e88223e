"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Inputs per word: an embedding of the word (words of the training sample, one
shared entry for all others) and the mean embedding of its character
trigrams.  Both start with the log-odds seen in the sample in their first
dimension.  Windows of 48 words, every 24 words, cover the whole text; a window
is read in both directions, pooled by attention, and scored; the document
has the score of its highest window.  Training is plain numpy on the driver over
at most ``SAMPLE`` labelled texts of each class (texts of up to ``SAMPLE_CHARS``
characters; a documented bound of the fit alone); scoring runs in tasks over
every whole text.

Edge cases: NULL and empty texts are one empty window; texts of any length are
scored whole; ties and repeated rows score alike; without labelled rows of both
classes every score is that of an untrained network; empty tables give empty
results; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.llm.common import table

WINDOW, STRIDE = 48, 24
HIDDEN, DIM = 8, 8
SAMPLE, SAMPLE_CHARS, VOCAB = 1200, 20_000, 20_000
TRIGRAMS = 1 << 12
WARM = 2  # epochs on windows chosen by log-odds
RARE, EVIDENCE = 8, 30  # words of fewer sample texts share one entry; texts at which log-odds count half
BATCH_WORDS = 400_000
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers of all words end to end, and where each word's begin."""
    raw = np.frombuffer(b"\0" + b"\0".join(w.encode() for w in words) + b"\0", np.uint8).astype(np.uint32)
    keep = raw[1:-1] != 0
    number = ((raw[:-2] * 961 + raw[1:-1] * 31 + raw[2:]) * 2654435761 >> 12) % TRIGRAMS
    size = np.array([len(w.encode()) for w in words], np.int64)
    return number[keep], np.concatenate(([0], np.cumsum(size)[:-1]))


def summed(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` added up by row number."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(at):
        order = np.argsort(at, kind="stable")
        begin = np.flatnonzero(np.concatenate(([True], at[order][1:] != at[order][:-1])))
        out[at[order][begin]] = np.add.reduceat(values[order], begin, axis=0)
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def log_odds(pos, neg, n_pos, n_neg):
    """Log-odds, drawn to 0 where there is little evidence."""
    return (np.log((pos + 1) / (n_pos + 2)) - np.log((neg + 1) / (n_neg + 2))) * (pos + neg) / (pos + neg + EVIDENCE)


class Network:
    """Parameters are float32 arrays in ``p``; direction 0 reads forwards, 1 backwards."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary  # 0: padding, 1: other words
        small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        self.p = {"E": small(len(vocabulary) + 2, DIM), "C": small(TRIGRAMS, DIM), "A": small(2 * HIDDEN, HIDDEN), "v": small(HIDDEN), "u": small(2 * HIDDEN), "b": np.zeros(1, np.float32)}
        for d in (0, 1):
            self.p |= {f"W{d}": small(2 * DIM, 3 * HIDDEN) * 3, f"B{d}": np.zeros(3 * HIDDEN, np.float32), f"U{d}": small(HIDDEN, 3 * HIDDEN) * 3}
        self.p["E"][0] = 0

    # Inputs ----------------------------------------------------------------------------------

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input vector of each distinct word."""
        ids = np.array([self.vocabulary.get(w, 1) for w in words], np.int64)
        at, begin = trigrams(words)
        count = np.diff(np.concatenate((begin, [len(at)])))
        chars = np.add.reduceat(self.p["C"][at], begin, axis=0) / count[:, None]
        return np.concatenate((self.p["E"][ids], chars), axis=1).astype(np.float32)

    def gates(self, x: np.ndarray) -> list[np.ndarray]:
        return [x @ self.p[f"W{d}"] + self.p[f"B{d}"] for d in (0, 1)]

    # Forward over windows of word rows: ids (n, WINDOW), -1 where there is none ----------------

    def run(self, gates: list[np.ndarray], ids: np.ndarray, keep: bool = False):
        n, length = ids.shape
        live = (ids >= 0).astype(np.float32)
        states, traces = [], []
        for d in (0, 1):
            h = np.zeros((n, HIDDEN), gates[d].dtype)
            out = np.zeros((n, length, HIDDEN), gates[d].dtype)
            trace = {}
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                g = gates[d][ids[:, t]]
                gh = h @ self.p[f"U{d}"]
                zr = sigmoid(g[:, :2 * HIDDEN] + gh[:, :2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN:] + r * gh[:, 2 * HIDDEN:])
                m = live[:, t, None]
                new = h + m * (1 - z) * (c - h)
                if keep:
                    trace[t] = (h, z, r, c, gh[:, 2 * HIDDEN:], m)
                h = new
                out[:, t] = h
            states.append(out)
            traces.append(trace)
        both = np.concatenate(states, axis=2)
        view = np.tanh(both @ self.p["A"])
        weight = np.where(live > 0, np.exp(np.clip(view @ self.p["v"], -30, 30)), 0)
        weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
        pooled = (weight[:, None, :] @ both)[:, 0]
        logit = pooled @ self.p["u"] + self.p["b"][0]
        return (logit, both, view, weight, pooled, traces) if keep else logit

    def gradients(self, x: np.ndarray, ids: np.ndarray, y: np.ndarray):
        """Gradients of the mean log loss; ``x`` are the input vectors that ``ids`` points at. Also that of ``x``."""
        gates = self.gates(x)
        logit, both, view, weight, pooled, traces = self.run(gates, ids, keep=True)
        n = len(y)
        d_logit = ((sigmoid(logit) - y) / n).astype(x.dtype)
        g = {"u": pooled.T @ d_logit, "b": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * self.p["u"]
        d_both = weight[:, :, None] * d_pooled[:, None, :]
        d_weight = (both @ d_pooled[:, :, None])[:, :, 0]
        d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        g["v"] = np.einsum("nt,nth->h", d_score, view)
        d_view = d_score[:, :, None] * self.p["v"] * (1 - view**2)
        g["A"] = np.einsum("nti,nth->ih", both, d_view)
        d_both = d_both + d_view @ self.p["A"].T
        dx = np.zeros_like(x)
        for d in (0, 1):
            u = self.p[f"U{d}"]
            d_at, d_u = np.zeros((n, ids.shape[1], 3 * HIDDEN), x.dtype), np.zeros_like(u)
            dh = np.zeros((n, HIDDEN), x.dtype)
            length = ids.shape[1]
            for t in range(length - 1, -1, -1) if d == 0 else range(length):
                h, z, r, c, ghn, m = traces[d][t]
                dh = dh + d_both[:, t, d * HIDDEN:(d + 1) * HIDDEN]
                step = dh * m
                dc = step * (1 - z) * (1 - c**2)
                dz = -step * (c - h) * z * (1 - z)
                dr = dc * ghn * r * (1 - r)
                d_gh = np.concatenate((dz, dr, dc * r), axis=1)
                d_at[:, t] = np.concatenate((dz, dr, dc), axis=1)
                d_u += h.T @ d_gh
                dh = dh * (1 - m) + step * z + d_gh @ u.T
            d_gates = summed(d_at[ids >= 0], ids[ids >= 0], len(x))
            g[f"U{d}"], g[f"W{d}"], g[f"B{d}"] = d_u, x.T @ d_gates, d_gates.sum(0)
            dx += d_gates @ self.p[f"W{d}"].T
        return g, dx, logit


def windows_of(n: int) -> range:
    """First words of the windows of a text of n words."""
    return range(0, max(n - (WINDOW - STRIDE), 1), STRIDE)


def window_matrix(rows: np.ndarray, starts: list[int], ends: list[int]) -> np.ndarray:
    """Word rows of windows given by their first word and the end of their text."""
    at = np.array(starts, np.int64)[:, None] + np.arange(WINDOW)
    inside = at < np.array(ends, np.int64)[:, None]
    return np.where(inside, rows[np.minimum(at, max(len(rows) - 1, 0))] if len(rows) else -1, -1)


def train(texts: list[str], labels: list[int], epochs: int = 4, batch: int = 128, rate: float = 0.02, seed: int = 5) -> Network:
    """Fit on texts: of each, the window richest in words that speak for its class of interest, and of clean texts one more."""
    rng = np.random.default_rng(seed)
    docs = [words_of(t) for t in texts]
    y = np.array(labels, np.float32)
    pos, neg = {}, {}
    for words, label in zip(docs, labels, strict=True):
        side = pos if label else neg
        for w in set(words):
            side[w] = side.get(w, 0) + 1
    total = {w: pos.get(w, 0) + neg.get(w, 0) for w in pos.keys() | neg.keys()}
    vocabulary = {w: i + 2 for i, w in enumerate(sorted((w for w in total if total[w] >= RARE), key=lambda w: (-total[w], w))[:VOCAB])}
    net = Network(vocabulary, seed)
    n_pos, n_neg = max(y.sum(), 1), max(len(y) - y.sum(), 1)
    odds = {w: float(log_odds(pos.get(w, 0), neg.get(w, 0), n_pos, n_neg)) for w in vocabulary}
    for w, i in vocabulary.items():
        net.p["E"][i, 0] = np.clip(odds[w] / 2, -2, 3)
    if not total or y.min() == y.max():
        return net
    known = sorted(total)
    at, begin = trigrams(known)
    size = np.diff(np.concatenate((begin, [len(at)])))
    per = [np.bincount(at, np.repeat([side.get(w, 0) for w in known], size), TRIGRAMS) for side in (pos, neg)]
    net.p["C"][:, 0] = np.clip(log_odds(per[0], per[1], per[0].sum(), per[1].sum()), -2, 3)
    spans = [windows_of(len(words)) for words in docs]
    worth = [[max((odds.get(w, 0) for w in words[s:s + WINDOW]), default=0) for s in at] for words, at in zip(docs, spans, strict=True)]
    m1, m2, step = {}, {}, 0
    for epoch in range(epochs):
        if epoch >= WARM:  # from now on the window that the network itself ranks first
            flat = Scorer(net).windows(docs)
            edge = np.cumsum([0, *map(len, spans)])
            worth = [flat[edge[i]:edge[i + 1]] for i in range(len(docs))]
        chosen, target = [], []
        for words, label, value, at in zip(docs, labels, worth, spans, strict=True):
            picks = [int(np.argmax(value))] + ([] if label else [int(rng.integers(len(value)))])
            chosen += [words[at[k]:at[k] + WINDOW] for k in picks]
            target += [label] * len(picks)
        y = np.array(target, np.float32)
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            picked = order[lo:lo + batch]
            names = sorted({w for i in picked for w in chosen[i]}) or ["·"]
            number = {w: k for k, w in enumerate(names)}
            ids = np.full((len(picked), WINDOW), -1, np.int64)
            for k, i in enumerate(picked):
                ids[k, :len(chosen[i])] = [number[w] for w in chosen[i]]
            x = net.inputs(names)
            g, dx, _ = net.gradients(x, ids, y[picked])
            g["E"] = summed(dx[:, :DIM], np.array([vocabulary.get(w, 1) for w in names]), len(net.p["E"]))
            at, begin = trigrams(names)
            size = np.diff(np.concatenate((begin, [len(at)])))
            g["C"] = summed(np.repeat(dx[:, DIM:] / size[:, None], size, axis=0), at, TRIGRAMS)
            step += 1
            for k, v in g.items():
                m1[k] = 0.9 * m1.get(k, 0) + 0.1 * v
                m2[k] = 0.999 * m2.get(k, 0) + 0.001 * v**2
                net.p[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


class Scorer:
    """Scores of texts; gate inputs of distinct words are kept between texts up to a bound."""

    def __init__(self, net: Network, keep: int = 200_000):
        self.net, self.keep, self.number = net, keep, {}
        self.gates = [np.zeros((0, 3 * HIDDEN), np.float32)] * 2

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.number) > self.keep:
            self.number, self.gates = {}, [g[:0] for g in self.gates]
        new = list({w: None for w in words if w not in self.number})
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.gates = [np.concatenate(pair) for pair in zip(self.gates, self.net.gates(self.net.inputs(new)), strict=True)]
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Texts are taken together up to ``BATCH_WORDS`` words, long ones alone."""
        out, group, size = [], [], 0
        for text in texts:
            words = words_of(text)
            if group and size + len(words) > BATCH_WORDS:
                out.append(self.group(group))
                group, size = [], 0
            group.append(words)
            size += len(words)
        if group:
            out.append(self.group(group))
        return np.concatenate(out) if out else np.zeros(0)

    def group(self, docs: list[list[str]]) -> np.ndarray:
        size = [len(windows_of(len(d))) for d in docs]
        return sigmoid(np.maximum.reduceat(self.windows(docs), np.cumsum([0, *size[:-1]])))

    def windows(self, docs: list[list[str]]) -> np.ndarray:
        """Logits of all windows of all texts, in order."""
        rows = self.rows([w for d in docs for w in d])
        starts, ends, at = [], [], 0
        for d in docs:
            w = windows_of(len(d))
            starts += [at + s for s in w]
            ends += [at + len(d)] * len(w)
            at += len(d)
        gates = self.gates if len(self.gates[0]) else [np.zeros((1, 3 * HIDDEN), np.float32)] * 2
        return np.concatenate([self.net.run(gates, window_matrix(rows, starts[lo:lo + 4096], ends[lo:lo + 4096])) for lo in range(0, len(starts), 4096)])


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Network:
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    ranked = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    picked = F.broadcast(ranked[0].unionAll(ranked[1]))  # at most 2 * sample rows of two numbers
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.char_length("text") <= SAMPLE_CHARS).join(picked, "doc_id").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.text))
    return train([r.text for r in rows], [int(r.label) for r in rows])


def score(docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    def run(batches):
        scorer = Scorer(net)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scorer(batch["text"].to_pylist()), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
