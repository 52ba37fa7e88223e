"""Best-fit packing, conversation prefix trie and embedding whitening against brute force and on edge rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing, prefixtrie, whitening
from tallyspark.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

# -- packing ----------------------------------------------------------------------------------------

HARD = ["it's 'S I'LL don't,", "a.,b., ,. x.. 3., 4.5", "Σίσυφος ΟΔΟΣ. É é ﬁ", "a b c\x0bd\x0ce\x1cf\x85g", "x<|endoftext|>y <|startoftext|> <|endoftext <|",
        "ÑANDÚ, ñandú. 你好，世界 ١٢٣ 12345", "\n\t ", "word. Word, WORD., wOrd'll. ýÿ ßÄö÷ İıſŉ e\u0301 \u0301 a\xa0b\u2003c\u3000d\ufeffe", "😀😀 🇩🇪 a🙂b"]


def expected_pieces(docs, length):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    out = []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out += [(doc_id, n, a, ids[a:a + length]) for n, a in enumerate(range(0, len(ids), length))]
    return out


def check_layout(rows, capacity, max_docs=None, max_cost=None):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and (not max_docs or len(parts) <= max_docs) and (not max_cost or sum(n * n for _, n in parts) <= max_cost)
    return len(held)


@pytest.mark.parametrize("seen,slice_", [(packing.SEEN, packing.SLICE), (3, 40)])
def test_pieces_equal_the_tokenizer(spark, monkeypatch, seen, slice_):
    monkeypatch.setattr(packing, "SEEN", seen)
    monkeypatch.setattr(packing, "SLICE", slice_)
    docs = [(i, t) for i, t in enumerate(HARD)] + [(90, None), (91, ""), (92, "same"), (92, "same"), (None, "no id"), (93, "long Text, " * 400), (94, "x" * 3000)]
    rng = random.Random(5)
    docs += [(100 + i, "".join(rng.choice("aB ,.'\n<|>é1Ώ") for _ in range(rng.randint(0, 200)))) for i in range(60)]
    frame = spark.createDataFrame([(t, i, 7, "clash") for i, t in docs], "text string, doc_id long, length long, ids string")
    got = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in packing.pieces(frame, packing.default_tokenizer(), 64).collect()]
    assert sorted(got, key=repr) == sorted(expected_pieces(docs, 64), key=repr)


def test_packed_sequences_hold_every_piece(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 50)
    docs = [(i, "word " * (i * 7 % 100)) for i in range(150)] + [(7, "same row")] * 30
    cut_up = packing.pieces(spark.createDataFrame(docs, "doc_id long, text string"), packing.default_tokenizer(), 64)
    packed = packing.place(cut_up, 64).persist()
    rows = packed.collect()
    assert len(rows) == len(expected_pieces(docs, 64))
    n = check_layout(rows, 64)
    assert n <= 1.1 * sum(r.length for r in rows) / 64 + 5
    by_id = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(packed).collect()}
    assert len(by_id) == n
    for r in rows:
        assert by_id[r.sequence_id][r.offset:r.offset + r.length] == np.frombuffer(r.ids, "<u4").tolist()
    packed.unpersist()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_binds(spark, rule):
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, rng.randint(1, 100)) for i in range(300)], "doc_id long, length long")
    got = packing.place(rows, 100, max_docs=3, max_cost=10_000, rule=rule).collect()
    assert len(got) == 300
    check_layout(got, 100, 3, 10_000)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([5]), (4, 4, 100))


def test_best_fit_by_hand():
    sequence, offset = packing.best_fit(np.array([6, 5, 4, 3, 1]), (10, 10, 100))
    assert sequence.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]
    # the norm prefers the fuller of two that fit, the dot-product the emptier
    assert packing.best_fit(np.array([8, 5, 2]), (10, 10, 100), rule="norm")[0].tolist() == [0, 1, 0]
    assert packing.best_fit(np.array([8, 5, 2]), (10, 10, 100), rule="dot")[0].tolist() == [0, 1, 1]


def test_packing_query(spark):
    rows = QUERIES["op11_best_fit_packing"](spark, SF_SMALL).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, a, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, n, a, ids in expected_pieces(docs, 2048)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert check_layout(rows, 2048) <= sum(r.length for r in rows) / 2048 * 1.01 + 2


def test_packing_of_nothing(spark):
    assert packing.place(packing.pieces(spark.createDataFrame([], "doc_id long, text string"), packing.default_tokenizer())).count() == 0


# -- prefix trie ------------------------------------------------------------------------------------

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_brute(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            conv[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}\n{text}".encode()).digest(), (role, text)))
    conv = {c: [t[-1] for t in sorted(v)] for c, v in conv.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full = tuple(conv.get(base, [])[:h] + turns[h:])
        ends[full].append(c)
        for d in range(len(full) + 1):
            members[full[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += p not in kids
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], digest(ends.get(p, []))) for p, m in members.items()], key=repr)


def random_conversations(seed, n=130):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 200), n):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([turn, turn, None, 1]), rng.choice(["user", "user", "assistant", None]), rng.choice(["hi", "hi there", "ho", "", None, " a\tb\x0bc  d "])))
    # one long conversation, its copy in another family, and a proper prefix of them
    for c, length in ((405, 57), (445, 57), (485, 20)):
        rows += [(c, t, "user", f"turn {t}") for t in range(length)]
    return rows + [(None, 0, "user", "lost")] + [rows[0]] * 3


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 4), (3, 1)])
def test_trie_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    rows = random_conversations(seed)
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, i int")
    got = prefixtrie.prefix_trie(frame).select(*NODE).collect()
    assert sorted([tuple(r) for r in got], key=repr) == trie_brute(rows)


def test_trie_of_copies_and_of_nothing(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 2000, 20) for t in range(3)]
    got = prefixtrie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).select(*NODE).collect()
    assert sorted([tuple(r) for r in got], key=repr) == trie_brute(rows)
    assert prefixtrie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_words_of_arrow_texts():
    import pyarrow as pa

    texts = ["", " ", "a", " a b ", "a b c", "é\x0bü\x0c", "", "x" * 50]
    want = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    assert prefixtrie.count_words(pa.array(texts)).tolist() == want
    assert prefixtrie.count_words(pa.array(["zz zz", *texts]).slice(1)).tolist() == want
    assert prefixtrie.count_words(pa.array([""])).tolist() == [0]


# -- whitening --------------------------------------------------------------------------------------


def whitening_brute(vectors):
    """Exact covariance by fractions, then eigh."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(r[i] for r in x) for i in range(d)]
    cov = np.array([[float(Fraction(n * sum(r[i] * r[j] for r in x) - total[i] * total[j], n * n)) for j in range(d)] for i in range(d)])
    value, vector = np.linalg.eigh(cov)
    order = np.argsort(-value)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, total)) for r in x]
    return np.array(x, float), total, deviation, cov, value[order], vector[:, order]


@pytest.mark.parametrize("scale,chunk", [(1.0, 1 << 16), (1.0, 64), (1e6, 128), (1e13, 1 << 16)])
def test_whitening_brute_force(spark, monkeypatch, scale, chunk):
    monkeypatch.setattr(whitening, "CHUNK", chunk)
    rng = np.random.default_rng(7)
    vectors = (rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) * scale).tolist() + [[1.0, 2.0, 3.0, 4.0, 5.0]] * 40
    frame = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, component int").repartition(3)
    out = whitening.whiten(frame, components=4).persist()
    got = out.toPandas()
    x, total, deviation, cov, value, vector = whitening_brute(vectors)
    n = len(vectors)
    assert len(got) == n * 4 and set(got.n) == {n}
    assert [d if d < 1 << 63 else None for d in deviation] == [r.deviation for r in out.where("component = 1").orderBy("vec_id").collect()]
    out.unpersist()
    assert np.allclose(got.groupby("component").explained.first(), value[:4] / np.trace(cov), rtol=1e-9)
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    expected = (x - np.array(total) / n) @ vector[:, :4] / np.sqrt(value[:4])
    sign = np.sign((w * expected).sum(0))
    assert np.allclose(w, expected * sign, atol=1e-6)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_products_are_exact():
    rng = random.Random(1)
    for bits in ([1, 3, 0, 7], [63, 1, 64, 10]):
        y = np.array([[rng.getrandbits(b) if b else 0 for b in bits] for _ in range(131)], np.uint64)
        got = whitening.products(y, bits)
        for i in range(4):
            for j in range(i, 4):
                assert got[i, j] == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))


def test_whitening_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, 3.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [1.0, -inf]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [1e300, -1e300])]
    got = whitening.whiten(spark.createDataFrame(rows[:-1], "vec_id long, embedding array<float>")).toPandas()
    assert len(got) == 6 and set(got.n) == {3} and got.vec_id.isna().sum() == 2
    assert got[got.component == 2].whitened.isna().all() and (got[got.component == 2].explained == 0).all()  # three points on a line
    assert got[got.component == 1].whitened.notna().all() and got.identity_error[0] < 1e-9
    far = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert len(far) == 8 and far.deviation.isna().all()
    one = whitening.whiten(spark.createDataFrame(rows[:2], "vec_id long, embedding array<double>")).toPandas()
    assert one.whitened.isna().all() and (one.explained == 0).all() and (one.identity_error == 0).all() and (one.deviation == 0).all()
    assert whitening.whiten(spark.createDataFrame([(3, None)], "vec_id long, embedding array<double>")).count() == 0


def test_whitening_query(spark):
    got = QUERIES["op13_embedding_whitening"](spark, SF_SMALL).toPandas()
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas().embedding.tolist()
    assert len(got) == 32 * len(vectors) and (got.identity_error < 1e-9).all()
