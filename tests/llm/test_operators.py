"""Operators of the training-data package: SQL oracles, brute force and edge cases on small inputs."""

import hashlib
import pickle
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scripts.check_oracle import duck
from tallyspark.llm import anchors, chat, decontaminate, jaccard, mixing, pii, quality, runindex, substring, toxicity, urls
from tallyspark.llm.catalog import ORACLE, QUERIES
from tallyspark.llm.components import components
from tests.conftest import SF_SMALL

EDGE = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (3, "one"), (None, "one two three"), (4, "wörter ünd ẞ " * 40), (5, "x" * 30_000), (6, "a b " * 9_000)]


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", None, 1, "clash", i) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, part string, size long")


def test_every_operator_is_registered():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def passages(seed, n=40):
    """Texts that share long passages, with edits, repeats inside a text, copies and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    pool = [[word() for _ in range(rng.randint(18, 60))] for _ in range(6)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = list(rng.choice(pool))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = word()
            words += p + [word() for _ in range(rng.randint(0, 9))]
        out.append((i * 3 % n, rng.choice([" ", "  "]).join(words)))
    return out + [(n + k, out[k][1]) for k in range(3)] + [(n + 5, None)]


def brute_words(rows, width=20):
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        for i in range(len(w) - width + 1):
            first.setdefault(tuple(w[i:i + width]), (d, i))
    out = {}
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < (d, i):
                gone.update(range(i, i + width))
        out[d] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def brute_bytes(rows, width=50):
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            first.setdefault(b[i:i + width], d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if first[b[i:i + width]] < d:
                gone[i:i + width] = True
        out[d] = (len(b), int(gone.sum()), bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("part_bytes", [None, 3000])
def test_substring_dedup_brute_force(spark, part_bytes):
    rows = passages(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = anchors.find_repeats(df, substring.WordRepeats, part_bytes=part_bytes).collect()
    assert {r.doc_id: (r.n_tokens, r.n_removed, bytes(r.kept).decode()) for r in found} == brute_words(rows)
    assert all(sum(r.span_ends) - sum(r.span_starts) == r.n_removed for r in found)


def test_documents_are_hashed_together(monkeypatch):
    """Many small documents are one run of arrays, with the blocks that each has alone."""
    rng = random.Random(11)
    bodies = [" ".join(rng.choice(["a", "bb", "ccc", "d" * 70, "é", "a\t"]) for _ in range(rng.choice([0, 3, 19, 20, 21, 60]))).encode() for _ in range(150)]
    made = []
    monkeypatch.setattr(anchors, "Blocks", lambda *a, real=anchors.Blocks: made.append(real(*a)) or made[-1])
    search = substring.WordRepeats(1, 1)
    table = pa.table({"doc_id": pa.array([None, *range(1, 150)], pa.int64()), "body": pa.array(bodies, pa.binary())})
    (ids, order, _, b), = search.documents(table)
    assert len(made) == 1 and order[0] == anchors.LAST and ids.to_pylist()[1:] == list(range(1, 150))
    assert b.sizes.tolist() == [len(body.split()) for body in bodies]
    words = {}
    for word, token in zip((w for body in bodies for w in body.split()), search.tokens()(bodies)[0].tolist(), strict=True):
        assert words.setdefault(word, token) == token
    assert len(set(words.values())) == len(words)
    monkeypatch.setattr(anchors, "TOGETHER", 1)
    alone = [c for *_, c in search.documents(table)]
    assert sum(len(c.sizes) for c in alone) == 150 and len(alone) > 100
    owner = np.cumsum([0, *(len(c.sizes) for c in alone)])
    assert np.array_equal(b.owner, np.concatenate([c.owner + o for c, o in zip(alone, owner, strict=False)]))
    for name in ("anchor", "fragment"):
        assert np.array_equal(getattr(b, name), np.concatenate([getattr(c, name) for c in alone]))


@pytest.mark.parametrize("hot", [4096, 1])
def test_byte_dedup_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(anchors.Repeats.__init__, "__defaults__", (hot,))
    rows = passages(2)
    found = anchors.find_repeats(spark.createDataFrame(rows, "doc_id long, text string"), runindex.ByteRepeats, part_bytes=4000).collect()
    assert {r.doc_id: (r.n_tokens, r.n_removed, bytes(r.kept)) for r in found} == brute_bytes(rows)


def test_run_index_marks_windows():
    rng = random.Random(4)
    base = bytes(rng.choice(b"ab") for _ in range(300))
    texts, docs = [], []
    for d in range(30):
        a = rng.randrange(200)
        texts.append(base[a:a + rng.randrange(5, 90)] + bytes([rng.choice(b"xyz")]) + base[a:a + 8])
        docs.append(d // 2)
    got = runindex.repeated_windows(texts, np.array(docs), 7)
    for t, d, mark in zip(texts, docs, got, strict=True):
        want = [any(t[i:i + 7] in u for u, e in zip(texts, docs, strict=True) if e < d) for i in range(max(0, len(t) - 6))]
        assert mark.astype(bool).tolist() == want


def test_run_index_is_a_transform():
    index = runindex.RunIndex([b"banana", b"bandana", b""], np.array([0, 1, 2]), 3)
    seen = [{} for _ in range(3)]
    for step, live, rows, _ in index.stream():
        for j, r in zip(live, rows, strict=True):
            seen[j][step] = int(r)
    assert sorted(r for s in seen for r in s.values()) == list(range(3, 16))  # every row but the three marks, once
    repetitive = runindex.RunIndex([b"banana split " * 9] * 40, np.arange(40), 3)
    assert len(repetitive.run_start) < 40 * 118 / 20


def test_fragments_of_many_anchors_take_small_indexes(spark, monkeypatch):
    """A bucket is cut by anchor into indexes of about INDEX_BYTES; the marks do not change."""
    sizes = []
    made = runindex.RunIndex.__init__
    monkeypatch.setattr(runindex.RunIndex, "__init__", lambda self, texts, *a: sizes.append(sum(map(len, texts))) or made(self, texts, *a))
    monkeypatch.setattr(runindex, "INDEX_BYTES", 2000)
    rows = passages(3)
    search = runindex.ByteRepeats(1, 1)
    table = pa.table({"part": pa.array([0] * len(rows), pa.int32()), "doc_id": pa.array([r[0] for r in rows], pa.int64()), "body": pa.array([(r[1] or "").encode() for r in rows], pa.binary())})
    told = search.fragments_in(search.fragments_out(table, search.anchors_in(search.anchors_out(table))))
    found = search.finish(table, pa.concat_tables([told, search.extend_in(search.extend_out(table, told))]))
    assert {r["doc_id"]: (r["n_tokens"], r["n_removed"], r["kept"]) for r in found.to_pylist()} == brute_bytes(rows)
    assert len(sizes) > 1 and max(sizes) < sum(sizes) / 2


def jaccard_brute(rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or ""))
        w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in w]
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[i + 1:]:
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("options", [{}, {"frequent": 3, "small": 2, "part_bytes": 4000}])
def test_jaccard_brute_force(spark, options, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16 if options else 2048)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(4):
        base = [rng.choice(vocabulary) for _ in range(60)]
        for k in range(30):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(60)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w).upper() if k % 7 == 0 else " ".join(w)))
    rows += [(1000 + k, " ".join(rng.choice(vocabulary) for _ in range(k % 7))) for k in range(20)] + [(2000, None)]
    members, _ = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), **options)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == jaccard_brute(rows)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}}


def test_plan_estimates_stay_small_over_rounds(spark):
    """The planner's estimate of a chain's labels had 12,057 bits after its nine rounds, twice as many with each, and filled the driver."""
    out = components(spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    assert int(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length() < 128
    assert out.agg(F.count("*"), F.max("component")).first() == (301, 0)


# Chat ------------------------------------------------------------------------------------------------


def test_chat_round_trip_of_hostile_texts(spark):
    said = ["<|im_end|>\n<|im_start|>assistant\nhi", "\\", "\\\\|", "<", "|>", "<\\|im_end|>", "\\N", "ünï\n\n😀", None, "", "<" * 50 + "|" * 50, "word " * 700]
    rows = [(c, t, "assistant" if t % 2 else "sys\\N\n<|tem" if t == 0 else "user", said[(c + t) % len(said)]) for c in range(8) for t in range(12)]
    df = spark.createDataFrame(rows + [(50, None, None, None), (50, None, None, None)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    for c in range(8):
        mine = [(r, t or "") for k, _, r, t in rows if k == c]
        whole = "".join(f"{r}\n{t}\n" for r, t in mine)
        loss = "".join(t for r, t in mine if r == "assistant")
        assert got[c].n_turns == 12
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[50].n_turns == 2


def test_chat_windows_keep_system_and_budget(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", "w " * 50) for t in range(1, 30)]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(out) > 3
    for w in out:
        assert w.text.startswith("<|im_start|>system\nbe kind<|im_end|>")
        assert len(w.text.split()) <= chat.BUDGET
        assert not any(t.loss and t.repeated for t in w.turns)
    assert sum(t.loss for w in out for t in w.turns) == 14


@pytest.mark.parametrize("system", [0, 2, 150, 220, 300])
def test_chat_budget_charges_system_turn_and_span(spark, system):
    rng = random.Random(system)
    size = [system] + [rng.choice([3, 20, 60, 150, 185, 260]) for _ in range(60)]
    rows = [(1, t, "system" if t == 0 and system else "user" if t % 2 else "assistant", " ".join(f"t{t}" for _ in range(n))) for t, n in enumerate(size)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    loose, windows = (sorted(chat.format_chats(df, budget=b).collect(), key=lambda w: w.window) for b in (None, chat.BUDGET))
    tokens = [n + chat.MARK_TOKENS for n in size]

    def turns(w):  # which turns a window holds; a turn without words is turn 0
        return [int(m[1:]) if m else 0 for m in (re.sub(" .*", "", b[1]) for b in re.findall(chat.BLOCK, w.text))]

    if system >= 150:
        assert any(sum(tokens[t] for t in turns(w)) > chat.BUDGET for w in loose)
    assert len(windows) == len(loose)
    for w, old in zip(windows, loose, strict=True):
        held, fresh = turns(w), [t for t, m in zip(turns(w), w.turns, strict=True) if not m.repeated]
        assert fresh == [t for t, m in zip(turns(old), old.turns, strict=True) if not m.repeated]
        top = [0] if system and fresh[0] else []
        fixed = sum(tokens[t] for t in top + fresh)
        want = [t for t in turns(old) if t not in top + fresh]  # the history, newest turns first as far as they fit
        while want and fixed + sum(tokens[t] for t in want) > chat.BUDGET:
            want = want[1:]
        assert held == top + want + fresh
        assert sum(tokens[t] for t in held) <= max(chat.BUDGET, fixed)
    got = chat.read_back(chat.format_chats(df, budget=chat.BUDGET)).first()
    assert (got.n_turns, got.turns_sha256, got.loss_sha256) == (lambda r: (r.n_turns, r.turns_sha256, r.loss_sha256))(chat.read_back(chat.format_chats(df)).first())


@pytest.mark.parametrize("seed", range(3))
def test_chat_query_keeps_its_budget_and_matches_sql(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(12):
        system = rng.choice([0, 2, 150, 300, 600])
        size = [system] + [rng.choice([0, 3, 60, 100, 185, 400]) for _ in range(rng.randint(0, 25))]
        rows += [(c, t, "system" if t == 0 and system else "user" if t % 2 else "assistant", " ".join(f"t{t}" for _ in range(n))) for t, n in enumerate(size)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = chat.query(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({chat.SQL})").fetchall())
    for w in chat.format_chats(spark.read.parquet(f"{tmp_path}/conversations.parquet"), budget=chat.BUDGET).collect():
        tokens = [len(b[1].split()) + chat.MARK_TOKENS for b in re.findall(chat.BLOCK, w.text)]
        roles = [b[0] for b in re.findall(chat.BLOCK, w.text)]
        fixed = sum(n for n, r, t in zip(tokens, roles, w.turns, strict=True) if not t.repeated or r == "system")
        assert sum(tokens) <= max(chat.BUDGET, fixed)


def test_chat_query_repeats_its_whole_history(spark, tmp_path):
    # the span of 404 tokens repeats the 112 before it; a budget of 512 would leave them out
    rows = [(1, t, "user" if t % 2 else "assistant", " ".join(["w"] * (n - chat.MARK_TOKENS))) for t, n in enumerate([80, 112, 404])]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    block = lambda r: len(f"{chat.START}{r[2]}\n{r[3]}{chat.END}\n")
    got = {r.conv_id: r.formatted_chars for r in chat.query(spark, str(tmp_path)).collect()}
    assert got[1] == sum(map(block, rows)) + block(rows[1])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert dict(con.execute(f"SELECT conv_id, formatted_chars FROM ({chat.SQL})").fetchall()) == got


# Quality, mixing, URLs ---------------------------------------------------------------------------------


def test_quality_verdict_does_not_depend_on_order(spark, edge):
    texts = [("plain words that read like a text " * 4,), ("# | # | " * 20,), ("SHOUTING ALL THE TIME " * 9,), ("same line again and once more\n" * 9,), ("short",), (None,), ("w" * 400,)]
    df = spark.createDataFrame(texts + [(t,) for _, t in EDGE], "text string")
    keeps = [sorted(map(str, quality.keep_quality(df, order).collect())) for order in (quality.RULES, quality.RULES[::-1])]
    assert keeps[0] == keeps[1]
    assert quality.keep_quality(edge).columns == edge.columns


def test_quality_costly_weak_rules_come_last(spark):
    rng = random.Random(5)
    texts = [(" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho"]) + str(rng.randint(0, 999)) for _ in range(rng.choice([5, 600, 900]))),) for _ in range(600)]
    docs = spark.createDataFrame(texts, "text string").repartition(4)
    slow = quality.Rule("slow", lambda t, w: F.size(F.array_distinct(F.transform(w, lambda x: F.sha2(F.repeat(x, 200), 512)))) < 0)
    idle = quality.Rule("idle", lambda t, w: F.size(w) < 0)
    few = quality.RULES[0]
    for rules in ([slow, idle, few], [few, slow, idle], [idle, slow, few]):
        cost, rejected = quality.measure_rules(docs, rules)
        assert cost["slow"] > 5 * max(cost["few_words"], cost["idle"])  # jobs' own time is not in the cost
        assert rejected["slow"] == rejected["idle"] == 0 and 0.2 < rejected["few_words"] < 0.5
        assert quality.rank_rules(docs, rules)[0].name == "few_words"
    mild = quality.Rule("slow_mild", lambda t, w: slow.rejects(t, w) | (F.size(w) == 600))
    assert [r.name for r in quality.rank_rules(docs, [mild, few])] == ["few_words", "slow_mild"]
    assert quality.rank_rules(docs.limit(0), [mild, few]) == [mild, few]


def test_quality_report_says_what_the_cascade_keeps(spark):
    texts = [(i, t) for i, t in enumerate(["plain words that read like a text " * 4, "one two three four five six seven eight nine ten eleven", "# | # | " * 20, "# | # $ % & a b c d e f g h", "SHOUTING ALL THE TIME NOW AND THEN OR NOT SO MUCH AS HERE",
             "same line\nsame line\nsame line\na b c d e f g h i j k", "", None, "w" * 400, " ".join(f"{'x' * 30}{i}" for i in range(12)), "\n\n".join(f"l{i} a" for i in range(9))])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    report = {r.doc_id: r.kept for r in quality.quality_report(df).collect()}
    assert {i for i, kept in report.items() if kept} == {r.doc_id for r in quality.keep_quality(df).collect()}
    assert {True, False} == set(report.values())


def test_mixing_targets_and_bounds(spark, edge):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 80), rng.choices(["a", "b", None, "d"], [8, 4, 2, 0.3])[0]) for i in range(1500)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    per = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        t = per.setdefault(r.source, [r.target, r.source_size, 0])
        t[2] += r.taken
    total = sum(s for _, s, _ in per.values())
    assert abs(sum(t for t, _, _ in per.values()) - total) < 1e-6 * total
    for target, size, taken in per.values():
        assert target <= 3 * size + 1e-6
        assert abs(taken - target) <= 0.03 * target + 240
    assert Counter((r.doc_id, r.size) for r in mixing.mix(edge).collect())[3, 1] == 2


def test_mixing_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 100)], "source string, size long")
    assert {r.source: r.target for r in mixing.source_targets(sizes).collect()} == {"a": 30.0, "b": pytest.approx(1080 * 2 / 3), None: 300.0} or \
        {r.source: r.target for r in mixing.source_targets(sizes).collect()} == {"a": 30.0, "b": 780.0, None: 300.0}


def test_url_filter_as_of(spark):
    entries = spark.createDataFrame([("d:bad.org", "add", "2024-01-10"), ("d:bad.org", "remove", "2024-03-01"), ("h:x.com", "add", "2024-02-01"), ("p:y.com/a/b", "add", "2024-01-01"), (None, "add", "2024-01-01")],
                                    "pattern string, action string, at string").withColumn("at", F.to_date("at"))
    asked = [("http://www.bad.org/q", "2024-01-09", False), ("http://www.bad.org/q", "2024-01-10", True), ("https://bad.org", "2024-02-29", True), ("https://bad.org", "2024-03-01", False), ("http://notbad.org", "2024-02-01", False),
             ("http://x.com/z", "2024-05-05", True), ("http://a.x.com/z", "2024-05-05", False), ("http://Y.com/a/b/c?d", "2024-05-05", True), ("http://y.com/a/bc", "2024-05-05", False), (None, "2024-05-05", False), ("junk", "2024-05-05", False), ("http://x.com/", None, False)]
    captures = spark.createDataFrame(asked * 2, "url string, day string, want boolean").withColumn("fetched_on", F.to_date("day"))
    out = urls.filter_urls(captures, entries).collect()
    assert len(out) == 24 and all(r.blocked == r.want for r in out)
    assert urls.filter_urls(captures.limit(0), entries).count() == 0
    assert not any(r.blocked for r in urls.filter_urls(captures, entries.limit(0)).collect())


# PII, toxicity, decontamination ---------------------------------------------------------------------------


def naive_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(9)
    for _ in range(3000):
        t = "".join(rng.choice(["a", "é", "7", "12", ".", "@", "b.c", "+1", " ", "-", "(", ")", "4111111111111111", "\n", "192.168.0.1", "%"]) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(t) == naive_spans(t), t


def test_base_spans_are_linear_in_long_runs():
    pii.base_spans("a" * 300_000 + "@" + "1" * 300_000 + "." + "@" * 1000)


def test_field_learns_and_redacts(spark):
    rng = random.Random(2)
    texts = [f"call +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} now or mail user{k}@mail{k}.example.com from {rng.randint(1, 255)}.{k}.7.{rng.randint(0, 255)} in {1900 + k} we paid {k} for {k * 3} of it" for k in range(60)]
    field = pii.Field().fit(texts)
    clean = "In 1987 there were 12 of 345 chapters, about 3.5 of 10; see page 27."
    assert field.decode(clean) == []
    hidden = "reach me at +1 (326) 555-4081 190.137.20 thanks"  # the pattern runs on into the next number and drops both
    assert pii.base_spans(hidden) == [] and ("phone", 12, 29) in pii.spans_of(hidden, field)[1]
    df = spark.createDataFrame([(1, texts[0], "x"), (2, None, "y"), (3, clean, "z")], "doc_id long, text string, kind string")
    out = {r.doc_id: r for r in pii.redact(df, field).collect()}
    assert "<EMAIL>" in out[1].text and "@" not in out[1].text and out[1].kind == "x"
    assert out[2].text is None and out[3].text == clean


def test_network_gradients():
    net = toxicity.Network({"a": 2, "b": 3, "c": 4})
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = net.inputs(["a", "b", "c"]).astype(np.float64)
    ids = np.array([[0, 1, 2] + [-1] * 45, [2, 2, 0, 1] + [-1] * 44])
    y = np.array([1.0, 0.0])
    g, _, _ = net.gradients(x, ids, y)

    def loss():
        v = net.run(net.gates(x), ids)
        return float(np.mean(np.log1p(np.exp(-v)) * y + np.log1p(np.exp(v)) * (1 - y)))

    for k in ("U0", "U1", "W0", "W1", "B1", "A", "v", "u", "b"):
        at, step = (0,) * net.p[k].ndim, 1e-4
        old = net.p[k][at]
        net.p[k][at] = old + step
        high = loss()
        net.p[k][at] = old - step
        low = loss()
        net.p[k][at] = old
        assert (high - low) / 2 / step == pytest.approx(float(g[k][at]), rel=0.02, abs=1e-7)


def test_toxicity_held_out(spark):
    rng = random.Random(6)
    plain = ["the", "and", "river", "stone", "walk", "green", "table", "over", "under", "song"]
    rows, labels = [], []
    for i in range(700):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 200))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", "moron"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows + [(9000, None), (9001, "")], "doc_id long, text string")
    net = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 3 == 0) for i in held]) > 0.95
    assert got[9000] == got[9001] < 0.5
    assert toxicity.score(docs.limit(0), net).count() == 0


def test_windows_cover_every_word():
    for n in (0, 1, 24, 25, 47, 48, 49, 72, 73, 500):
        covered = {i for s in toxicity.windows_of(n) for i in range(s, min(s + toxicity.WINDOW, n))}
        assert covered == set(range(n))


def test_decontamination_finds_planted(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, some(rng.randint(15, 59))) for k in range(30)]
    docs, want = [], set()
    for d in range(150):
        words = some(rng.randint(20, 600))
        if d % 5 == 0:
            k, item = items[d // 5]
            item = [rng.choice(vocabulary) if d % 10 == 0 and j % 6 == 3 else w for j, w in enumerate(item)]  # every second a paraphrase
            at = rng.randrange(len(words))
            words[at:at] = item
            want.add((d, k))
        docs.append((d, " ".join(words).title() + "."))
    df = spark.createDataFrame(docs + [(900, None), (901, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(77, None), (78, "")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()} == want
    assert decontaminate.drop_leaks(df, bench).count() == 152 - 30
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench, block=7).collect()} >= {w for w in want if w[0] % 10}
    assert decontaminate.find_leaks(df, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(df.limit(0), bench).count() == 0


def _holds(words, item, idf, buckets):
    """Brute force: the rule of acceptance at every place of a text."""
    masks, m = {}, len(item)
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    rare = sorted(set(item), key=lambda w: (-idf[buckets[w]], w))[:decontaminate.ANSWER_WORDS]
    for at in range(0, max(1, len(words) - m + 1), max(1, m // 8)):
        near = words[max(0, at - m // 2):at + m + m // 2]
        common = decontaminate.lcs(masks, m, near)
        if common >= decontaminate.EXACT * m or common >= decontaminate.PARAPHRASE * m and sum(w in near for w in rare) >= decontaminate.ANSWER * len(rare):
            return True
    return False


def test_decontamination_recall_of_planted(spark):
    """Short, long and common items, unchanged and with 30 and 40 of 100 words replaced, planted in texts of the corpus."""
    rng = random.Random(12)
    texts = [w for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if len(w := decontaminate.words_of(r.text)) >= 64]
    asked = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    joined = [w for words in asked for w in words]
    items = asked + [w[:n] for w in asked[:12] for n in (2, 3, 5, 8, 10)] + [joined[k * 90:k * 90 + 400] for k in range(4)]
    other = [w for words in texts for w in words[:50]]
    docs, planted = [], []
    for share in (0, *(0.3, 0.4) * 3):
        for k, item in enumerate(items[:len(asked)] if share else items):
            host = list(rng.choice(texts))[:300]
            at = rng.randrange(len(host))
            host[at:at] = [rng.choice(other) if rng.random() < share else w for w in item]
            docs.append((len(docs), b" ".join(host).decode()))
            planted.append((share, k, host))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(k, b" ".join(w).decode()) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, bench).collect()}
    assert not [(d, k) for d, (share, k, _) in enumerate(planted) if share == 0 and (d, k) not in got]
    seen, total = decontaminate.document_frequencies(df)
    idf, buckets = np.log((total + 1) / (seen + 1)) + 0.1, decontaminate.Buckets()
    due = [(d, k) for d, (share, k, host) in enumerate(planted) if share and _holds(host, items[k], idf, buckets)]
    assert len(due) > 80 and sum(p in got for p in due) >= 0.95 * len(due)


def test_decontamination_blocks_share_one_basis(spark):
    """Items of later blocks are found as in one block: the same pairs, at the same cosine."""
    rng = random.Random(21)
    texts = [w for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if len(w := decontaminate.words_of(r.text)) >= 64]
    items = [["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))).encode() for _ in range(rng.randint(16, 56))] for _ in range(24)]
    docs, want = [], set()
    for d in range(96):
        words, k = list(rng.choice(texts))[:300], d % len(items)
        at = rng.randrange(len(words))
        words[at:at] = [rng.choice(texts)[0] if j % 6 == 3 and d % 2 else w for j, w in enumerate(items[k])]  # every second a paraphrase
        docs.append((d, b" ".join(words).decode()))
        want.add((d, k))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(k, b" ".join(w).decode()) for k, w in enumerate(items)], "item_id long, text string")
    whole, blocks = ({(r.doc_id, r.item_id): (r.lcs, r.cosine) for r in decontaminate.find_leaks(df, bench, block=b).collect()} for b in (4096, 7))
    assert whole.keys() >= want and blocks.keys() == whole.keys()
    assert all(blocks[p] == (whole[p][0], pytest.approx(whole[p][1], abs=1e-3)) for p in whole)


def test_decontamination_basis_is_fitted_on_every_passage(spark):
    """More passages than a sample of 20,000 would hold: whitened coordinates of all of them have the identity as their second moment."""
    rng = random.Random(4)
    vocabulary = [[f"w{d}x{k}" for k in range(30)] for d in range(90)]  # each topic in a few texts
    texts = [" ".join(rng.choices(vocabulary[d % 90], k=100 * decontaminate.PASSAGE)) for d in range(230)]
    df = spark.createDataFrame([(d, t) for d, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    rows = decontaminate.cut_up(df)
    seen, total = decontaminate.frequencies(rows)
    assert total == 23_000 and seen.sum() == sum(len(set(w[i:i + decontaminate.PASSAGE])) for t in texts for w in [t.split()] for i in range(0, len(w), decontaminate.PASSAGE))
    idf = np.log((total + 1) / (seen + 1)) + 0.1
    basis = decontaminate.latent_basis(rows, idf, total)
    buckets, moment = decontaminate.Buckets(), np.zeros((decontaminate.RANK, decontaminate.RANK))
    for t in texts:
        ids = buckets.of([w.encode() for w in t.split()]).reshape(-1, decontaminate.PASSAGE)
        at, w = decontaminate.weights(ids, idf)
        b = (w / idf[at]) @ basis[at]
        moment += b.T @ b
    assert np.abs(moment - np.eye(decontaminate.RANK)).max() < 1e-3


def test_decontamination_sums_by_bucket():
    """The products with TF-IDF passages are those of the matrix written out, with repeated, frequent and missing words."""
    rng = np.random.default_rng(7)
    ids = np.sort(np.minimum(rng.zipf(1.2, (700, decontaminate.PASSAGE)), decontaminate.BUCKETS).astype(np.uint16), axis=1)
    ids[3], ids[4, 1:] = 9, decontaminate.BUCKETS  # one word again and again; one word, filled up
    idf = np.append(rng.uniform(0.1, 9, decontaminate.BUCKETS), 0)
    at, w = decontaminate.weights(ids, idf)
    matrix = rng.normal(size=(decontaminate.BUCKETS + 1, 5)).astype(np.float32)
    long = decontaminate.lengths(ids, idf)[:, None]
    there = decontaminate.projected(ids, (idf[:, None] * matrix).astype(np.float32)) / long
    assert np.allclose(there, w @ matrix[at], rtol=1e-3, atol=1e-4)
    back = np.zeros((decontaminate.BUCKETS + 1, 5), np.float32)
    decontaminate.spread(back, ids, (there / long).astype(np.float32))
    want = np.zeros_like(back)
    want[at] = w.T @ there
    assert np.allclose(idf[:, None] * back, want, rtol=1e-3, atol=1e-4)


@pytest.mark.parametrize("lengths", [(1,), (3, 30), (40, 20, 50), (100, 400), (2, 400), (390,)])
def test_decontamination_windows(monkeypatch, lengths):
    """Every passage of every text has the sum of its own words, whatever the lengths of the items."""
    monkeypatch.setattr(decontaminate, "COSINE", -2.0)  # every pair is a candidate
    rng = np.random.default_rng(sum(lengths))
    basis = rng.normal(size=(decontaminate.BUCKETS, 6)).astype(np.float32)
    items = [(k, [b"w%d" % x for x in rng.integers(0, 500, n)]) for k, n in enumerate(lengths)]
    search = decontaminate.Search(items, basis, np.ones(decontaminate.BUCKETS))
    texts = [rng.integers(0, decontaminate.BUCKETS, n).astype(np.uint16) for n in (1, 2, 5, 1, 31, 32, 33, 47, 50, 97, 384, 385, 700, 3)]
    got = {}
    for t, i, lo, hi, cosine in search.candidates(np.concatenate(texts), np.cumsum([0, *map(len, texts)])):
        for k, c in zip(zip(t.tolist(), i.tolist(), lo.tolist(), hi.tolist()), cosine.tolist()):
            assert k not in got
            got[k] = c
    want = {}
    for length, at, vec in search.groups:
        for t, ids in enumerate(texts):
            last = max(len(ids) - length, 0)
            for lo in sorted({*range(0, last + 1, max(length // 4, 1)), last}):
                here = basis[ids[lo:lo + length]].sum(0)
                want |= {(t, int(i), lo, min(lo + length, len(ids))): float(here @ v / np.linalg.norm(here)) for i, v in zip(at, vec)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_decontamination_search_travels_once():
    """What workers get holds the table of words once."""
    basis = np.ones((decontaminate.BUCKETS, decontaminate.RANK), np.float32)
    search = decontaminate.Search([(1, [b"a", b"b"])], basis, np.ones(decontaminate.BUCKETS))
    assert len(pickle.dumps(search)) < 1.2 * basis.nbytes


def test_pii_workers_hold_slices(monkeypatch):
    """Masked texts leave a worker in batches of SLICE bytes, or of one longer text, and stay in order beside their other columns."""
    monkeypatch.setattr(pii, "SLICE", 100)
    texts = ["call +44 20 7946 0958 now", None, "", "x" * 300, "a@b.org and c@d.org", *["plain words " * 3] * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["n", "text"])
    field = pii.Field()
    got = list(pii.redacted([batch, batch.slice(0, 0), batch.slice(3, 4)], field, "text"))
    assert all(len(b) == 1 or b["text"].nbytes <= 100 + 8 * len(b) for b in got) and len(got) > 8
    assert [r for b in got for r in b.to_pylist()] == [{"n": n, "text": pii.masked(texts[n], field)} for n in [*range(len(texts)), 3, 4, 5, 6]]
    assert got[0]["text"][0].as_py() == "call <PHONE> now"


def test_decontamination_bound_drops_no_match(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}".encode() for k in range(300)]
    texts = [[rng.choice(words) for _ in range(n)] for n in (5, 40, 700, 900)]
    items = [(k, texts[k % 4][3 * k % 5:][:rng.randint(2, 60)]) for k in range(12)] + [(20, texts[3][330:450])]
    basis = np.random.default_rng(1).normal(size=(decontaminate.BUCKETS, 8)).astype(np.float32)
    monkeypatch.setattr(decontaminate, "CHUNK", 128)  # pieces within a text
    search = decontaminate.Search(items, basis, np.ones(decontaminate.BUCKETS))
    with_bound = search.matches(texts, decontaminate.Buckets())
    monkeypatch.setattr(search, "possible", lambda ids, edges, t, *_: np.ones(len(t), bool))
    assert sorted(with_bound) == sorted(search.matches(texts, decontaminate.Buckets())) and len(with_bound) >= 13


def test_buckets_from_arrays(monkeypatch):
    """Words hashed together have the buckets that they have one by one."""
    rng = random.Random(6)
    texts = [None, b"", b"   ", b"x" * 63, b"y" * 64, b"z" * 65, b"q" * 40_000, b" a\tB-c " + b"w" * 300 + b" ", "Ü é-Z 12,5".encode(), bytes(rng.randrange(256) for _ in range(5000)), b"end"]
    for most in (decontaminate.SLICE, 50, 1):
        monkeypatch.setattr(decontaminate, "SLICE", most)
        got = decontaminate.buckets_of(texts)
        for text, ids in zip(texts, got, strict=True):
            assert np.array_equal(ids, decontaminate.Buckets().of(decontaminate.words_of(text)))


def test_decontamination_bounds_spare_words(spark, monkeypatch):
    """Texts are cut into words only where the bounds leave a candidate; no match is lost to a bound."""
    rng = random.Random(9)
    words = [f"w{k}".encode() for k in range(400)]
    texts = [[rng.choice(words) for _ in range(n)] for n in (1, 7, 60, 61, 300, 900)] + [[b"other"] * 50]
    items = [(k, texts[k % 6][2 * k % 7:][:rng.randint(1, 50)] or [b"w1"]) for k in range(18)]
    search = decontaminate.Search(items, np.random.default_rng(2).normal(size=(decontaminate.BUCKETS, 8)).astype(np.float32), np.ones(decontaminate.BUCKETS))
    ids, asked = [decontaminate.Buckets().of(t) for t in texts], set()
    found = {}
    for chunk in (decontaminate.CHUNK, 128):
        monkeypatch.setattr(decontaminate, "CHUNK", chunk)
        found[chunk] = sorted(search.found(ids, lambda t: asked.add(t) or texts[t]))
        assert len(texts) - 1 not in asked and {(t, i) for t, i, *_ in found[chunk]} >= {(k % 6, k) for k in range(18) if k % 6 or k < 6}
    for bound in ("possible", "close"):
        monkeypatch.setattr(search, bound, lambda ids, edges, t, *_: np.ones(len(t), bool))
    monkeypatch.setattr(search, "present", lambda bits, t, *_: np.ones(len(t), bool))
    assert sorted(search.found(ids, texts.__getitem__)) == found[128]


def test_lcs_by_bits():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(1, 12))] for _ in range(2))
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        row = [0] * (len(a) + 1)
        for w in b:
            row = _lcs_row(a, w, row)
        assert decontaminate.lcs(masks, len(a), b) == row[-1]


def _lcs_row(a, w, old):
    new = [0]
    for i, x in enumerate(a):
        new.append(old[i] + 1 if x == w else max(old[i + 1], new[i]))
    return new


# Edge cases of all -----------------------------------------------------------------------------------------


def test_edge_rows_everywhere(spark, edge):
    for docs, n in ((edge, len(EDGE)), (edge.limit(0), 0)):
        assert substring.remove_repeats(docs).count() == n
        assert runindex.remove_repeats(docs).count() == n
        assert quality.quality_report(docs).count() == n
        assert mixing.mix(docs).count() == n
        assert pii.find_pii(docs, pii.fit_field(docs)).count() == n
        assert jaccard.jaccard_join(docs)[0].count() == (7 if n else 0)  # distinct ids


def test_empty_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(none)).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, out, SF_SMALL)
        if name != "mixing":
            assert kept.columns == docs.columns
            out = kept.cache()
            assert 0 < out.count() <= docs.count()
    rows = kept.collect()
    assert rows and all(1 <= r.copies <= 3 for r in rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.SQL}) WHERE kept").fetchall()}
    assert {r.doc_id for r in rows} <= good
