"""Long lines, repeated rows, NULL ids and clashing columns of the older operators and the pipeline."""

import random
import re
import resource

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import pii, urls
from tallyspark.llm.common import one_each, row_key, slices, without
from tests.conftest import SF_SMALL


def whole_stretches(text):
    """Stretches by their definition, every line's tokens at once."""
    out = []
    for line in re.finditer(r"[^\n]+", text):
        tokens = [m.span() for m in pii.TOKEN.finditer(text, line.start(), line.end())]
        hot = [i for i, (a, _) in enumerate(tokens) if "0" <= text[a] <= "9" or text[a] == "@"]
        lo = hi = None
        for i in hot:
            if lo is not None and i - pii.REACH <= hi:
                hi = min(i + pii.REACH, len(tokens) - 1)
                continue
            if lo is not None:
                out.append(tokens[lo:hi + 1])
            lo, hi = max(i - pii.REACH, 0 if lo is None else hi + 1), min(i + pii.REACH, len(tokens) - 1)
        if hot:
            out.append(tokens[lo:hi + 1])
    return out


def test_stretches_by_definition():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a ", "b, ", "1 ", "x@y", "\n", "12-34 ", "word word word ", "_ "]) for _ in range(rng.randint(0, 40)))
        got = list(pii.stretches(text))
        assert [t for _, t in got] == whole_stretches(text) and not any(more for more, _ in got)


def test_pieces_cover_a_long_stretch(monkeypatch):
    text = " ".join(str(i) for i in range(3000))
    (whole,) = whole_stretches(text)
    pieces = list(pii.stretches(text))
    assert [more for more, _ in pieces] == [True] * (len(pieces) - 1) + [False]
    assert all(len(t) <= pii.STRETCH + 2 * pii.REACH for _, t in pieces)
    joined = list(pieces[0][1])
    for _, t in pieces[1:]:
        assert t[:pii.LONGEST] == joined[-pii.LONGEST:]
        joined += t[pii.LONGEST:]
    assert joined == whole
    # pieces find the same spans as the whole stretch, none twice
    field = pii.Field()
    field.weights[3, pii.FEATURES.index("digits_9_12")] = 9.0
    field.weights[3, pii.FEATURES.index("blank")] = -20.0
    text = " ".join(["1234567890" if i % 7 == 0 else str(i % 100) for i in range(4000)])
    found = field.decode(text)
    monkeypatch.setattr(pii, "STRETCH", 10**9)
    assert found == sorted(found, key=lambda s: s[1]) and len(found) == len(set(found))
    assert found == sorted(field.decode(text), key=lambda s: s[1])


def test_zero_runs_and_long_lines_are_bounded(spark):
    field = pii.Field().fit(["call +1 555 123 4567 or 10.0.0.1 now 12 34"] * 3)
    assert pii.base_spans("0" * 5000 + "1.2.3.4") == [("ip", 0, 5007)]
    assert pii.base_spans("1.2.3." + "0" * 6000) == [("ip", 0, 6006)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    line = " ".join(str(i % 1000) for i in range(60_000))
    pii.spans_of(line, field)
    pii.spans_of("9" * 2_000_000, field)
    pii.Field().fit([" ".join(str(i) for i in range(4000))], epochs=1)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000  # kB


def test_slices_are_whole_and_bounded():
    import pyarrow as pa

    texts = ["ab", None, "c" * 50, "", "dé", "e" * 9, "f"]
    got = list(slices(pa.array(["zz", *texts]).slice(1), 10))
    assert [t for _, part in got for t in part] == texts
    assert [a for a, _ in got] == [0, 2, 3, 5]


ROWS = [(1, "a b", "s", 1), (1, "a b", "s", 1), (1, "a a", "s", 1), (None, "x y", "t", 1), (None, "x y", "t", 1), (None, None, None, 1), (2, "c", "s", 1)]


def test_keys_of_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, copies int")
    kept = one_each(docs, row_key()).collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept) == [(0, ""), (0, "x y"), (1, "a a"), (2, "c")]
    left = without(docs, row_key(), docs.where("text = 'x y' OR doc_id = 2").select(row_key()))
    assert left.columns == docs.columns and sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 1, 1]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(r[0], r[1], "en", r[2], "n_active", "clash", "clash") for r in ROWS], "doc_id long, text string, lang string, source string, matched string, copies string, source_target string")
    mixed = corpus_pipeline.mixture(spark, docs, SF_SMALL)
    assert sorted(mixed.columns) == sorted(docs.columns) and dict(mixed.dtypes)["copies"] == "bigint" and mixed.count() >= 1
    assert corpus_pipeline.personal_data(spark, docs, SF_SMALL).columns == docs.columns
    captures = spark.createDataFrame([("http://bad.org/x", "2024-01-05", 1, 2)], "url string, day string, matched int, n_active int").withColumn("fetched_on", F.col("day").cast("date"))
    entries = spark.createDataFrame([("d:bad.org", "add", "2024-01-01")], "pattern string, action string, at string").withColumn("at", F.to_date("at"))
    out = urls.filter_urls(captures, entries)
    assert sorted(out.columns) == ["blocked", "day", "fetched_on", "matched", "n_active", "url"]
    assert [(r.blocked, r.matched, r.n_active) for r in out.collect()] == [(True, "d:bad.org", 1)]


@pytest.fixture(scope="module")
def crowd(spark):
    """Documents with repeated rows, copies, near copies, NULL ids and texts, a benchmark item, personal data and junk."""
    rng = random.Random(8)
    words = [("".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))) for _ in range(800)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    base = [text(120) for _ in range(12)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20, base[0], "s1"), (20, base[0], "s1"), (21, base[1] + " tail", "s0"), (None, base[2], "s0"), (None, text(90), "s2"), (None, None, None), (22, None, "s0"), (23, "", "s0"),
             (24, text(40) + " " + item + " " + text(40), "s1"), (None, text(30) + " " + item, "s1"), (25, text(60) + " mail jo@example.com or 10.1.2.3 " + text(20), "s2"), (26, "go " * 400, "s0"), (27, text(3), "s0")]
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long"), base, item


def test_pipeline_by_hand(spark, crowd):
    """Every stage's decisions on a small table, against what the rows were made to show."""
    docs, base, item = crowd
    kept = corpus_pipeline.quality_rules(spark, docs, SF_SMALL)
    texts = [r.text for r in kept.collect()]
    assert all(t and len(t.split()) >= 10 and "go go go" not in t for t in texts)
    assert all(texts.count(t) >= 1 for t in base)
    single = corpus_pipeline.near_duplicates(spark, kept, SF_SMALL)
    after = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in single.collect())
    want = {}
    sh = lambda t: {tuple(w) for w in zip(*[t.lower().split()[k:] for k in range(5)])}
    for r in sorted(kept.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text)):
        s = sh(r.text)
        if not any(100 * len(s & o) >= 75 * len(s | o) for o in want.values()):
            want[(r.doc_id if r.doc_id is not None else -1, r.text)] = s
    assert after == sorted(want)
    clean = corpus_pipeline.decontamination(spark, single, SF_SMALL)
    assert sorted(r.text for r in clean.collect()) == sorted(t for _, t in after if item not in t)
    private = corpus_pipeline.personal_data(spark, clean, SF_SMALL)
    masked = {r.doc_id: r for r in private.collect() if r.doc_id is not None}
    assert "<EMAIL> or <IP>" in masked[25].text and masked[25].n_chars == len(masked[25].text)
    assert all(masked[i].text == t for i, t in enumerate(base) if i in masked)
    mixed = corpus_pipeline.mixture(spark, private, SF_SMALL)
    rows = mixed.collect()
    size = {s: sum(len(r.text.split()) for r in private.collect() if r.source == s) for s in {r.source for r in rows}}
    for s in size:
        took = sum(r.copies * len(r.text.split()) for r in rows if r.source == s)
        assert all(1 <= r.copies <= 3 for r in rows) and abs(took - next(r.source_target for r in rows if r.source == s)) <= 2 * 130
    assert len({(r.doc_id, r.text) for r in rows}) == len(rows)


def _card(rng):
    while True:
        d = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(15))
        if pii.luhn(d):
            return d


FORMS = {
    "marks": ("phone", lambda r: f"{r(3)}-{r(3)}-{r(4)}"), "bracket": ("phone", lambda r: f"({r(3)}) {r(3)}-{r(4)}"), "zeros": ("phone", lambda r: f"0044 {r(2)} {r(4)} {r(4)}"),
    "slashes": ("phone", lambda r: f"+1/{r(3)}/{r(7)}"), "card": ("card", lambda r: "./"[int(r(1)) % 2].join(re.findall("....", _card(random.Random(r(9)))))),
    "spaced": ("email", lambda r: f"ann.{r(1)} @ site{r(1)}.com"), "host": ("email", lambda r: f"bob_{r(1)}@localhost"), "ip": ("ip", lambda r: f"{r(2)} . {r(1)} . {r(2)} . 7"),
}


def test_field_finds_forms_that_the_patterns_miss():
    rng = random.Random(11)
    digit = lambda n: str(rng.randint(1, 9)) + "".join(str(rng.randint(0, 9)) for _ in range(n - 1))
    word = lambda: "".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(2, 8)))
    said = lambda n: " ".join(word() for _ in range(n))
    plain = lambda: rng.choice([f"{word()}.{digit(2)}@{word()}{digit(1)}.example.com", f"+1 ({digit(3)}) {digit(3)}-{digit(4)}", " ".join(re.findall("....", _card(rng))), f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.9"])
    field = pii.Field().fit([f"{said(9)} {plain()} {said(8)} {digit(rng.randint(1, 6))} {said(4)}" for _ in range(240)])
    for name, (kind, form) in FORMS.items():
        found = 0
        for _ in range(50):
            before = said(7) + " "
            while pii.base_spans(before + (span := form(digit))):
                pass  # digits that pass as a card by chance
            found += (kind, len(before), len(before) + len(span)) in pii.spans_of(f"{before}{span} {said(6)}", field)[1]
        assert found >= 40, (name, found)
    clean = [f"{said(6)} {pii.harmless(rng)} {said(6)}" for _ in range(400)]
    wrong = [t for t in clean if len(pii.spans_of(t, field)[1]) > len(pii.base_spans(t))]
    assert len(wrong) <= 8, wrong


def test_rewritten_copies_say_where_their_spans_are():
    rng = random.Random(2)
    text = "mail ann.5@site.com or +44 20 1234 5678, pay 4111 1111 1111 1111 from 10.0.0.1 now"
    assert len(pii.base_spans(text)) == 4
    for _ in range(50):
        copy, gold = pii.perturbed(text, rng)
        ordered = sorted(gold, key=lambda s: s[1])
        assert all(a[2] <= b[1] for a, b in zip(ordered, ordered[1:]))
        assert all(0 <= a < b <= len(copy) and pii.TRIGGER.search(copy[a:b]) for _, a, b in gold)
    assert pii.perturbed("nothing here", rng) == ("nothing here", []) and pii.perturbed("", rng) == ("", [])
