"""Personal data: base patterns plus a semi-Markov conditional random field.

Base spans come from four patterns with their checks.  The field adds spans the
patterns miss (say, a phone number without a plus sign): it segments the
stretch around every digit or at-sign into whole spans, so features see a
span at once (shape, digit count, checksum, neighbours), and bounded-entity
dynamic programming picks boundaries and kinds jointly.  Its weights maximise
the conditional likelihood of base spans (and of their absence) on a bounded
sample of at most ``SAMPLE`` texts of up to ``SAMPLE_CHARS`` characters, each with ``COPIES`` copies
in which base spans are rewritten in forms that the patterns miss (other marks, brackets, no plus sign)
or replaced by dates, prices, counts and other numbers that are nobody's; every
whole text is then decoded.  Added spans never touch base spans.

Edge cases: NULL and empty texts have no spans; long digit or word runs are
scanned in linear time, and lines full of numbers in pieces of ``STRETCH`` tokens; repeated rows give repeated results; an empty table
gives an empty result; other columns are not read by ``find_pii``.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm.common import slices, table

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_CHARS = 400, 20_000
SLICE = 1 << 20       # bytes of texts that a worker has as strings at once, or one longer text
LONGEST = 16          # tokens of a span of the field
LONGEST_CHARS = 320   # characters of a span of the field, as long as an address may be
REACH = 8             # tokens of context on both sides of a trigger, as an address with blanks needs
STRETCH = 512         # tokens decoded at once
COPIES = 3            # rewritten copies of a text of the sample
FLOOR = 2.0           # log-odds against "no entity" that an added span needs

TRIGGER = re.compile(r"[0-9@]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a start inside a run of digits would end alike
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")  # nothing to go back to in long runs; one digit alone is not a card anyway
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SPACED = re.compile(r"[0-9]+(?:\s?\.\s?[0-9]+){3}")
AT_WORDS = re.compile(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
SPACED_ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9._%+-]* ?@ [A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
HOST_ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9._%+-]*@[A-Za-z][A-Za-z0-9-]*")
MARKED_PHONE = re.compile(r"[0-9]{3}([-./])[0-9]{3}\1[0-9]{4}")
BRACKET_PHONE = re.compile(r"\([0-9]{2,5}\) ?[0-9]{3,4}[ -]?[0-9]{3,4}")
ZEROS_PHONE = re.compile(r"00[1-9][0-9]{0,2}(?:[ -][0-9]{1,4}){2,5}")
YEAR = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\n]|_")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid_ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in text.split(".")))


def valid_card(text: str) -> bool:
    d = digits_of(text)
    return 13 <= len(d) <= 19 and luhn(d)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from the at-signs: a local part ends at one and holds none."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        low = at
        while low > free and (c := text[low - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            low -= 1
        if low < at and (m := DOMAIN.match(text, at + 1)):
            out.append((low, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not TRIGGER.search(text):
        return []
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if valid_ip(m.group())]
    out += [("card", *m.span()) for m in CARD.finditer(text) if valid_card(m.group())]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15] if "+" in text else []
    return out


# Semi-Markov field ---------------------------------------------------------------------------------

FEATURES = ("bias", "at", "one_at_then_dot", "plus_first", "digits_1_6", "digits_7_8", "digits_9_12", "digits_13_19", "digits_20", "luhn", "four_parts", "octets", "letters",
            "blank", "bracket", "mixed", "left_word", "left_digit", "right_word", "right_digit", "left_dot", "edge_mark", "one_token",
            "phone_groups", "zeros_first", "fours", "spaced_octets", "at_words", "one_run", "comma", "colon", "year", "spaced_address", "host_address", "slashed_plus", "marked_phone", "zeros_phone", "bracket_phone")


def features(text: str, start: int, end: int) -> list[float]:
    """Features of one whole candidate span."""
    s = text[start:end]
    d = digits_of(s)
    n = len(d)
    before, after = text[start - 1:start], text[end:end + 1]
    letters = any(c.isalpha() for c in s)
    parts = s.split(".")
    four = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    at = s.count("@")
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] if n else []
    plain = n > 0 and not letters and at == 0
    # an address says nothing by its number of digits
    quad = plain and len(groups) == 4 and bool(SPACED.fullmatch(s)) and valid_ip(re.sub(r"\s", "", s))
    # nothing beside it that could belong to it
    whole = not (before.isalnum() or (before != "" and before in "._%+-/@")) and not (after.isalnum() or (after != "" and after in "-/@") or (after == "." and text[end + 1:end + 2].isalnum()))
    return [float(x) for x in (
        1, at > 0, at == 1 and 0 < s.index("@") < len(s) - 3 and "." in s[s.index("@") + 2:-1], s[:1] == "+", 1 <= n <= 6 and not quad, 7 <= n <= 8 and not quad, 9 <= n <= 12 and not quad, 13 <= n <= 19, n > 19,
        13 <= n <= 19 and luhn(d), four, four and valid_ip(s), letters, any(c.isspace() for c in s), "(" in s, letters and n > 0 and at == 0,
        before.isalpha(), before.isdigit(), after.isalpha(), after.isdigit(), before in (".", "@", "-", "+") and before != "", not (s[:1].isalnum() or s[:1] in "+(") or not s[-1:].isalnum(), len(s) < 2,
        plain and groups[-3:] == [3, 3, 4], plain and s[:2] == "00" and len(groups) > 2, plain and len(groups) >= 4 and set(groups[:-1]) == {4} and groups[-1] <= 4,
        quad, at == 1 and bool(AT_WORDS.fullmatch(s)), plain and len(groups) == 1, "," in s, ":" in s or ";" in s,
        plain and bool(YEAR.search(s)), at == 1 and whole and bool(SPACED_ADDRESS.fullmatch(s)), at == 1 and whole and bool(HOST_ADDRESS.fullmatch(s)), plain and whole and s[:1] == "+" and "/" in s and 9 <= n <= 15,
        plain and whole and bool(MARKED_PHONE.fullmatch(s)), plain and whole and bool(ZEROS_PHONE.fullmatch(s)), plain and whole and bool(BRACKET_PHONE.fullmatch(s)))]


def rewritten(kind: str, span: str, rng: random.Random) -> str:
    """The same data in a form that the base patterns do not take."""
    d = digits_of(span)
    if kind == "email":
        name, domain = span.split("@", 1)
        return rng.choice([f"{name} @ {domain}", f"{name}@ {domain}", f"{name}@{domain.split('.')[0]}"])
    if kind == "ip":
        return rng.choice([" . ", ". "]).join(span.split("."))
    if kind == "card":
        return rng.choice("./").join(d[i:i + 4] for i in range(0, len(d), 4))
    if len(d) >= 10 and rng.random() < 0.7:
        a, b, c = d[-10:-7], d[-7:-4], d[-4:]
        return rng.choice([f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a}/{b}/{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"+{d[:-10] or 1}/{a}/{b}{c}"])
    first = rng.randint(2, 4)
    return f"00{d[:2].lstrip('0') or 1} {d[2:2 + first]} " + rng.choice(" -").join(d[i:i + 4] for i in range(2 + first, len(d), 4))


def harmless(rng: random.Random) -> str:
    """A number that is nobody's: date, time, price, version, range, plain number, list of numbers."""
    n = rng.randint
    year = n(1900, 2035)
    return rng.choice([f"{year}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 28)}/{n(1, 12)}/{year}", f"{year}-{n(1, 12):02}-{n(1, 28):02} {n(0, 23):02}:{n(0, 59):02}:{n(0, 59):02}", f"{n(0, 23)}:{n(0, 59):02}",
                       f"{n(1, 999)},{n(0, 999):03}.{n(0, 99):02}", f"{n(0, 20)}.{n(0, 20)}.{n(0, 99)}", f"{n(1, 500)}-{n(500, 999)}", f"{year}-{year + n(1, 9)}", str(n(10, 10 ** n(2, 12))), f"{n(0, 999)}.{n(0, 99999)}",
                       " ".join(str(n(0, 10 ** n(1, 5))) for _ in range(n(2, 6))), ", ".join(str(n(0, 10 ** n(1, 5))) for _ in range(n(2, 6))), f"{n(0, 99)} @ {n(0, 99)}.{n(0, 99)}", f"@{rng.choice(['home', 'team', 'noon'])}{n(1, 99)}"])


def perturbed(text: str, rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A copy of ``text`` with other spans, and the spans there are to find in it."""
    out, gold, at, size = [], [], 0, 0
    for kind, a, b in sorted(base_spans(text), key=lambda s: s[1:]):
        if a < at:
            continue
        real = rng.random() < 0.6
        new = rewritten(kind, text[a:b], rng) if real else harmless(rng)
        out += [text[at:a], new]
        size += a - at
        if real:
            gold.append((kind, size, size + len(new)))
        size, at = size + len(new), b
    copy = "".join([*out, text[at:]])
    return copy, gold + [s for s in base_spans(copy) if all(s[2] <= a or b <= s[1] for _, a, b in gold)]


def stretches(text: str):
    """Tokens around triggers, as separate lists (whether more of the stretch follows, tokens).

    A line feed ends a stretch, and so do tokens without a trigger beyond REACH on both sides.  A stretch of
    more than STRETCH tokens comes in pieces that overlap by LONGEST tokens; no more than a piece is held."""
    for line in re.finditer(r"[^\n]+", text):
        if not TRIGGER.search(text, line.start(), line.end()):
            continue
        near, held, since = [], [], 0
        for m in TOKEN.finditer(text, line.start(), line.end()):
            a = m.start()
            hot = "0" <= text[a] <= "9" or text[a] == "@"
            if not held:
                near.append(m.span())
                if hot:
                    held, near, since = near, [], 0
                else:
                    near = near[-REACH:]
                continue
            held.append(m.span())
            since = 0 if hot else since + 1
            if since == 2 * REACH:
                yield False, held[:-REACH]
                near, held = held[-REACH:], []
            elif len(held) == STRETCH + 2 * REACH:  # what is left is longer than the context that may have to be cut off
                yield True, held[:STRETCH]
                held = held[STRETCH - LONGEST:]
        if held:
            yield False, held[:len(held) - max(since - REACH, 0)]


def candidates(text: str, tokens: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Token ranges [i, j) that could be an entity, and their features."""
    at, rows = [], []
    for i, (a, _) in enumerate(tokens):
        first = text[a]
        if not (first.isalnum() or first in "+("):
            continue
        shown = False
        for j in range(i + 1, min(i + LONGEST, len(tokens)) + 1):
            b, e = tokens[j - 1]
            if e - a > LONGEST_CHARS:
                break
            shown = shown or "0" <= text[b] <= "9" or text[b] == "@"
            if shown and text[b].isalnum():
                at.append((i, j))
                rows.append(features(text, a, e))
    return np.array(at, np.int64).reshape(-1, 2), np.array(rows, float).reshape(-1, len(FEATURES))


class Field:
    """Segment scores; a token outside all entities scores 0."""

    def __init__(self):
        self.weights = np.zeros((len(KINDS), len(FEATURES)))

    def decode(self, text: str) -> list[tuple[str, int, int]]:
        out, free = [], 0
        for more, tokens in stretches(text):
            at, rows = candidates(text, tokens)
            if not len(at):
                continue
            found = []
            score = rows @ self.weights.T
            kind, value = score.argmax(1), score.max(1)
            good = np.flatnonzero(value > FLOOR)
            by_end: dict[int, list[int]] = {}
            for k in good:
                by_end.setdefault(int(at[k, 1]), []).append(int(k))
            best, back = np.zeros(len(tokens) + 1), [-1] * (len(tokens) + 1)
            for j in range(1, len(tokens) + 1):
                best[j] = best[j - 1]
                for k in by_end.get(j, ()):
                    if (v := best[at[k, 0]] + value[k]) > best[j]:
                        best[j], back[j] = v, k
            j = len(tokens)
            while j:
                if back[j] < 0:
                    j -= 1
                else:
                    i, e = at[back[j]]
                    found.append((KINDS[kind[back[j]]], tokens[i][0], tokens[e - 1][1]))
                    j = int(i)
            # spans that begin in the overlap belong to the next piece
            last = tokens[-LONGEST][0] if more else tokens[-1][1]
            out += [s for s in reversed(found) if free <= s[1] < last]
            free = max([free, *(s[2] for s in out[-LONGEST:])])
        return out

    def gradient(self, n: int, at: np.ndarray, rows: np.ndarray, gold: dict[tuple[int, int], int]):
        """Observed minus expected features of one stretch of n tokens."""
        score = rows @ self.weights.T
        alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        alpha[0] = beta[n] = 0
        total = np.logaddexp.reduce(score, axis=1)
        by_end = [np.flatnonzero(at[:, 1] == j) for j in range(n + 1)]
        by_start = [np.flatnonzero(at[:, 0] == i) for i in range(n + 1)]
        for j in range(1, n + 1):
            alpha[j] = np.logaddexp.reduce(np.append(alpha[at[by_end[j], 0]] + total[by_end[j]], alpha[j - 1]))
        for i in range(n - 1, -1, -1):
            beta[i] = np.logaddexp.reduce(np.append(beta[at[by_start[i], 1]] + total[by_start[i]], beta[i + 1]))
        expected = np.exp(score + (alpha[at[:, 0]] + beta[at[:, 1]] - alpha[n])[:, None])
        for k, (i, j) in enumerate(at.tolist()):
            if (i, j) in gold:
                expected[k, gold[i, j]] -= 1
        return -expected.T @ rows

    def fit(self, texts: list[str], epochs: int = 30, rate: float = 0.5) -> "Field":
        jobs = []
        rng = random.Random(29)
        known = [(t, base_spans(t)) for t in texts]
        known += [perturbed(t, rng) for t, found in known if found for _ in range(COPIES)]
        for text, found in known:
            spans = {(a, b): KINDS.index(k) for k, a, b in found}
            for _, tokens in stretches(text):
                at, rows = candidates(text, tokens)
                if len(at):
                    jobs.append((len(tokens), at, rows, {(i, j): spans[p] for i, j in at.tolist() if (p := (tokens[i][0], tokens[j - 1][1])) in spans}))
        seen = np.full(self.weights.shape, 1e-6)
        for _ in range(epochs):
            for lo in range(0, len(jobs), 16):
                g = sum(self.gradient(*job) for job in jobs[lo:lo + 16]) - 0.001 * self.weights
                seen += g**2
                self.weights += rate * g / np.sqrt(seen)
        return self


def fit_field(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where((F.char_length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]"))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    # only the lowest hashes, about 4 * sample rows of all tasks together: a limit alone would bring ``sample`` texts of every task to the driver
    share = min(1.0, 4 * sample / max(held.count(), 1))
    highest = min(int(share * 2**64) - 2**63, 2**63 - 1)
    rows = held.where(key <= F.lit(highest).cast("long")).orderBy(key, "doc_id", "text").limit(sample).collect()
    return Field().fit([r.text for r in rows])


def spans_of(text: str | None, field: Field) -> tuple[list, list]:
    """Base spans, and all spans, both by kind and start."""
    if not text:
        return [], []
    base = base_spans(text)
    if not TRIGGER.search(text):
        return base, base
    taken = sorted((a, b) for _, a, b in base)
    extra = []
    for kind, a, b in field.decode(text):
        if all(b <= x or y <= a for x, y in taken):
            extra.append((kind, a, b))
    return base, sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def pieces(batches, text: str):
    """(rows, their texts as strings) of SLICE bytes of texts or one longer text, so that a worker holds neither the strings nor the results of a whole batch."""
    for batch in batches:
        for a, texts in slices(batch[text], SLICE):
            yield batch.slice(a, len(texts)), texts


def find_pii(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end; code points, end exclusive)."""
    one = "array<struct<kind:string,start:long,end:long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def run(batches):
        for rows, texts in pieces(batches, "text"):
            found = [spans_of(t, field) for t in texts]
            yield pa.RecordBatch.from_arrays([rows["doc_id"], *[pa.array([named(f[i]) for f in found], kind) for i in (0, 1)]], ["doc_id", "base", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id long, base {one}, spans {one}")


def masked(value: str | None, field: Field) -> str | None:
    """``value`` with every span replaced by its kind."""
    _, spans = spans_of(value, field)
    if not spans:
        return value
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [value[at:a], f"<{k.upper()}>"]
        at = max(at, b)
    return "".join([*out, value[at:]])


def redacted(batches, field: Field, text: str):
    """Batches of SLICE bytes of texts, or of one longer text, with ``text`` masked."""
    for rows, texts in pieces(batches, text):
        i = rows.schema.get_field_index(text)
        column = pa.array([masked(v, field) for v in texts], rows.schema.field(i).type)
        yield pa.RecordBatch.from_arrays([column if k == i else c for k, c in enumerate(rows.columns)], schema=rows.schema)


def redact(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The same rows and columns with every span of ``text`` replaced by its kind in angle brackets; touching or overlapping spans become one."""
    return docs.mapInArrow(lambda batches: redacted(batches, field, text), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_pii(docs, fit_field(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[n(k) for k in KINDS], F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))
