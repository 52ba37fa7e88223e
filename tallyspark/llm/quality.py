"""Quality rules as a short-circuit cascade.

The cost of every rule and the share of documents it rejects are estimated on
a sample; rules then run in order of rejection per cost inside one nested
CASE (a rule's cost is what repeating it on the sample adds to a job, so that jobs' own overhead cancels), so an expensive rule is evaluated only for documents that all earlier
rules let pass.  The verdict is the conjunction of all rules, hence the same
for every order; only the work depends on it.

Edge cases: a NULL or empty text has no words and fails ``few_words``; texts
of any length are measured whole; repeated rows are judged row by row; an
empty table gives an empty result; other columns pass through untouched
(internal columns are prefixed ``__q_``).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.llm.common import WORD, let, table, words_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5          # words of a repeated window
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOL_PERCENT = 50     # symbols per 100 words
LINE_PERCENT = 30       # repeated lines per 100 lines
UPPER_PERCENT = 60      # capitals per 100 letters
MEAN_WORD = (2, 20)     # characters
SAMPLE_ROWS = 2000      # expected size of the sample that orders the rules
ROUNDS = 2              # timings of a rule, of which the shortest counts
REPEATS = 4             # times a rule runs on the sample in the longer of its two timed jobs


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


def n_dup_lines(text: Column) -> Column:
    return let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur at least twice in the text.

    Window hashes are compared as a set first; positions are sorted only for
    texts that repeat something.  Cost O(n log n) in the words of one text.
    """
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(h: Column) -> Column:
        ranked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(r: Column) -> Column:
            same = F.filter(r, lambda x, j: F.coalesce(F.get(r, j - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(r, j + 1)["h"] == x["h"], F.lit(False)))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def width(at: Column) -> Column:
            gaps = F.transform(at, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - s, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return let(let(ranked, twice), width)

    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(words) > WINDOW, found).otherwise(F.lit(0)).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)`` is TRUE for a document the rule turns away.

    ``measured(text, words)``, where there is one, says the same from columns that a report holds already.
    """

    name: str
    rejects: object
    measured: object = None


def _share(part: Column, percent: int, whole: Column) -> Column:
    return part * 100 > whole * percent


RULES = [
    Rule("few_words", lambda t, w: F.size(w) < MIN_WORDS),
    Rule("repeats", lambda t, w: _share(n_repeat_words(w), REPEAT_PERCENT, F.size(w))),
    Rule("symbols", lambda t, w: _share(n_symbols(t), SYMBOL_PERCENT, F.size(w)),
         lambda t, w: _share(F.col("n_symbols"), SYMBOL_PERCENT, F.col("n_words"))),
    Rule("word_length", lambda t, w: let(word_chars(w), lambda c: (c < F.size(w) * MEAN_WORD[0]) | (c > F.size(w) * MEAN_WORD[1])),
         lambda t, w: (F.col("word_chars") < F.col("n_words") * MEAN_WORD[0]) | (F.col("word_chars") > F.col("n_words") * MEAN_WORD[1])),
    # without repeated lines the share needs no second count of the lines
    Rule("dup_lines", lambda t, w: _share(n_dup_lines(t), LINE_PERCENT, F.size(lines_of(t))),
         lambda t, w: (F.col("n_dup_lines") > 0) & _share(F.col("n_dup_lines"), LINE_PERCENT, F.size(lines_of(t)))),
    Rule("shouting", lambda t, w: _share(F.regexp_count(t, F.lit("[A-Z]")), UPPER_PERCENT, F.regexp_count(t, F.lit("[A-Za-z]")))),
]


def rank_rules(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per second of work on a sample of about ``rows`` documents; ties keep their order."""
    cost, rejected = measure_rules(docs, rules, text, rows)
    # what takes no measurable time runs first, the likeliest to reject ahead
    return sorted(rules, key=lambda r: -rejected.get(r.name, 0) / max(cost.get(r.name, 0), 1e-4))


def measure_rules(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], dict[str, float]]:
    """Seconds that one run of each rule over the sample adds, and the share of the sample it rejects; empty for an empty sample.

    A rule is timed with one run and with REPEATS runs over the sample in jobs of the same plan; the difference of the shortest
    of ROUNDS timings holds no scheduling or compiling.
    """
    # a fraction, not a limit: a limit would bring up to ``rows`` texts of every task into one
    share = min(1.0, rows / max(docs.count(), 1))
    sample = docs.select(F.coalesce(text, F.lit("")).alias("__q_text")).sample(share, seed=17)
    sample = sample.withColumn("__q_words", words_of(F.col("__q_text"))).persist()
    cost, rejected = {}, {}
    try:
        n = sample.count()
        for rule in rules if n else ():
            def run(times: int) -> tuple[int, float]:
                # the rows are repeated below the rule, which is judged for each of them
                again = sample.withColumn("__q_run", F.explode(F.sequence(F.lit(1), F.lit(times))))
                began = time.perf_counter()
                bad = again.agg(F.count_if(rule.rejects(F.col("__q_text"), F.col("__q_words")))).first()[0]
                return bad, time.perf_counter() - began

            rejected[rule.name] = run(1)[0] / n  # its time, which holds compiling, is not used
            short, long = (min(run(times)[1] for _ in range(ROUNDS)) for times in (1, REPEATS))
            cost[rule.name] = max(long - short, 0.0) / (REPEATS - 1)
    finally:
        sample.unpersist()
    return cost, rejected


def verdict(ranked: list[Rule], text: Column, words: Column, measured: bool = False) -> Column:
    """Name of the first rule (in the given order) that rejects, NULL when none does; ``measured`` if the columns of a report are there."""
    out = F.lit(None).cast("string")
    for rule in reversed(ranked):
        rejects = rule.measured if measured and rule.measured else rule.rejects
        out = F.when(rejects(text, words), F.lit(rule.name)).otherwise(out)
    return out


def keep_quality(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """Documents that every rule lets pass, with their own columns."""
    ranked = rules or rank_rules(docs, text=text)
    # one expression binds the words, so that pushing the filter down cannot repeat their extraction
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.where(let(words_of(t), lambda w: verdict(ranked, t, w)).isNull())


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures and verdict of every document."""
    ranked = rank_rules(docs, text=text)
    t, w = F.col("__q_text"), F.col("__q_words")
    held = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__q_text")).withColumn("__q_words", words_of(t))
    measured = held.select(
        "doc_id", "__q_text", "__q_words", F.size(w).cast("long").alias("n_words"), word_chars(w).alias("word_chars"), n_symbols(t).alias("n_symbols"),
        n_dup_lines(t).alias("n_dup_lines"), n_repeat_words(w).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    # the two base rules are already decided by their measures; the cascade runs the others
    rest = [r for r in ranked if r.name not in ("few_words", "repeats")]
    return measured.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rest, t, w, measured=True).isNull()).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


KEPT_SQL = """NOT base_failed AND n_symbols * 100 <= n_words * 50
       AND word_chars >= n_words * 2 AND word_chars <= n_words * 20
       AND n_dup_lines * 100 <= n_lines * 30
       AND n_upper * 100 <= n_letters * 60"""

SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
sh AS (SELECT doc_id, i, array_to_string(words[i:i+4], chr(32)) AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, s FROM sh GROUP BY doc_id, s HAVING count(*) > 1),
hit AS (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM sh JOIN twice USING (doc_id, s)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM hit GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters
  FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ({KEPT_SQL}) AS kept FROM b
"""
