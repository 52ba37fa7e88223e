"""Substring dedup: seed and extend over words.

Windows of 20 consecutive words are seeded by winnowed anchors (see
``anchors``).  No match is extended from its anchor: where an anchor has two or
more different fragments, all windows of its blocks are compared by hash over
all buckets (``spread_always``), and runs of repeated windows are the maximal
repeats.  A
window is a repeat when its words also start earlier: in a document with a
smaller id, or earlier in the same document.

Edge cases: NULL and empty texts have no words and stay empty; NULL ids order
after all others; rows that share an id do not count as earlier than each
other; texts below 20 words have no window; empty tables give empty results;
other columns are not read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm.anchors import Blocks, Repeats, Words, find_repeats
from tallyspark.llm.common import table

WINDOW = 20


class WordRepeats(Repeats):
    tokens, window, gram = Words, WINDOW, 6
    spread_always = True

    def repeated_here(self, b: Blocks) -> np.ndarray:
        """Windows that also start earlier in their document.  Equal windows select equal anchors, so only blocks whose
        anchor comes twice in the document are compared."""
        mark = np.zeros(b.m, bool)
        order = np.lexsort((b.anchor, b.owner))
        same = (b.anchor[order[1:]] == b.anchor[order[:-1]]) & (b.owner[order[1:]] == b.owner[order[:-1]])
        twice = np.zeros(len(order), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        which = np.flatnonzero(twice)
        at, key = b.windows(which)
        owner = np.repeat(b.owner[which], b.stop[which] - b.first[which])
        order = np.lexsort((at, key, owner))
        again = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        mark[at[order[1:][again]]] = True
        return mark

    def keep(self, body: bytes, drop: np.ndarray | None) -> bytes:
        words = body.split()
        return b" ".join(words if drop is None else compress(words, (~drop).tolist()))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, spans (word offsets, end exclusive) and the kept text of every document."""
    found = find_repeats(docs, WordRepeats, doc_id, text)
    return found.select("doc_id", F.col("n_tokens").alias("n_words"), "n_removed", F.arrays_zip(F.col("span_starts").alias("start"), F.col("span_ends").alias("end")).alias("spans"), F.col("kept").cast("string").alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(words[i:i+19], chr(32))) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d)),
f AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS again FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM f WHERE again),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
k AS (SELECT p.doc_id, string_agg(word, chr(32) ORDER BY p.p) AS kept, count(*) AS n FROM p ANTI JOIN gone USING (doc_id, p) GROUP BY p.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
