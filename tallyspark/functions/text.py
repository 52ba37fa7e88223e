"""String cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens a pandas CSV reader turns into a missing value by
# default (plus the empty cell).  Raw string columns are normalised with them
# so that a CSV scan in Spark sees the same nulls as the original loader.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Blanks of Unicode and the four separator controls, as Python's str.strip.
_WS_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_ASCII_BLANKS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f"
# A run of letters or a run of non-letters; title case capitalises the first
# letter of every letter run, as Python's str.title() does.
_LETTER_RUNS = r"(\p{L}+|\P{L}+)"


def nullify_tokens(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def strip_ws(c: Column | str) -> Column:
    """Trim all leading/trailing whitespace (not only blanks, unlike ``trim``).

    Blanks of ASCII are trimmed without a pattern, which tries every position;
    the pattern sees only what then begins or ends outside ASCII.
    """
    c = F.col(c) if isinstance(c, str) else c
    t = F.btrim(c, F.lit(_ASCII_BLANKS))
    other = (F.ascii(F.left(t, F.lit(1))) > 126) | (F.ascii(F.right(t, F.lit(1))) > 126)
    return F.when(other, F.regexp_replace(t, _WS_EDGES, "")).otherwise(t)


def title_case(c: Column | str) -> Column:
    """Python-style title case: "E-commerce" -> "E-Commerce", "UK" -> "Uk".

    ``initcap`` only splits on blanks, so the string is cut into letter and
    non-letter runs and each run is capitalised separately.
    """
    c = F.col(c) if isinstance(c, str) else c
    runs = F.regexp_extract_all(F.lower(c), F.lit(_LETTER_RUNS), 1)
    return F.array_join(F.transform(runs, lambda w: F.initcap(w)), "")
