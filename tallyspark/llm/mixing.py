"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same number of expected copies
(target / size of the source).  Documents of a source are put in line, their
expected copies are summed from the front, one offset per source is added, and
a document is emitted once for every integer boundary its share crosses.  The
line is ordered by size class, so the words taken stay near the target.

A hot source is not gathered: documents are ranked inside small cells (source,
size class, salt) and the cells' counts are summed, so the rank in the line is
the cells before plus the rank within the cell.  The number of salts follows
the number of rows.

Edge cases: NULL text has size 0; a NULL source is a source of its own and
comes last; sources of size 0 get target 0; documents without words are taken
like others of their source but add no words; repeated rows are separate
entries; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyspark.llm.common import cut, table, words_of

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = 20240501
CELL_ROWS = 10_000


def _unit(*parts: Column) -> Column:
    """Uniform number in [0, 1) from the md5 of the parts."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("∅")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def source_targets(sizes: DataFrame, weights=WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """source, source_size, target from (source, size): share all words by weight, no target above ``ceiling`` sizes.

    With sources in order of ``ceiling * size / weight`` those at the ceiling
    come first; the level of the others is what is left by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    line = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(line) - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("top", F.lit(float(ceiling)) * F.col("source_size")).withColumn("ratio", F.col("top") / F.col("weight"))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = (per.withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
           .withColumn("rest_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", F.col("rest") / F.col("rest_weight"))
           .withColumn("capped", F.col("ratio") <= F.col("level")))
    # the level is that of the first source below its ceiling
    level = F.min(F.when(~F.col("capped"), F.struct("ratio", "level"))).over(whole)["level"]
    return per.withColumn("target", F.when(F.col("capped"), F.col("top")).otherwise(level * F.col("weight"))).select("source", "source_size", "n", "target")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every document."""
    sized = cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words_of(F.col(text))).cast("long").alias("size")))
    salts = sized.count() // (CELL_ROWS * 16) + 1
    targets = source_targets(sized)
    # sixteenths of an octave, in whole numbers: 16 * floor(log2) + the next four bits
    octave = F.floor(F.log2(F.col("size") + F.lit(1))).cast("int")
    cls = octave * 16 + F.floor((F.col("size") + 1) * 16 / F.pow(F.lit(2.0), octave) - 16).cast("int")
    salt = F.floor(_unit(F.lit(seed), F.col("doc_id"), F.lit("salt")) * salts).cast("long")
    placed = sized.select("*", cls.alias("cls"), salt.alias("salt"))
    cell = Window.partitionBy("source", "cls", "salt").orderBy("size", F.col("doc_id").asc_nulls_last())
    ranked = placed.withColumn("rank", F.row_number().over(cell))
    cells = placed.groupBy("source", "cls", "salt").agg(F.count(F.lit(1)).alias("cell_n"))
    line = Window.partitionBy("source").orderBy("cls", "salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("cell_n").over(line), F.lit(0)))
    cells = cells.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        F.col("c.source").alias("c_source"), F.col("c.cls").alias("c_cls"), F.col("c.salt").alias("c_salt"), "before", "source_size", "target")
    joined = ranked.join(cells, ranked["source"].eqNullSafe(cells["c_source"]) & (ranked["cls"] == cells["c_cls"]) & (ranked["salt"] == cells["c_salt"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("before") + F.col("rank")
    offset = _unit(F.lit(seed), F.col("source"), F.lit("offset"))
    crossed = (F.floor(rate * at + offset) - F.floor(rate * (at - 1) + offset)).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", F.least(crossed, F.lit(CEILING).cast("long")).alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, ([5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS top FROM per),
levels AS (SELECT *, top / weight AS ratio,
    ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(top) OVER before, 0)) / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY top / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, CASE WHEN ratio <= level THEN top
    ELSE (SELECT level FROM levels WHERE ratio > level ORDER BY ratio LIMIT 1) * weight END AS target FROM levels),
u AS (SELECT *, ('0x' || substr(md5('20240501:' || coalesce(source, '∅') || ':offset'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS off,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
n AS (SELECT count(*) // 160000 + 1 AS salts FROM sized),
placed AS (SELECT sized.*, floor(log2(size + 1))::INT AS octave,
    floor(('0x' || substr(md5('20240501:' || doc_id || ':salt'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 * salts)::BIGINT AS salt FROM sized, n),
line AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY octave * 16 + floor((size + 1) * 16 / pow(2.0, octave) - 16)::INT, salt, size, doc_id) AS pos FROM placed)
SELECT doc_id, size, source_size, target,
       (floor(rate * pos + off) - floor(rate * (pos - 1) + off))::BIGINT * size AS taken
FROM line JOIN u ON line.source IS NOT DISTINCT FROM u.source
"""
