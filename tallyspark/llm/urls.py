"""URL filters whose list changes over time.

A list is a log of dated entries (pattern, action, date).  Per pattern the log
becomes validity intervals, and every capture is judged by the entries active
on the day it was fetched.  A pattern is ``d:<domain>`` (the domain and all
below it), ``h:<host>`` (that host alone) or ``p:<host>/<path>`` (that host
and path prefix, whole segments).

The as-of join is an equality join on (pattern, month): intervals are cut at
month ends, so a hot host is spread over its months, meets only the entries of
the month, and skewed partitions can still be split.  Judged once per distinct
(url, date), then joined back.

Edge cases: a NULL or unparsable URL, or a host above 253 characters, matches
nothing; a NULL fetch date matches nothing; for several entries of a pattern
on one day ``add`` wins; an unknown action counts as ``remove``; entries with
a NULL pattern or date are ignored; repeated captures give repeated rows;
empty tables give empty results or unblocked captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyspark.llm.common import table

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))
    return F.when((host != "") & (F.char_length(host) <= 253), F.regexp_replace(host, r"\.$", ""))


def segments_of(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), lambda x: x != "")


def patterns_of(url: Column, depth: int) -> Column:
    """Every pattern that could match a URL; paths to the depth that the list has."""
    host, parts = host_of(url), segments_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    n = F.least(F.size(parts), F.lit(depth))
    paths = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("p:"), host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.concat(domains, F.array(F.concat(F.lit("h:"), host)), paths))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, valid_from, valid_to (exclusive; NULL: still active) from (pattern, action, at)."""
    log = entries.where(F.col("pattern").isNotNull() & F.col("at").isNotNull())
    state = log.groupBy("pattern", "at").agg(F.max(F.coalesce(F.col("action") == "add", F.lit(False))).alias("on"))
    until = F.lead("at").over(Window.partitionBy("pattern").orderBy("at"))
    return state.withColumn("valid_to", until).where("on").select("pattern", F.col("at").alias("valid_from"), "valid_to")


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """Columns of ``captures`` plus n_active, matched (smallest pattern) and blocked, which replace columns of these names."""
    ask = captures.select(F.col(url).alias("__u_url"), F.col(fetched).alias("__u_on")).where(F.col("__u_url").isNotNull() & F.col("__u_on").isNotNull()).distinct()
    held = intervals(entries)
    depth, last = entries.agg(F.max(F.when(F.col("pattern").startswith("p:"), F.size(F.split("pattern", "/")) - 1)), F.max("at")).first()
    last_fetch = captures.agg(F.max(fetched)).first()[0]
    end = max([x for x in (last, last_fetch) if x is not None], default=None)
    month = lambda c: F.trunc(c, "month")
    pieces = held.withColumn("month", F.explode(F.sequence(month(F.col("valid_from")), month(F.coalesce("valid_to", F.lit(end).cast("date"), F.col("valid_from"))), F.expr("interval 1 month"))))
    probes = ask.select("*", F.explode(patterns_of(F.col("__u_url"), depth or 0)).alias("pattern"), month(F.col("__u_on")).alias("month"))
    active = (F.col("__u_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("__u_on") < F.col("valid_to")))
    hits = probes.join(pieces, ["pattern", "month"]).where(active)
    judged = hits.groupBy("__u_url", "__u_on").agg(F.count(F.lit(1)).alias("n_active"), F.min("pattern").alias("matched"))
    joined = captures.join(judged, (captures[url] == judged["__u_url"]) & (captures[fetched] == judged["__u_on"]), "left")
    own = [c for c in captures.columns if c not in ("n_active", "matched", "blocked")]  # columns of these names are replaced
    return joined.select(*[captures[c] for c in own], F.coalesce(judged["n_active"], F.lit(0)).alias("n_active"), judged["matched"], judged["n_active"].isNotNull().alias("blocked"))


def _number(value: Column, at: int, mod: int) -> Column:
    """Number below ``mod`` from eight digits of the md5 of a string."""
    return (F.conv(F.substring(F.md5(value.cast("binary")), at, 7), 16, 10).cast("long") % mod).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day spread over two years, a function of the page id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(730)).cast("int")).alias("fetched_on"))


def list_of(pages: DataFrame) -> DataFrame:
    """A dated list derived from the pages: part of their domains, hosts and first path segments go on it, off it and on again."""
    host, parts = host_of(F.col("url")), segments_of(F.col("url"))
    one = F.when(F.size(parts) > 0, F.concat(F.lit("p:"), host, F.lit("/"), F.get(parts, F.lit(0))))
    named = pages.select(F.explode(F.array(F.concat(F.lit("d:"), F.regexp_replace(host, r"^(?:www|m|blog)\.", "")), F.concat(F.lit("h:"), host), one)).alias("pattern")).where("pattern IS NOT NULL").distinct()
    p = F.col("pattern")
    picked = named.where(_number(p, 1, 4) == 0)
    day = lambda n: F.date_add(F.lit("2023-01-01").cast("date"), n)
    first, gone = _number(p, 8, 500), _number(p, 16, 120) + 1
    step = lambda action, at: F.struct(F.lit(action).alias("action"), at.alias("at"))
    steps = F.array(step("add", day(first)), step("remove", day(first + gone)), step("add", day(first + gone * 2)))
    return picked.select("pattern", F.explode(steps).alias("s")).select("pattern", "s.action", "s.at")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = filter_urls(captures_of(pages), list_of(pages))
    return out.select("page_id", F.col("fetched_on").cast("string").alias("fetched_on"), F.col("n_active").cast("long").alias("n_active"), "matched", "blocked")


SQL = r"""
WITH c AS (
  SELECT page_id, url, DATE '2023-01-01' + (((page_id * 7919) % 730 + 730) % 730)::INT AS fetched_on,
         regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '\.$', '') AS h0,
         list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts
  FROM pages),
h AS (SELECT *, CASE WHEN h0 <> '' AND length(h0) <= 253 THEN h0 END AS host FROM c),
named AS (
  SELECT 'd:' || regexp_replace(host, '^(www|m|blog)\.', '') AS pattern FROM h
  UNION SELECT 'h:' || host FROM h
  UNION SELECT 'p:' || host || '/' || parts[1] FROM h WHERE len(parts) > 0),
picked AS (
  SELECT pattern, (('0x' || substr(md5(pattern), 8, 7))::BIGINT % 500)::INT AS first,
         (('0x' || substr(md5(pattern), 16, 7))::BIGINT % 120)::INT + 1 AS gone
  FROM named WHERE pattern IS NOT NULL AND ('0x' || substr(md5(pattern), 1, 7))::BIGINT % 4 = 0),
held AS (
  SELECT pattern, DATE '2023-01-01' + first AS valid_from, DATE '2023-01-01' + first + gone AS valid_to FROM picked
  UNION ALL SELECT pattern, DATE '2023-01-01' + first + 2 * gone, NULL FROM picked),
hits AS (
  SELECT page_id, count(*) AS n_active, min(pattern) AS matched FROM h JOIN held
    ON ((pattern[1:2] = 'd:' AND (host = pattern[3:] OR ends_with(host, '.' || pattern[3:])))
        OR (pattern[1:2] = 'h:' AND host = pattern[3:])
        OR (pattern[1:2] = 'p:' AND len(parts) > 0 AND host || '/' || parts[1] = pattern[3:]))
    AND fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to)
  GROUP BY page_id)
SELECT page_id, CAST(fetched_on AS VARCHAR) AS fetched_on, coalesce(n_active, 0)::BIGINT AS n_active, matched, n_active IS NOT NULL AS blocked
FROM h LEFT JOIN hits USING (page_id)
"""
