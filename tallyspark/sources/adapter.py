"""Driver tables -> string-typed raw inputs with deterministic dirt.

The reference reads three CSV files of text (customers, products, orders).
These builders derive the same shapes from the given TPC-H-style tables so
every layer above runs on data that grows with the input.  The dirt rules
(nulls, bad dates, non-numbers, wrong signs, orphans, late duplicates) are
fixed functions of the keys, so the raw tables are reproducible.

Each raw frame carries ``_ord``: a struct that orders rows as they would be
ordered in the source file.  Keep-first dedupe sorts by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.tables import read_table


def _pad(c, width: int = 7):
    return F.lpad(c.cast("string"), width, "0")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw order line per lineitem row (lineitem ⨝ orders on the order key)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate",
        F.col("_metadata.file_name").alias("_source_file"))
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # Fact-to-fact join: both sides grow with the data, so it is a shuffled
    # sort-merge join at any real scale.  Saying so explicitly also keeps a
    # single-file input from running the whole stage in one scan task.
    j = li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey, "inner")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int")
    return j.select(
        F.concat(F.lit("O"), F.lpad(k.cast("string"), 8, "0"), F.lit("-"), ln.cast("string")).alias("order_id"),
        F.when(k % 997 == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("C"), _pad(F.col("o_custkey")))).alias("customer_id"),
        F.when(F.col("l_partkey") % 501 == 7, F.lit("SKU9999999"))
         .otherwise(F.concat(F.lit("SKU"), _pad(F.col("l_partkey")))).alias("sku"),
        F.when((F.col("l_returnflag") == "R") & (ln == 7), (-qty).cast("string"))
         .when(k % 701 == 5, F.lit("n/d"))
         .when(k % 601 == 5, F.lit("0"))
         .when(k % 409 == 5, F.lit("2.5"))
         .otherwise(qty.cast("string")).alias("quantity"),
        F.when(k % 151 == 0, F.lit(None).cast("string"))
         .when(k % 313 == 7, F.lit("1.005"))
         .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("unit_price"),
        F.when(k % 251 == 0, F.lit("2025-13-40"))
         .otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).alias("order_date"),
        F.concat(F.lit("  "),
                 F.when(F.col("l_suppkey") % 2 == 0, F.upper("o_orderpriority")).otherwise(F.col("o_orderpriority")),
                 F.lit(" ")).alias("channel"),
        F.struct(F.lit(0).alias("src"), "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice").alias("_ord"),
        "_source_file",
    )


def _copies(resent: Column) -> Column:
    """1 for every row, plus a 2 for rows that are sent again later in the
    file: ``explode`` turns one scan into both copies (no second scan)."""
    return F.explode(F.when(resent, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
        F.col("_metadata.file_name").alias("_source_file"))
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    rows = cu.join(na, cu.c_nationkey == na.n_nationkey, "inner").select("*", _copies(k % 50 == 0).alias("_copy"))
    late = F.col("_copy") == 2
    return rows.select(
        F.concat(F.lit("C"), _pad(k)).alias("customer_id"),
        F.when(late, F.concat(F.col("c_name"), F.lit(" (dup)")))
         .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).alias("name"),
        F.when(late, F.lit("Late"))
         .when(k % 40 == 3, F.lit(None).cast("string"))
         .when(k % 3 == 0, F.lower("n_name"))
         .otherwise(F.concat(F.lit(" "), F.col("n_name"))).alias("country"),
        F.when(late, F.lit("Late"))
         .when(k % 41 == 5, F.lit(None).cast("string"))
         .when(F.col("c_mktsegment") == "FURNITURE", F.lit("e-commerce"))
         .otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(late, F.lit("2001-01-01"))
         .when(k % 97 == 11, F.lit("not-a-date"))
         .otherwise(F.date_add(F.lit("1994-06-01").cast("date"), (k % 1200).cast("int")).cast("string"))
         .alias("created_at"),
        F.struct(F.col("_copy").alias("src"), k.alias("key")).alias("_ord"),
        "_source_file",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    pa = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", "p_retailprice",
        F.col("_metadata.file_name").alias("_source_file"))
    k = F.col("p_partkey")
    m = (F.col("p_retailprice").cast("decimal(18,2)") * 12).cast("decimal(18,2)")
    rows = pa.select("*", _copies(k % 50 == 0).alias("_copy"))
    late = F.col("_copy") == 2
    return rows.select(
        F.concat(F.lit("SKU"), _pad(k)).alias("sku"),
        F.when(late, F.lit("Late"))
         .when(k % 30 == 7, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
        F.when(late, F.lit("1.00"))
         .when(k % 67 == 9, F.lit("n/a"))
         .when(k % 20 == 1, (-m).cast("string"))
         .otherwise(m.cast("string")).alias("cost"),
        F.when(late, F.lit("True"))
         .when(k % 333 == 5, F.lit("yes"))
         .when(k % 10 == 0, F.lit("False"))
         .otherwise(F.lit("True")).alias("active"),
        F.struct(F.col("_copy").alias("src"), k.alias("key")).alias("_ord"),
        "_source_file",
    )


def intake_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web-order submissions (all strings) derived from ``orders``; some are
    submitted a second time later (a repeat with a conflicting id)."""
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    rows = od.select("*", _copies(k % 47 == 0).alias("_copy"))
    rep = F.col("_copy") == 2
    return rows.select(
        F.when(rep, F.concat(F.lit("W"), k.cast("string")))
         .when(k % 53 == 0, F.lit("   "))
         .when(k % 59 == 0, F.concat(F.lit("web-order-too-long-"), k.cast("string")))
         .otherwise(F.concat(F.lit(" w"), k.cast("string"), F.lit(" "))).alias("order_id"),
        F.when(rep, F.lit("C0000001"))
         .when(k % 37 == 0, F.lit("X1"))
         .otherwise(F.concat(F.lit("c"), _pad(F.col("o_custkey")))).alias("customer_id"),
        F.when(rep, F.lit("SKU0000001"))
         .when(k % 41 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("sku"), _pad(k % 2000))).alias("sku"),
        F.when(rep, F.lit("1"))
         .when(k % 13 == 0, F.lit("0"))
         .when(k % 17 == 0, F.lit("abc"))
         .when(k % 43 == 0, F.lit("9999"))
         .otherwise((k % 50 + 1).cast("string")).alias("quantity"),
        F.when(rep, F.lit("1.00"))
         .when(k % 19 == 0, F.lit("100001"))
         .when(k % 43 == 0, F.lit("999.99"))
         .otherwise(F.floor(F.col("o_totalprice") / 1000).cast("string")).alias("unit_price"),
        F.when(rep, F.lit("1999-01-01"))
         .when(k % 23 == 0, F.lit("2999-01-01"))
         .when(k % 29 == 0, F.lit("1999/01/01"))
         .otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).alias("order_date"),
        F.when(rep, F.lit("export"))
         .when(k % 31 == 0, F.lit("fax"))
         .when(k % 2 == 0, F.lit(" Retail"))
         .otherwise(F.lit("ECOMMERCE")).alias("channel"),
        F.struct(F.col("_copy").alias("src"), k.alias("key")).alias("_ord"),
    )
