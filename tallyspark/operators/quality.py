"""Data-quality measurement.

Every counter set is one conditional aggregate (``count_if``) so a table is
scanned once per report, never once per counter.  Duplicate counts use a
keyed aggregate with map-side combine; a hot key contributes one partial
row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import pct
from tallyspark.functions.parse import to_date_lenient, to_number
from tallyspark.operators.cleaning import typed_orders
from tallyspark.operators.dedupe import duplicate_count, keep_first


def _with_raw_counts(after: DataFrame, raw: DataFrame, key: str, dup_name: str) -> DataFrame:
    """Prefix ``after`` (one row) with raw_rows and duplicates, taken from one
    keyed aggregate of the raw table evaluated as a scalar subquery."""
    per_key = raw.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    s = per_key.agg(F.struct(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("r"),
                             F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("d"))).scalar()
    return (after.select("*", s.alias("_rc"))
                 .select(F.col("_rc.r").alias("raw_rows"), F.col("_rc.d").alias(dup_name), *after.columns))


def customer_counters() -> list[Column]:
    """On the first raw row of every customer."""
    return [F.count_if(F.col("country").isNull()).alias("null_country"),
            F.count_if(F.col("segment").isNull()).alias("null_segment"),
            F.count_if(to_date_lenient("created_at").isNull()).alias("invalid_created_at"),
            F.count(F.lit(1)).alias("staged_rows")]


def product_counters() -> list[Column]:
    """On the first raw row of every product."""
    cost = to_number("cost")
    return [F.count_if(F.col("category").isNull()).alias("null_category"),
            F.count_if(cost < 0).alias("negative_cost"),
            F.count_if(cost.isNull()).alias("null_cost"),
            F.count(F.lit(1)).alias("staged_rows")]


def order_counters() -> list[Column]:
    """On deduped orders with parsed values, before rows are dropped."""
    dated = F.col("order_date").isNotNull()
    return [F.count_if(~dated).alias("invalid_order_date"),
            F.count_if(dated & (F.col("quantity") < 0)).alias("negative_quantity"),
            F.count_if(dated & F.col("unit_price").isNull()).alias("null_unit_price"),
            F.count_if(dated & F.col("unit_price").isNotNull()).alias("staged_rows")]


def flag_counters() -> list[Column]:
    """On flagged orders: rows and flags of all, then of those that become facts (no returns)."""
    flags = ("pre_signup", "inactive_sale", "below_cost")
    sold = ~F.col("is_return")
    return [F.count(F.lit(1)).alias("staged_rows"), *[F.count_if(f"is_{f}").alias(f"staged_{f}") for f in flags],
            F.count_if(sold).alias("fact_rows"), *[F.count_if(sold & F.col(f"is_{f}")).alias(f"fact_{f}") for f in flags]]


def dq_customers(raw_customers: DataFrame) -> DataFrame:
    after = keep_first(raw_customers, "customer_id").agg(*customer_counters())
    return _with_raw_counts(after, raw_customers, "customer_id", "duplicate_customer_id")


def dq_products(raw_products: DataFrame) -> DataFrame:
    after = keep_first(raw_products, "sku").agg(*product_counters())
    return _with_raw_counts(after, raw_products, "sku", "duplicate_sku")


def dq_orders(raw_orders: DataFrame, typed: DataFrame | None = None) -> DataFrame:
    """Counters in the loader's sequence: duplicates, then invalid dates, then
    negative quantities among dated rows, then missing prices among dated rows.
    ``typed`` are the typed orders of ``raw_orders`` where they are written already."""
    after = (typed_orders(raw_orders) if typed is None else typed).agg(*order_counters())
    return _with_raw_counts(after, raw_orders, "order_id", "duplicate_order_id")


def _flag_counts(df: DataFrame, scope: str) -> DataFrame:
    return df.agg(
        F.lit(scope).alias("scope"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_pre_signup").alias("pre_signup"),
        F.count_if("is_inactive_sale").alias("inactive_sale"),
        F.count_if("is_below_cost").alias("below_cost"))


def dq_semantic(stg_orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Rule-flag counts on staging (returns included, as logged by the
    loader) and on the fact (as reported in the reconciliation)."""
    return _flag_counts(stg_orders, "stg_orders").unionByName(_flag_counts(fact, "fact_sales"))


def dq_waterfall(raw_orders: DataFrame, stg_orders: DataFrame, fact: DataFrame, typed: DataFrame | None = None) -> DataFrame:
    """raw − duplicates − bad dates − no price = staging − returns = fact,
    then the flag shares of the fact, as one long table."""
    d = dq_orders(raw_orders, typed).select("raw_rows", "duplicate_order_id", "invalid_order_date", "null_unit_price")
    s = stg_orders.agg(F.struct(F.count(F.lit(1)).alias("stg_rows"), F.count_if("is_return").alias("returns"),
                                F.count_if("is_pre_signup").alias("quarantined"))).scalar()
    f = fact.agg(F.struct(F.count(F.lit(1)).alias("fact_rows"), F.count_if("is_pre_signup").alias("f_pre"),
                          F.count_if("is_inactive_sale").alias("f_inactive"),
                          F.count_if("is_below_cost").alias("f_below"))).scalar()
    wide = (d.select("*", s.alias("_s"), f.alias("_f"))
             .select(*d.columns, "_s.*", "_f.*"))
    steps = [
        (1, "raw_orders", F.col("raw_rows"), None),
        (2, "duplicate_order_id", -F.col("duplicate_order_id"), None),
        (3, "invalid_order_date", -F.col("invalid_order_date"), None),
        (4, "null_unit_price", -F.col("null_unit_price"), None),
        (5, "stg_orders", F.col("stg_rows"), None),
        (6, "returns", -F.col("returns"), None),
        (7, "fact_sales", F.col("fact_rows"), None),
        (8, "is_pre_signup", F.col("f_pre"), "f_pre"),
        (9, "is_inactive_sale", F.col("f_inactive"), "f_inactive"),
        (10, "is_below_cost", F.col("f_below"), "f_below"),
        (11, "orders_quarantine", F.col("quarantined"), None),
    ]
    structs = [F.struct(F.lit(n).alias("step_no"), F.lit(name).alias("step"), v.cast("bigint").alias("rows"),
                        (pct(share, "fact_rows", 1) if share else F.lit(None).cast("double")).alias("pct_of_fact"))
               for n, name, v, share in steps]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every published table as (table_name, rows)."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ref_integrity(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                  dim_date: DataFrame) -> DataFrame:
    """Violations of the model's many-to-one relations and key uniqueness.

    Orphans use SQL equality (a NULL key never matches), as the BI relations
    and the KPI joins do.
    """
    def orphans(key: str, dim: DataFrame, name: str) -> DataFrame:
        # counted per key first, so that no fact row (and no hot or NULL key) crosses the join row by row
        per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        # (an anti-join would be pushed below the counting)
        known = dim.select(key, F.lit(True).alias("_known"))
        return (per_key.join(known, key, "left")
                       .agg(F.lit(name).alias("check_name"),
                            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias("violations")))

    def dups(df: DataFrame, key: str, name: str) -> DataFrame:
        return duplicate_count(df.select(key), key).select(F.lit(name).alias("check_name"),
                                                           F.col("duplicates").alias("violations"))
    parts = [
        orphans("customer_id", dim_customer, "fact_customer_orphans"),
        orphans("sku", dim_product, "fact_sku_orphans"),
        orphans("date_id", dim_date, "fact_date_orphans"),
        dups(fact, "order_id", "fact_order_id_duplicates"),
        dups(dim_customer, "customer_id", "dim_customer_key_duplicates"),
        dups(dim_product, "sku", "dim_product_key_duplicates"),
        dups(dim_date, "date_id", "dim_date_key_duplicates"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
