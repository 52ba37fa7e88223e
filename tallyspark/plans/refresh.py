"""Full and incremental refresh: build every layer, write it, publish a version.

Each layer is written as Parquet into the folder of a new version and read
back before the next layer is built.  A written layer is a lineage cut: a lost
executor recomputes from the last written table rather than from the raw
files, and later layers never recompute dedupes or joins.  Finished layers
have markers, so a run that failed is taken up after them by running it again
(``layers.Run``).  The version is
published only after every table is written, by a numbered entry in a
publish log that exactly one writer can create, so readers never see a half-built set and two
refreshes never share a number.  Running the refresh again
on the same input gives equal tables (``run_ts`` is a parameter, not the
clock).

Orders, flags, fact and day and month marts are kept by year, customer and product marts and the
aggregates they come from by a hash of the key.  An incremental refresh
(``delta``) names the version it builds on and writes only what its load
changes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.parse import NUMBER_TYPE
from tallyspark.operators import cleaning, marts, quality, state
from tallyspark.operators.cleaning import ORDER_STAGE_COLUMNS, Watch
from tallyspark.operators.quality import ref_integrity
from tallyspark.operators.star import FACT_COLUMNS
from tallyspark.plans import counters, layers
from tallyspark.plans.counters import Counted, read_counters
from tallyspark.plans.layers import Run, Table, current_version, load_chain
from tallyspark.plans.pipeline import EPOCH, Pipeline
from tallyspark.session import shuffles_dropped

__all__ = ["PUBLISHED", "current_version", "load_chain", "published_pipeline", "read_counters", "read_published", "refresh", "register_views"]

KEYS_PER_PART = 1_000_000
FEWEST_PARTS, MOST_PARTS = 8, 4096

PUBLISHED = ["raw_customers", "raw_products", "raw_orders", "stg_customers", "stg_products", "stg_orders",
             "orders_quarantine", "dim_customer", "dim_product", "dim_date", "fact_sales",
             "mart_monthly_summary", "mart_monthly_channel", "mart_customer_lifetime", "mart_product_performance"]


def check_keys(fact: DataFrame, p: Pipeline) -> None:
    """Refuse a set whose keys are not unique: counts of orders, customers and products rely on them."""
    broken = ref_integrity(fact, p.dim_customer, p.dim_product, p.dim_date).where(
        F.col("check_name").endswith("_duplicates") & (F.col("violations") > 0)).collect()
    if broken:
        raise ValueError("keys are not unique: " + ", ".join(f"{r.check_name}={r.violations}" for r in broken))


# -- layers both kinds of refresh write --------------------------------------------

def loaded(run: Run, df: DataFrame) -> DataFrame:
    return df.withColumn("_stg_loaded_at", F.lit(run.run_ts))


def watches() -> dict[str, Counted]:
    return {"customers": Counted(quality.customer_counters()), "products": Counted(quality.product_counters()),
            "orders": Counted(quality.order_counters()), "flags": Counted(quality.flag_counters())}


def only(seen: dict[str, Counted], *reports: str) -> dict[str, Counted]:
    return {r: seen[r] for r in reports}


def median_cost(counts: Table) -> DataFrame:
    return state.median_of_counts(counts.read(), "cost").select(F.col("median").cast(NUMBER_TYPE))


def by_year(spark: SparkSession, flagged: DataFrame, watch: Watch) -> DataFrame:
    """Flagged orders dealt by year and, within a year, by a hash of the order, each file in order of date; nothing is sampled, and a hot year spans many tasks."""
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    year = flagged.withColumn("year", F.year("order_date"))
    return watch(year.repartition("year", F.pmod(F.xxhash64("order_id"), F.lit(spread)))).sortWithinPartitions("year", "order_date")


def order_layers(run: Run, p: Pipeline, flagged: Table, typed: DataFrame) -> dict[str, Table]:
    """The tables that follow from flagged orders, for the years these hold; no row is shuffled."""
    rows = flagged.read(hidden=True)
    p = p.override(flagged_orders=rows, stg_orders_unflagged=rows.select(*ORDER_STAGE_COLUMNS))
    year = lambda df: df.withColumn("year", F.year("order_date"))
    # orders whose customer or cost is not known: a later customer, product or median touches their years
    known = typed.where("cost IS NOT NULL").select(F.col("sku").alias("_known"))
    sku = rows.select("sku", "year").distinct()
    watch = (rows.where("created_at IS NULL").select(F.lit("customer").alias("kind"), F.col("customer_id").alias("key"), "year").distinct()
             .unionByName(sku.join(known, sku["sku"].eqNullSafe(known["_known"]), "left_anti").select(F.lit("sku").alias("kind"), F.col("sku").alias("key"), "year")))
    found = run.together(("fact_sales", year(p.fact_sales), "year"), ("stg_orders", year(loaded(run, p.stg_orders)), "year"),
                         ("orders_quarantine", year(p.orders_quarantine), "year"), ("_watch", watch.repartition("year"), "year"))
    return dict(zip(("fact_sales", "stg_orders", "orders_quarantine", "_watch"), found))


def date_marts(fact: DataFrame) -> list[tuple]:
    daily = marts.mart_daily_channel(fact).withColumn("year", F.floor(F.col("date_id") / 10000).cast("int"))
    return [("mart_monthly_summary", daily.repartition("year"), "year"), ("mart_monthly_channel", marts.mart_monthly_channel(fact).repartition("year"), "year")]


def in_parts(df: DataFrame, key: str, parts: int) -> DataFrame:
    return df.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))


def parts_for(rows: int) -> int:
    parts = FEWEST_PARTS
    while parts < MOST_PARTS and parts * KEYS_PER_PART < rows:
        parts *= 2
    return parts


STATES = (("customer", "customer_id", "mart_customer_lifetime", "dim_customer", marts.customer_lifetime_of),
          ("product", "sku", "mart_product_performance", "dim_product", marts.product_performance_of))


# -- full refresh ------------------------------------------------------------------

def _full(run: Run, raw: dict[str, DataFrame]) -> dict[str, Table]:
    raws = run.together(*[(f"raw_{k}", raw[k]) for k in ("orders", "customers", "products")])
    p = Pipeline(*[t.read() for t in raws], run.run_ts)
    t = dict(zip(("raw_orders", "raw_customers", "raw_products"), raws))
    seen = watches()
    t["stg_customers"], t["_typed_products"] = run.together(
        ("stg_customers", loaded(run, cleaning.stage_customers(p.raw_customers, seen["customers"])), None, only(seen, "customers")),
        ("_typed_products", cleaning.typed_products(p.raw_products, seen["products"]), None, only(seen, "products")))
    typed = t["_typed_products"].read()
    t["_cost_counts"] = run.layer("_cost_counts", state.value_counts(typed, "cost"))
    t["stg_products"] = run.layer("stg_products", loaded(run, cleaning.fill_cost(typed, median_cost(t["_cost_counts"]).scalar())))
    p = p.override(stg_customers=t["stg_customers"].read(), stg_products=t["stg_products"].read(), stg_orders_unflagged=cleaning.stage_orders(p.raw_orders, seen["orders"]))
    # staged orders, flags and looked-up columns, written once; staging, the quarantine, the calendar and the fact all read it
    t["_flagged_orders"] = run.layer("_flagged_orders", by_year(run.spark, p.flagged_orders, seen["flags"]), "year", only(seen, "orders", "flags"))
    t |= order_layers(run, p, t["_flagged_orders"], typed)
    p = p.override(stg_orders_unflagged=t["_flagged_orders"].read().select(*ORDER_STAGE_COLUMNS))
    t["dim_customer"], t["dim_product"], t["dim_date"] = run.together(("dim_customer", p.dim_customer), ("dim_product", p.dim_product), ("dim_date", p.dim_date))
    fact = t["fact_sales"].read()
    check_keys(fact, p.override(**{d: t[d].read() for d in ("dim_customer", "dim_product", "dim_date")}))
    summaries = [(f"_state_{k}", in_parts(state.summarise(fact, key), key, parts_for(t[dim].rows)).repartition("part"), "part") for k, key, _, dim, _ in STATES]
    dated = date_marts(fact)
    t |= dict(zip([x[0] for x in (*summaries, *dated)], run.together(*summaries, *dated)))
    keyed = [(mart, of(t[f"_state_{k}"].read(hidden=True), t[dim].read()).repartition("part"), "part") for k, _, mart, dim, of in STATES]
    return t | dict(zip([x[0] for x in keyed], run.together(*keyed)))


def refresh(spark: SparkSession, raw: dict[str, DataFrame], root: str, version: str,
            run_ts: _dt.datetime = EPOCH, base: str | None = None) -> dict[str, int]:
    """Write all layers of ``raw`` (keys orders/customers/products) into
    ``root/version`` and publish that version.  Returns the row count of
    every published table (the run log); those of the raw tables count the rows of this load.

    A version that was begun and not published goes on after its last finished
    layer when it is run again with the same arguments; a published one is refused.

    With ``base``, a published version, only the rows of ``raw`` that are new
    to it are added, after its own.  ``_ord`` of a load must have the type of its base's."""
    with shuffles_dropped(spark):
        run = Run(spark, root, version, run_ts, base)
        if base:
            from tallyspark.plans.delta import delta
            tables = delta(run, raw, layers.manifest(spark, root, base))
        else:
            tables = _full(run, raw)
        values = {report: counters.staged(report, run.seen[report], run.done[raw_name].rows) for report, (raw_name, *_) in counters.STAGED.items()}
        if "flags" in run.seen:
            values["flags"] = run.seen["flags"]
        kept, replaced = {}, {}
        if base:
            before = layers.manifest(spark, root, base)
            kept = counters.totals(spark, root, base, before)
            if "flags" in values:  # only the years that were written again are read
                replaced = counters.count(before["_flagged_orders"].where([f for _, f, _ in run.done["_flagged_orders"].parts]).read(), quality.flag_counters())
        counts = {name: run.done[name].rows if name.startswith("raw_") else tables[name].rows for name in PUBLISHED}
        run.publish(tables, counts, counters.report(values, kept, replaced))
        return counts


# -- readers -----------------------------------------------------------------------

def _published(tables: dict[str, Table], name: str) -> DataFrame:
    df = tables[name].read()
    return df.select(*FACT_COLUMNS, "year") if name == "fact_sales" else df


def read_published(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A published table; the fact with its folder column ``year``, which date slices prune by."""
    return _published(layers.manifest(spark, root, version or current_version(spark, root)), name)


def published_pipeline(spark: SparkSession, root: str, version: str | None = None) -> Pipeline:
    """A Pipeline whose layers are the published tables (KPIs read these)."""
    tables = layers.manifest(spark, root, version or current_version(spark, root))
    rd = lambda n: _published(tables, n)
    p = Pipeline(rd("raw_orders"), rd("raw_customers"), rd("raw_products"))
    return p.override(stg_customers=rd("stg_customers"), stg_products=rd("stg_products"),
                      stg_orders=rd("stg_orders"), orders_quarantine=rd("orders_quarantine"),
                      dim_customer=rd("dim_customer"), dim_product=rd("dim_product"), dim_date=rd("dim_date"),
                      fact_sales=rd("fact_sales"), mart_daily_channel=rd("mart_monthly_summary"),
                      mart_monthly_channel=rd("mart_monthly_channel"),
                      mart_customer_lifetime=rd("mart_customer_lifetime"),
                      mart_product_performance=rd("mart_product_performance"))


def register_views(spark: SparkSession, root: str, version: str | None = None) -> list[str]:
    """Expose the published tables as temporary views for ``spark.sql``
    (the BI/SQL client path).  Returns the view names."""
    tables = layers.manifest(spark, root, version or current_version(spark, root))
    for name in PUBLISHED:
        _published(tables, name).createOrReplaceTempView(name)
    return list(PUBLISHED)
