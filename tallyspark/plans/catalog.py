"""Query registry: every operator of the inventory as ``(spark, sf_dir) -> DataFrame``.

Each entry builds the pipeline lazily from the given tables and returns a
presentation frame (money as DOUBLE).  ``ORACLE`` holds the DuckDB SQL for
the same result, written independently in ``oracle.py`` style.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.parse import NUMBER_TYPE, to_bool_exact, to_date_lenient, to_number
from tallyspark.operators import cleaning, measures as M, quality
from tallyspark.operators.dedupe import keep_first
from tallyspark.operators.stats import exact_median
from tallyspark.plans import kpis
from tallyspark.plans import oracle as O
from tallyspark.plans import refresh as R
from tallyspark.plans.pipeline import Pipeline
from tallyspark.session import scratch_path, shuffles_dropped
from tallyspark.sources import adapter
from tallyspark.sources import store as S
from tallyspark.sources.raw import CUSTOMER_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS
from tallyspark.streaming import intake as J

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Money leaves the engine as DOUBLE (sums were exact DECIMAL)."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline.from_tables(spark, sf_dir)


def _once(spark: SparkSession, sf_dir: str, purpose: str, *layers: str) -> Pipeline:
    """A pipeline whose staged dimensions, ``layers`` and flagged orders are written once, as a refresh does, and read by every layer that follows."""
    p, root = _p(spark, sf_dir), scratch_path(spark, purpose)
    for name in ("stg_customers", "stg_products", *layers, "flagged_orders"):
        p = p.override(**{name: S.written(getattr(p, name), f"{root}/{name}")})
    return p.override(stg_orders_unflagged=p.flagged_orders.select(*cleaning.ORDER_STAGE_COLUMNS))


def _dbl(cols: list[str], money: set[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols)


# ---------------------------------------------------------------------------
# B: staging
# ---------------------------------------------------------------------------

@register("stg_customers", O.with_ctes("SELECT * FROM stg_customers", "stg_customers"))
def q_stg_customers(spark, sf_dir):
    return present(_p(spark, sf_dir).stg_customers)


@register("stg_products", O.with_ctes("SELECT sku, category, CAST(cost AS DOUBLE) AS cost, active FROM stg_products",
                                      "stg_products"))
def q_stg_products(spark, sf_dir):
    return present(_p(spark, sf_dir).stg_products)


_STG_COLS = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel",
             "is_return", "revenue", "is_pre_signup", "is_inactive_sale", "is_below_cost"]


@register("stg_orders", O.with_ctes(f"SELECT {_dbl(_STG_COLS, {'quantity', 'unit_price', 'revenue'})} FROM stg_orders",
                                    "stg_orders"))
def q_stg_orders(spark, sf_dir):
    return present(_p(spark, sf_dir).stg_orders)


# ---------------------------------------------------------------------------
# D: rules
# ---------------------------------------------------------------------------

_Q_COLS = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel",
           "is_return", "revenue", "created_at", "is_pre_signup", "_quarantine_reason"]


@register("quarantine", O.with_ctes(
    f"SELECT {_dbl(_Q_COLS[:-1], {'quantity', 'unit_price', 'revenue'})}, "
    f"'order_date < customer created_at' AS _quarantine_reason FROM flagged WHERE is_pre_signup", "flagged"))
def q_quarantine(spark, sf_dir):
    return present(_p(spark, sf_dir).orders_quarantine.select(*_Q_COLS))


# ---------------------------------------------------------------------------
# E: star
# ---------------------------------------------------------------------------

@register("dim_customer", O.with_ctes("SELECT * FROM dim_customer", "dim_customer"))
def q_dim_customer(spark, sf_dir):
    return present(_p(spark, sf_dir).dim_customer)


@register("dim_product", O.with_ctes("SELECT sku, category, CAST(cost AS DOUBLE) AS cost, active FROM dim_product",
                                     "dim_product"))
def q_dim_product(spark, sf_dir):
    return present(_p(spark, sf_dir).dim_product)


@register("dim_date", O.with_ctes("SELECT * FROM dim_date", "dim_date"))
def q_dim_date(spark, sf_dir):
    return _p(spark, sf_dir).dim_date


_FACT_COLS = ["order_id", "customer_id", "sku", "channel", "date_id", "order_date", "quantity", "unit_price",
              "revenue", "cost_total", "gross_margin", "margin_pct", "is_pre_signup", "is_inactive_sale",
              "is_below_cost"]
_FACT_MONEY = {"quantity", "unit_price", "revenue", "cost_total", "gross_margin"}


@register("fact_sales", O.with_ctes(f"SELECT {_dbl(_FACT_COLS, _FACT_MONEY)} FROM fact", "fact"))
def q_fact_sales(spark, sf_dir):
    return present(_p(spark, sf_dir).fact_sales)


# ---------------------------------------------------------------------------
# F: marts
# ---------------------------------------------------------------------------

@register("mart_daily_channel", O.with_ctes("""
SELECT date_id, channel, count(DISTINCT order_id) AS orders,
  CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue,
  CAST(coalesce(sum(gross_margin), 0) AS DOUBLE) AS margin,
  CAST(coalesce(sum(quantity), 0) AS DOUBLE) AS units
FROM fact WHERE date_id IS NOT NULL AND channel IS NOT NULL GROUP BY date_id, channel""", "fact"))
def q_mart_daily_channel(spark, sf_dir):
    return present(_p(spark, sf_dir).mart_daily_channel)


@register("mart_monthly_channel", O.with_ctes("""
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, channel,
  count(DISTINCT order_id) AS orders,
  CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue,
  CAST(coalesce(sum(gross_margin), 0) AS DOUBLE) AS margin,
  CAST(coalesce(sum(quantity), 0) AS DOUBLE) AS units
FROM fact WHERE order_date IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2, 3""", "fact"))
def q_mart_monthly_channel(spark, sf_dir):
    return present(_p(spark, sf_dir).mart_monthly_channel)


@register("mart_customer_lifetime", O.with_ctes(f"""
SELECT a.*, d.name, d.country, d.segment FROM (
  SELECT customer_id, count(DISTINCT order_id) AS total_orders,
    CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue,
    CAST(coalesce(sum(gross_margin), 0) AS DOUBLE) AS total_margin,
    {O.ratio('sum(revenue)', 'count(revenue)')} AS avg_order_value,
    min(order_date) AS first_order, max(order_date) AS last_order
  FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id) a
LEFT JOIN dim_customer d ON a.customer_id = d.customer_id""", "fact", "dim_customer"))
def q_mart_customer_lifetime(spark, sf_dir):
    return present(_p(spark, sf_dir).mart_customer_lifetime)


@register("mart_product_performance", O.with_ctes("""
SELECT a.*, d.category, CAST(d.cost AS DOUBLE) AS cost, d.active FROM (
  SELECT sku, count(DISTINCT order_id) AS total_orders,
    CAST(coalesce(sum(quantity), 0) AS DOUBLE) AS total_units,
    CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue,
    CAST(coalesce(sum(gross_margin), 0) AS DOUBLE) AS total_margin
  FROM fact WHERE sku IS NOT NULL GROUP BY sku) a
LEFT JOIN dim_product d ON a.sku = d.sku""", "fact", "dim_product"))
def q_mart_product_performance(spark, sf_dir):
    return present(_p(spark, sf_dir).mart_product_performance)


# ---------------------------------------------------------------------------
# G: KPI queries
# ---------------------------------------------------------------------------

@register("kpi_scorecard", O.with_ctes(f"""
SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(gross_margin) AS DOUBLE) AS total_margin,
  count(DISTINCT order_id) AS total_orders,
  {O.rha(O.ratio('sum(revenue)', 'count(DISTINCT order_id)'), 2)} AS avg_ticket,
  {O.pct('sum(gross_margin)', 'sum(revenue)', 1)} AS margin_pct,
  CAST(sum(quantity) AS DOUBLE) AS total_units_sold
FROM fact""", "fact"))
def q_kpi_scorecard(spark, sf_dir):
    return kpis.kpi_scorecard(_p(spark, sf_dir).fact_sales)


_LAGM = "LAG(revenue) OVER (ORDER BY year, month)"


@register("kpi_monthly_trend", O.with_ctes(f"""
SELECT year, month, month_name, revenue, margin, orders,
  {O.rha(f'(revenue - {_LAGM}) / nullif({_LAGM}, 0) * 100.0', 1)} AS mom_revenue_growth_pct
FROM (
  SELECT d.year, d.month, d.month_name, CAST(sum(f.revenue) AS DOUBLE) AS revenue,
    CAST(sum(f.gross_margin) AS DOUBLE) AS margin, count(DISTINCT f.order_id) AS orders
  FROM fact f JOIN dim_date d ON f.date_id = d.date_id
  GROUP BY d.year, d.month, d.month_name) monthly""", "fact", "dim_date"))
def q_kpi_monthly_trend(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_monthly_trend(p.fact_sales, p.dim_date)


@register("kpi_channel", O.with_ctes(f"""
SELECT channel, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS DOUBLE) AS units,
  CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(gross_margin) AS DOUBLE) AS margin,
  {O.pct('sum(gross_margin)', 'sum(revenue)', 1)} AS margin_pct,
  {O.rha(O.ratio('sum(revenue)', 'count(DISTINCT order_id)'), 2)} AS avg_ticket,
  {O.pct('sum(revenue)', 'sum(sum(revenue)) OVER ()', 1)} AS revenue_share_pct
FROM fact GROUP BY channel""", "fact"))
def q_kpi_channel(spark, sf_dir):
    return kpis.kpi_channel(_p(spark, sf_dir).fact_sales)


@register("kpi_category", O.with_ctes(f"""
SELECT p.category, count(DISTINCT f.order_id) AS orders,
  CAST(sum(f.revenue) AS DOUBLE) AS revenue, CAST(sum(f.gross_margin) AS DOUBLE) AS margin,
  {O.pct('sum(f.gross_margin)', 'sum(f.revenue)', 1)} AS margin_pct,
  {O.rha(O.ratio('sum(f.unit_price)', 'count(f.unit_price)'), 2)} AS avg_unit_price
FROM fact f JOIN dim_product p ON f.sku = p.sku GROUP BY p.category""", "fact", "dim_product"))
def q_kpi_category(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_category(p.fact_sales, p.dim_product)


@register("kpi_top_customers", O.with_ctes(f"""
SELECT * FROM (
  SELECT f.customer_id, c.name, c.country, c.segment, count(DISTINCT f.order_id) AS orders,
    CAST(sum(f.revenue) AS DOUBLE) AS revenue, CAST(sum(f.gross_margin) AS DOUBLE) AS margin,
    {O.rha(O.ratio('sum(f.revenue)', 'count(DISTINCT f.order_id)'), 2)} AS avg_ticket,
    {O.pct('sum(f.revenue)', 'sum(sum(f.revenue)) OVER ()', 2)} AS revenue_share_pct,
    CAST(rank() OVER (ORDER BY sum(f.revenue) DESC) AS INTEGER) AS revenue_rank
  FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id
  GROUP BY f.customer_id, c.name, c.country, c.segment) WHERE revenue_rank <= 10""", "fact", "dim_customer"))
def q_kpi_top_customers(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_top_customers(p.fact_sales, p.dim_customer)


@register("kpi_top_products", O.with_ctes(f"""
SELECT * FROM (
  SELECT f.sku, p.category, count(DISTINCT f.order_id) AS orders, CAST(sum(f.quantity) AS DOUBLE) AS units_sold,
    CAST(sum(f.revenue) AS DOUBLE) AS revenue, CAST(sum(f.gross_margin) AS DOUBLE) AS margin,
    {O.pct('sum(f.gross_margin)', 'sum(f.revenue)', 1)} AS margin_pct,
    CAST(rank() OVER (ORDER BY sum(f.revenue) DESC) AS INTEGER) AS revenue_rank
  FROM fact f JOIN dim_product p ON f.sku = p.sku
  GROUP BY f.sku, p.category) WHERE revenue_rank <= 10""", "fact", "dim_product"))
def q_kpi_top_products(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_top_products(p.fact_sales, p.dim_product)


@register("kpi_country", O.with_ctes(f"""
SELECT c.country, count(DISTINCT f.order_id) AS orders, count(DISTINCT f.customer_id) AS customers,
  CAST(sum(f.revenue) AS DOUBLE) AS revenue, CAST(sum(f.gross_margin) AS DOUBLE) AS margin,
  {O.rha(O.ratio('sum(f.revenue)', 'count(DISTINCT f.order_id)'), 2)} AS avg_ticket
FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY c.country""", "fact", "dim_customer"))
def q_kpi_country(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_country(p.fact_sales, p.dim_customer)


@register("kpi_segment", O.with_ctes(f"""
SELECT c.segment, count(DISTINCT f.customer_id) AS customers, count(DISTINCT f.order_id) AS orders,
  CAST(sum(f.revenue) AS DOUBLE) AS revenue, CAST(sum(f.gross_margin) AS DOUBLE) AS margin,
  {O.rha(O.ratio('sum(f.revenue)', 'count(DISTINCT f.order_id)'), 2)} AS avg_ticket,
  {O.rha(O.ratio('sum(f.revenue)', 'count(DISTINCT f.customer_id)'), 2)} AS revenue_per_customer
FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY c.segment""", "fact", "dim_customer"))
def q_kpi_segment(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_segment(p.fact_sales, p.dim_customer)


_LAGQ = "LAG(CAST(sum(f.revenue) AS DOUBLE)) OVER (ORDER BY d.year, d.quarter)"


@register("kpi_quarterly", O.with_ctes(f"""
SELECT d.year, d.quarter, CAST(sum(f.revenue) AS DOUBLE) AS revenue, CAST(sum(f.gross_margin) AS DOUBLE) AS margin,
  count(DISTINCT f.order_id) AS orders,
  {O.rha(O.ratio('sum(f.revenue)', 'count(DISTINCT f.order_id)'), 2)} AS avg_ticket,
  {O.rha(f'(CAST(sum(f.revenue) AS DOUBLE) - {_LAGQ}) / nullif({_LAGQ}, 0) * 100.0', 1)} AS qoq_growth_pct
FROM fact f JOIN dim_date d ON f.date_id = d.date_id GROUP BY d.year, d.quarter""", "fact", "dim_date"))
def q_kpi_quarterly(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_quarterly(p.fact_sales, p.dim_date)


@register("kpi_active_status", O.with_ctes("""
SELECT CASE WHEN p.active THEN 'Active' ELSE 'Inactive' END AS product_status,
  count(DISTINCT f.sku) AS skus, count(DISTINCT f.order_id) AS orders,
  CAST(sum(f.revenue) AS DOUBLE) AS revenue, CAST(sum(f.gross_margin) AS DOUBLE) AS margin
FROM fact f JOIN dim_product p ON f.sku = p.sku GROUP BY p.active""", "fact", "dim_product"))
def q_kpi_active_status(spark, sf_dir):
    p = _p(spark, sf_dir)
    return kpis.kpi_active_status(p.fact_sales, p.dim_product)


@register("kpi_returns_audit", O.with_ctes("""
SELECT 'Returns (negative qty)' AS issue_type, count(*) AS row_count,
  CAST(sum(abs(revenue)) AS DOUBLE) AS implied_revenue_impact
FROM stg_orders WHERE is_return""", "stg_orders"))
def q_kpi_returns_audit(spark, sf_dir):
    return kpis.kpi_returns_audit(_p(spark, sf_dir).stg_orders)


# ---------------------------------------------------------------------------
# B: single cleaning operators
# ---------------------------------------------------------------------------


@register("dedupe_first", O.with_ctes(f"SELECT {', '.join(ORDER_COLUMNS)} FROM ord_first", "ord_first"))
def q_dedupe_first(spark, sf_dir):
    return keep_first(_p(spark, sf_dir).raw_orders, "order_id").select(*ORDER_COLUMNS)


@register("impute_constant", O.with_ctes("""
SELECT c.customer_id, coalesce(c.country, 'Unknown') AS country, coalesce(c.segment, 'Unknown') AS segment
FROM cust_first c""", "cust_first"))
def q_impute_constant(spark, sf_dir):
    first = keep_first(_p(spark, sf_dir).raw_customers, "customer_id")
    return first.select("customer_id", cleaning.impute_constant("country", cleaning.UNKNOWN).alias("country"),
                        cleaning.impute_constant("segment", cleaning.UNKNOWN).alias("segment"))


@register("coerce_date", O.with_ctes(f"""
SELECT order_id, order_date AS order_date_raw, {O.to_date('order_date')} AS order_date FROM ord_first""",
                                     "ord_first"))
def q_coerce_date(spark, sf_dir):
    first = keep_first(_p(spark, sf_dir).raw_orders, "order_id")
    return first.select("order_id", F.col("order_date").alias("order_date_raw"),
                        to_date_lenient("order_date").alias("order_date"))


@register("coerce_number", O.with_ctes(f"""
SELECT order_id, quantity AS quantity_raw, CAST({O.to_number('quantity')} AS DOUBLE) AS quantity, unit_price AS unit_price_raw,
  CAST({O.to_number('unit_price')} AS DOUBLE) AS unit_price FROM ord_first""", "ord_first"))
def q_coerce_number(spark, sf_dir):
    first = keep_first(_p(spark, sf_dir).raw_orders, "order_id")
    return present(first.select("order_id", F.col("quantity").alias("quantity_raw"),
                                to_number("quantity").alias("quantity"),
                                F.col("unit_price").alias("unit_price_raw"),
                                to_number("unit_price").alias("unit_price")))


@register("title_case", O.with_ctes(f"""
SELECT DISTINCT 'country' AS attribute, country AS raw_value,
  {O.title(O.strip("coalesce(country, 'Unknown')"))} AS clean_value FROM cust_first
UNION
SELECT DISTINCT 'segment', segment, {O.title(O.strip("coalesce(segment, 'Unknown')"))} FROM cust_first""",
                                    "cust_first"))
def q_title_case(spark, sf_dir):
    first = keep_first(_p(spark, sf_dir).raw_customers, "customer_id")
    parts = [first.select(F.lit(a).alias("attribute"), F.col(a).alias("raw_value"),
                          cleaning.clean_label(a, cleaning.UNKNOWN).alias("clean_value"))
             for a in ("country", "segment")]
    return parts[0].unionByName(parts[1]).distinct()


@register("normalize_channel", O.with_ctes(f"""
SELECT channel AS channel_raw, lower({O.strip('channel')}) AS channel, count(*) AS rows
FROM ord_first GROUP BY 1, 2""", "ord_first"))
def q_normalize_channel(spark, sf_dir):
    first = keep_first(_p(spark, sf_dir).raw_orders, "order_id")
    return (first.groupBy(F.col("channel").alias("channel_raw"), cleaning.normalize_channel().alias("channel"))
                 .agg(F.count(F.lit(1)).alias("rows")))


@register("abs_cost", O.with_ctes(f"""
SELECT sku, CAST({O.to_number('cost')} AS DOUBLE) AS cost_parsed, CAST(abs({O.to_number('cost')}) AS DOUBLE) AS cost
FROM prod_first""", "prod_first"))
def q_abs_cost(spark, sf_dir):
    first = keep_first(_p(spark, sf_dir).raw_products, "sku")
    return present(first.select("sku", to_number("cost").alias("cost_parsed"), F.abs(to_number("cost")).alias("cost")))


@register("impute_median", O.with_ctes("""
SELECT CAST(m.med AS DOUBLE) AS median_cost, (SELECT count(*) FROM prod_typed WHERE cost IS NULL) AS imputed_rows
FROM prod_median m""", "prod_median"))
def q_impute_median(spark, sf_dir):
    typed = cleaning.typed_products(_p(spark, sf_dir).raw_products)
    med = exact_median(typed, "cost", out="median_cost").select(F.col("median_cost").cast(NUMBER_TYPE).cast("double")
                                                                 .alias("median_cost"))
    return med.withColumn("imputed_rows", typed.agg(F.count_if(F.col("cost").isNull())).scalar())


@register("map_boolean", O.with_ctes("""
SELECT active AS active_raw, CASE WHEN active = 'True' THEN true WHEN active = 'False' THEN false END AS active,
  count(*) AS rows FROM prod_first GROUP BY 1, 2""", "prod_first"))
def q_map_boolean(spark, sf_dir):
    first = keep_first(_p(spark, sf_dir).raw_products, "sku")
    return (first.groupBy(F.col("active").alias("active_raw"), to_bool_exact("active").alias("active"))
                 .agg(F.count(F.lit(1)).alias("rows")))


@register("flag_returns", O.with_ctes("SELECT is_return, count(*) AS rows FROM stg_orders0 GROUP BY is_return",
                                      "stg_orders0"))
def q_flag_returns(spark, sf_dir):
    return _p(spark, sf_dir).stg_orders_unflagged.groupBy("is_return").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------
# D: rule flags
# ---------------------------------------------------------------------------

@register("flag_pre_signup", O.with_ctes("""
SELECT order_id, customer_id, order_date, created_at, is_pre_signup FROM flagged""", "flagged"))
def q_flag_pre_signup(spark, sf_dir):
    return _p(spark, sf_dir).flagged_orders.select("order_id", "customer_id", "order_date", "created_at",
                                                   "is_pre_signup")


@register("flag_product_rules", O.with_ctes("""
SELECT order_id, sku, CAST(unit_price AS DOUBLE) AS unit_price, active, CAST(cost AS DOUBLE) AS cost,
  is_inactive_sale, is_below_cost FROM flagged""", "flagged"))
def q_flag_product_rules(spark, sf_dir):
    return present(_p(spark, sf_dir).flagged_orders.select("order_id", "sku", "unit_price", "active", "cost",
                                                           "is_inactive_sale", "is_below_cost"))


_FLAGGED_COLS = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel", "is_return",
                 "revenue", "created_at", "active", "cost", "is_pre_signup", "is_inactive_sale", "is_below_cost"]


@register("flagged_orders", O.with_ctes(
    f"SELECT {_dbl(_FLAGGED_COLS, {'quantity', 'unit_price', 'revenue', 'cost'})} FROM flagged", "flagged"))
def q_flagged_orders(spark, sf_dir):
    return present(_p(spark, sf_dir).flagged_orders)


# ---------------------------------------------------------------------------
# C: data quality
# ---------------------------------------------------------------------------

@register("dq_customers", O.with_ctes(f"""
SELECT r.*, a.* FROM
 (SELECT count(*) AS raw_rows, {O.dup_count_sql('customer_id', 'raw_customers')} AS duplicate_customer_id
  FROM raw_customers) r,
 (SELECT count(*) FILTER (WHERE country IS NULL) AS null_country,
         count(*) FILTER (WHERE segment IS NULL) AS null_segment,
         count(*) FILTER (WHERE {O.to_date('created_at')} IS NULL) AS invalid_created_at,
         count(*) AS staged_rows FROM cust_first) a""", "raw_customers", "cust_first"))
def q_dq_customers(spark, sf_dir):
    return quality.dq_customers(_p(spark, sf_dir).raw_customers)


@register("dq_products", O.with_ctes(f"""
SELECT r.*, a.* FROM
 (SELECT count(*) AS raw_rows, {O.dup_count_sql('sku', 'raw_products')} AS duplicate_sku FROM raw_products) r,
 (SELECT count(*) FILTER (WHERE category IS NULL) AS null_category,
         count(*) FILTER (WHERE {O.to_number('cost')} < 0) AS negative_cost,
         count(*) FILTER (WHERE {O.to_number('cost')} IS NULL) AS null_cost,
         count(*) AS staged_rows FROM prod_first) a""", "raw_products", "prod_first"))
def q_dq_products(spark, sf_dir):
    return quality.dq_products(_p(spark, sf_dir).raw_products)


_DQ_ORDERS_SQL = f"""
SELECT r.*, a.* FROM
 (SELECT count(*) AS raw_rows, {O.dup_count_sql('order_id', 'raw_orders')} AS duplicate_order_id FROM raw_orders) r,
 (SELECT count(*) FILTER (WHERE order_date IS NULL) AS invalid_order_date,
         count(*) FILTER (WHERE order_date IS NOT NULL AND quantity < 0) AS negative_quantity,
         count(*) FILTER (WHERE order_date IS NOT NULL AND unit_price IS NULL) AS null_unit_price,
         count(*) FILTER (WHERE order_date IS NOT NULL AND unit_price IS NOT NULL) AS staged_rows
  FROM ord_typed) a"""


@register("dq_orders", O.with_ctes(_DQ_ORDERS_SQL, "raw_orders", "ord_typed"))
def q_dq_orders(spark, sf_dir):
    return quality.dq_orders(_p(spark, sf_dir).raw_orders)


@register("dq_semantic", O.with_ctes("""
SELECT 'stg_orders' AS scope, count(*) AS rows, count(*) FILTER (WHERE is_pre_signup) AS pre_signup,
  count(*) FILTER (WHERE is_inactive_sale) AS inactive_sale, count(*) FILTER (WHERE is_below_cost) AS below_cost
FROM stg_orders
UNION ALL
SELECT 'fact_sales', count(*), count(*) FILTER (WHERE is_pre_signup), count(*) FILTER (WHERE is_inactive_sale),
  count(*) FILTER (WHERE is_below_cost) FROM fact""", "stg_orders", "fact"))
def q_dq_semantic(spark, sf_dir):
    p = _p(spark, sf_dir)
    return quality.dq_semantic(p.stg_orders, p.fact_sales)


def _waterfall_sql() -> str:
    rows = [
        (1, "raw_orders", "raw_rows", None), (2, "duplicate_order_id", "-duplicate_order_id", None),
        (3, "invalid_order_date", "-invalid_order_date", None), (4, "null_unit_price", "-null_unit_price", None),
        (5, "stg_orders", "stg_rows", None), (6, "returns", "-returns", None), (7, "fact_sales", "fact_rows", None),
        (8, "is_pre_signup", "f_pre", "f_pre"), (9, "is_inactive_sale", "f_inactive", "f_inactive"),
        (10, "is_below_cost", "f_below", "f_below"), (11, "orders_quarantine", "quarantined", None),
    ]
    sel = "\nUNION ALL\n".join(
        f"SELECT {n} AS step_no, {O.q(s)} AS step, CAST({v} AS BIGINT) AS rows, "
        f"{O.pct(share, 'fact_rows', 1) if share else 'CAST(NULL AS DOUBLE)'} AS pct_of_fact FROM w"
        for n, s, v, share in rows)
    return f"""
SELECT * FROM (
  WITH w AS (SELECT * FROM ({_DQ_ORDERS_SQL}) d,
     (SELECT count(*) AS stg_rows, count(*) FILTER (WHERE is_return) AS returns,
             count(*) FILTER (WHERE is_pre_signup) AS quarantined FROM stg_orders) s,
     (SELECT count(*) AS fact_rows, count(*) FILTER (WHERE is_pre_signup) AS f_pre,
             count(*) FILTER (WHERE is_inactive_sale) AS f_inactive,
             count(*) FILTER (WHERE is_below_cost) AS f_below FROM fact) f)
  {sel})"""


@register("dq_waterfall", O.with_ctes(_waterfall_sql(), "raw_orders", "ord_typed", "stg_orders", "fact"))
def q_dq_waterfall(spark, sf_dir):
    p = _once(spark, sf_dir, "dq-waterfall", "typed_orders")
    return quality.dq_waterfall(p.raw_orders, p.stg_orders, p.fact_sales, p.typed_orders)


_LAYER_SQL = "\nUNION ALL\n".join(f"SELECT {O.q(name)} AS table_name, count(*) AS rows FROM {cte}" for name, cte in [
    ("raw_customers", "raw_customers"), ("raw_products", "raw_products"), ("raw_orders", "raw_orders"),
    ("stg_customers", "stg_customers"), ("stg_products", "stg_products"), ("stg_orders", "stg_orders"),
    ("orders_quarantine", "orders_quarantine"), ("dim_customer", "dim_customer"), ("dim_product", "dim_product"),
    ("dim_date", "dim_date"), ("fact_sales", "fact"), ("mart_monthly_summary", "mart_daily"),
    ("mart_monthly_channel", "mart_month"), ("mart_customer_lifetime", "mart_clv"), ("mart_product_performance", "mart_prod")])


@register("layer_counts", O.with_ctes(_LAYER_SQL, "raw_customers", "raw_products", "raw_orders", "stg_orders",
                                      "orders_quarantine", "dim_date", "mart_daily", "mart_month", "mart_clv", "mart_prod"))
def q_layer_counts(spark, sf_dir):
    return quality.layer_counts(_once(spark, sf_dir, "layer-counts").tables())


@register("ref_integrity", O.with_ctes(f"""
SELECT 'fact_customer_orphans' AS check_name, count(*) AS violations FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_id = f.customer_id)
UNION ALL SELECT 'fact_sku_orphans', count(*) FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.sku = f.sku)
UNION ALL SELECT 'fact_date_orphans', count(*) FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_id = f.date_id)
UNION ALL SELECT 'fact_order_id_duplicates', {O.dup_count_sql('order_id', 'fact')} FROM fact
UNION ALL SELECT 'dim_customer_key_duplicates', {O.dup_count_sql('customer_id', 'dim_customer')} FROM dim_customer
UNION ALL SELECT 'dim_product_key_duplicates', {O.dup_count_sql('sku', 'dim_product')} FROM dim_product
UNION ALL SELECT 'dim_date_key_duplicates', {O.dup_count_sql('date_id', 'dim_date')} FROM dim_date""",
                                       "fact", "dim_customer", "dim_product", "dim_date"))
def q_ref_integrity(spark, sf_dir):
    p = _once(spark, sf_dir, "ref-integrity")
    return quality.ref_integrity(p.fact_sales, p.dim_customer, p.dim_product, p.dim_date)


# ---------------------------------------------------------------------------
# H: measures
# ---------------------------------------------------------------------------

@register("measures_by_slice", O.with_ctes(f"""
SELECT CAST(year(order_date) AS INTEGER) AS year, channel, {O.measures_sql()} FROM fact GROUP BY 1, 2""", "fact"))
def q_measures_by_slice(spark, sf_dir):
    return M.measures(_p(spark, sf_dir).fact_sales, [F.year("order_date").alias("year"), F.col("channel")])


@register("measure_revenue_clean", O.with_ctes("""
SELECT channel, CAST(sum(revenue) FILTER (WHERE NOT is_below_cost AND NOT is_pre_signup) AS DOUBLE) AS revenue_clean,
  CAST(sum(revenue) AS DOUBLE) AS total_revenue FROM fact GROUP BY channel""", "fact"))
def q_measure_revenue_clean(spark, sf_dir):
    return (_p(spark, sf_dir).fact_sales.groupBy("channel")
            .agg(M.revenue_clean().alias("revenue_clean"), F.sum("revenue").cast("double").alias("total_revenue")))


@register("measure_below_cost_pct", O.with_ctes(f"""
SELECT channel, {O.ratio('count(*) FILTER (WHERE is_below_cost)', 'count(DISTINCT order_id)')} AS below_cost_pct
FROM fact GROUP BY channel""", "fact"))
def q_measure_below_cost_pct(spark, sf_dir):
    return _p(spark, sf_dir).fact_sales.groupBy("channel").agg(M.below_cost_pct().alias("below_cost_pct"))


@register("measure_calendar_mom", O.with_ctes(f"""
SELECT a.month_start, CAST(a.rev AS DOUBLE) AS revenue, CAST(b.rev AS DOUBLE) AS prev_revenue,
  {O.ratio('a.rev - b.rev', 'b.rev')} AS revenue_mom_pct
FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, sum(revenue) AS rev
      FROM fact WHERE order_date IS NOT NULL GROUP BY 1) a
LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, sum(revenue) AS rev
      FROM fact WHERE order_date IS NOT NULL GROUP BY 1) b
  ON b.month_start = CAST(a.month_start - INTERVAL 1 MONTH AS DATE)""", "fact"))
def q_measure_calendar_mom(spark, sf_dir):
    return M.calendar_mom(_p(spark, sf_dir).fact_sales)


# ---------------------------------------------------------------------------
# I: dashboard result sets
# ---------------------------------------------------------------------------

@register("dash_cards", O.with_ctes(f"""
SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(gross_margin) AS DOUBLE) AS total_margin,
  {O.ratio('sum(revenue)', 'count(DISTINCT order_id)')} AS avg_ticket, count(DISTINCT order_id) AS total_orders
FROM fact""", "fact"))
def q_dash_cards(spark, sf_dir):
    return M.measures(_p(spark, sf_dir).fact_sales).select("total_revenue", "total_margin", "avg_ticket",
                                                           "total_orders")


# Fixed slicer settings of the three dashboard pages.
PAGE1 = dict(date_from="1996-01-01", date_to="1998-12-31", channels=["1-urgent", "2-high"],
             categories=["PROMO", "STANDARD"])
PAGE2 = dict(segments=["Machinery", "Building", "E-Commerce"],
             countries=[f"Nation_{i}" for i in range(10)])
PAGE3 = dict(categories=["ECONOMY", "LARGE", "Uncategorized"], active=[False])


@register("dash_sliced_p1", O.with_ctes(f"""
SELECT CAST(year(f.order_date) AS INTEGER) AS year, CAST(month(f.order_date) AS INTEGER) AS month, f.channel,
  {O.measures_sql('f.')}
FROM fact f JOIN dim_product p ON f.sku = p.sku
WHERE f.order_date >= DATE '{PAGE1['date_from']}' AND f.order_date <= DATE '{PAGE1['date_to']}'
  AND f.channel IN {O.in_list(PAGE1['channels'])} AND p.category IN {O.in_list(PAGE1['categories'])}
GROUP BY 1, 2, 3""", "fact", "dim_product"))
def q_dash_sliced_p1(spark, sf_dir):
    p = _p(spark, sf_dir)
    s = M.slice_sales(p.fact_sales, dim_product=p.dim_product, **PAGE1)
    return M.measures(s, [F.year("order_date").alias("year"), F.month("order_date").alias("month"), F.col("channel")])


@register("dash_sliced_p2", O.with_ctes(f"""
SELECT c.segment, c.country, {O.measures_sql('f.')}
FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id
WHERE c.segment IN {O.in_list(PAGE2['segments'])} AND c.country IN {O.in_list(PAGE2['countries'])}
GROUP BY 1, 2""", "fact", "dim_customer"))
def q_dash_sliced_p2(spark, sf_dir):
    p = _p(spark, sf_dir)
    s = M.slice_sales(p.fact_sales, dim_customer=p.dim_customer, **PAGE2)
    return M.measures(s, ["segment", "country"])


@register("dash_sliced_p3", O.with_ctes(f"""
SELECT p.category, p.active, {O.measures_sql('f.')}
FROM fact f JOIN dim_product p ON f.sku = p.sku
WHERE p.category IN {O.in_list(PAGE3['categories'])} AND p.active IN {O.in_list(PAGE3['active'])}
GROUP BY 1, 2""", "fact", "dim_product"))
def q_dash_sliced_p3(spark, sf_dir):
    p = _p(spark, sf_dir)
    s = M.slice_sales(p.fact_sales, dim_product=p.dim_product, **PAGE3)
    return M.measures(s, ["category", "active"])


@register("below_cost_audit", O.with_ctes("""
SELECT f.order_id, f.order_date, f.channel, f.customer_id, c.name, f.sku, p.category, CAST(f.quantity AS DOUBLE) AS quantity,
  CAST(f.unit_price AS DOUBLE) AS unit_price, CAST(p.cost AS DOUBLE) AS unit_cost,
  CAST(CAST((p.cost - f.unit_price) * f.quantity AS DECIMAL(38,4)) AS DOUBLE) AS shortfall
FROM fact f LEFT JOIN dim_product p ON f.sku = p.sku LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
WHERE f.is_below_cost""", "fact", "dim_product", "dim_customer"))
def q_below_cost_audit(spark, sf_dir):
    p = _p(spark, sf_dir)
    return M.below_cost_audit(p.fact_sales, p.dim_customer, p.dim_product)


@register("highlights", O.with_ctes(f"""
SELECT highlight, label, value FROM (
  SELECT 'top_channel_revenue' AS highlight, CAST(channel AS VARCHAR) AS label, CAST(v AS DOUBLE) AS value,
    row_number() OVER (ORDER BY v DESC NULLS LAST, channel ASC NULLS FIRST) AS r
  FROM (SELECT channel, sum(revenue) AS v FROM fact GROUP BY channel)
  UNION ALL
  SELECT 'top_category_margin_pct', category, v,
    row_number() OVER (ORDER BY v DESC NULLS LAST, category ASC NULLS FIRST)
  FROM (SELECT p.category, {O.ratio('sum(f.gross_margin)', 'sum(f.revenue)')} AS v
        FROM fact f JOIN dim_product p ON f.sku = p.sku GROUP BY p.category)
  UNION ALL
  SELECT 'top_customer_revenue', customer_id, CAST(v AS DOUBLE),
    row_number() OVER (ORDER BY v DESC NULLS LAST, customer_id ASC NULLS FIRST)
  FROM (SELECT f.customer_id, sum(f.revenue) AS v FROM fact f
        WHERE EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id) GROUP BY f.customer_id)
) WHERE r = 1""", "fact", "dim_product", "dim_customer"))
def q_highlights(spark, sf_dir):
    p = _once(spark, sf_dir, "highlights")
    return M.highlights(p.fact_sales, p.dim_customer, p.dim_product)


# ---------------------------------------------------------------------------
# J: order intake (batch and stream)
# ---------------------------------------------------------------------------


# Fixture parameters: id patterns of the derived customer/product keys and
# a fixed "today" so results are reproducible.
INTAKE_RULES = J.IntakeRules(customer_pattern=O.INTAKE_CUSTOMER_RE, sku_pattern=O.INTAKE_SKU_RE,
                             as_of=_dt.date.fromisoformat(O.INTAKE_AS_OF))
_STORE_COLS = ["id", "order_id", "customer_id", "sku", "quantity", "unit_price", "revenue", "order_date", "channel"]


def _validated(spark, sf_dir):
    return J.validate(adapter.intake_candidates(spark, sf_dir), INTAKE_RULES)


def _store(spark, sf_dir):
    accepted, _ = J.accept(_validated(spark, sf_dir))
    return J.insert(accepted, J.empty_store(spark), _dt.datetime(1970, 1, 1))


@register("intake_validate", O.with_ctes("""
SELECT order_id, customer_id, sku, quantity, CAST(unit_price AS DOUBLE) AS unit_price, order_date, channel,
  n_errors, is_valid FROM intake_norm""", "intake_norm"))
def q_intake_validate(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return present(v.select("order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel",
                            F.size("errors").alias("n_errors"), "is_valid"))


def _errors_sql() -> str:
    fields = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel", "revenue"]
    union = "\n  UNION ALL ".join(f"SELECT '{f}' AS field, e_{f} AS code FROM cand_valid WHERE e_{f} IS NOT NULL"
                                  for f in fields)
    msgs = ", ".join(f"({O.q(k)}, {O.q(v)})" for k, v in J.MESSAGES.items())
    return f"""
SELECT e.field, e.code, count(*) AS failures, m.message
FROM ({union}) e JOIN (VALUES {msgs}) m(code, message) ON e.code = m.code
GROUP BY e.field, e.code, m.message"""


@register("intake_errors", O.with_ctes(_errors_sql(), "cand_valid"))
def q_intake_errors(spark, sf_dir):
    return J.error_report(_validated(spark, sf_dir))


@register("intake_dedupe", O.with_ctes("""
SELECT order_id, customer_id, sku, quantity, CAST(unit_price AS DOUBLE) AS unit_price, order_date, channel
FROM intake_accepted""", "intake_accepted"))
def q_intake_dedupe(spark, sf_dir):
    accepted, _ = J.accept(_validated(spark, sf_dir))
    return present(accepted.select("order_id", "customer_id", "sku", "quantity", "unit_price", "order_date",
                                   "channel"))


@register("intake_insert", O.with_ctes(f"SELECT {O.STORE_OUT} FROM intake_store", "intake_store"))
def q_intake_insert(spark, sf_dir):
    return J.response(_store(spark, sf_dir)).select(*_STORE_COLS)


@register("orders_page", O.with_ctes(
    f"SELECT {O.STORE_OUT} FROM intake_store WHERE channel = 'retail' ORDER BY id DESC LIMIT 50 OFFSET 10",
    "intake_store"))
def q_orders_page(spark, sf_dir):
    return J.list_orders(_store(spark, sf_dir), limit=50, offset=10, channel="retail").select(*_STORE_COLS)


_LOOKUP_KEYS_SQL = "SELECT upper(lower(order_id)) AS k FROM cand WHERE channel = 'export'"


def _lookup_keys(spark, sf_dir):
    c = adapter.intake_candidates(spark, sf_dir)
    return c.filter(F.col("channel") == "export").select(F.lower("order_id").alias("order_id"))


@register("order_lookup", O.with_ctes(
    f"SELECT {O.STORE_OUT} FROM intake_store s WHERE EXISTS ({_LOOKUP_KEYS_SQL} AND upper(lower(order_id)) = s.order_id)",
    "intake_store", "cand"))
def q_order_lookup(spark, sf_dir):
    return J.get_orders(_store(spark, sf_dir), _lookup_keys(spark, sf_dir)).select(*_STORE_COLS)


@register("orders_delete", O.with_ctes(
    f"SELECT {O.STORE_OUT} FROM intake_store s "
    f"WHERE NOT EXISTS ({_LOOKUP_KEYS_SQL} AND upper(lower(order_id)) = s.order_id)",
    "intake_store", "cand"))
def q_orders_delete(spark, sf_dir):
    remaining, _ = J.delete_orders(_store(spark, sf_dir), _lookup_keys(spark, sf_dir))
    return J.response(remaining).select(*_STORE_COLS)


@register("orders_delete_report", O.with_ctes(f"""
SELECT k AS order_id, count(s.order_id) AS deleted
FROM (SELECT DISTINCT k FROM ({_LOOKUP_KEYS_SQL})) LEFT JOIN intake_store s ON s.order_id = k
GROUP BY k""", "intake_store", "cand"))
def q_orders_delete_report(spark, sf_dir):
    """The stored orders are written as a store of the intake; the delete is kept beside it."""
    from tallyspark.streaming.orderstore import create_store, current, delete_stored, write_batch
    path = scratch_path(spark, "delete-store") + "/store"
    create_store(spark, path)
    write_batch(spark, current(spark, path), "first", _store(spark, sf_dir))
    return delete_stored(spark, path, _lookup_keys(spark, sf_dir))


def _dropped(spark, sf_dir, src, copies):
    """Drop files with the seven fields of the form; their names follow the order of submission."""
    c = adapter.intake_candidates(spark, sf_dir).filter(F.col("_ord.src").isin(copies))
    c.orderBy("_ord").drop("_ord").write.mode("append").json(src)


@register("intake_rejected", O.with_ctes(f"""
SELECT {', '.join(J.CANDIDATE_COLUMNS)}, CASE WHEN is_valid THEN 1 ELSE n_errors END AS n_errors
FROM cand_valid c WHERE NOT EXISTS (SELECT 1 FROM intake_accepted a WHERE a.s1 = c.s1 AND a.s2 = c.s2)""",
                                         "cand_valid", "intake_accepted"))
def q_intake_rejected(spark, sf_dir):
    """Invalid and conflicting submissions of the stream, every value as submitted."""
    from tallyspark.streaming.stream import run_intake_stream
    base = scratch_path(spark, "intake-rejected")
    _dropped(spark, sf_dir, base + "/incoming", [1, 2])
    paths = run_intake_stream(spark, base + "/incoming", base + "/out", INTAKE_RULES, _dt.datetime(1970, 1, 1))
    return spark.read.parquet(paths["rejected"]).select(*J.CANDIDATE_COLUMNS, F.size("errors").alias("n_errors"))


@register("intake_stream_multi", O.with_ctes(f"SELECT {O.STORE_OUT} FROM intake_store", "intake_store"))
def q_intake_stream_multi(spark, sf_dir):
    """Three drops into one folder, each a run of its own; the last one sends all submissions again."""
    from tallyspark.streaming.stream import read_store, run_intake_stream
    base = scratch_path(spark, "intake-multi")
    for copies in ([1], [2], [1, 2]):
        _dropped(spark, sf_dir, base + "/incoming", copies)
        paths = run_intake_stream(spark, base + "/incoming", base + "/out", INTAKE_RULES, _dt.datetime(1970, 1, 1))
    return J.response(read_store(spark, paths["store"])).select(*_STORE_COLS)


@register("intake_stream", O.with_ctes(f"SELECT {O.STORE_OUT} FROM intake_store", "intake_store"))
def q_intake_stream(spark, sf_dir):
    """Candidates are dropped as JSON files into a shared folder and consumed
    by the streaming job; the stored table must equal the batch insert."""
    from tallyspark.streaming.stream import read_store, run_intake_stream
    base = scratch_path(spark, "intake-stream")
    src = base + "/incoming"
    # the seven fields of the form, in files whose names follow the order of submission
    adapter.intake_candidates(spark, sf_dir).orderBy("_ord").drop("_ord").write.mode("overwrite").json(src)
    paths = run_intake_stream(spark, src, base + "/out", INTAKE_RULES, _dt.datetime(1970, 1, 1))
    return J.response(read_store(spark, paths["store"])).select(*_STORE_COLS)


# ---------------------------------------------------------------------------
# A: scans, lineage, publish, refresh, incremental, web merge
# ---------------------------------------------------------------------------


_EPOCH = _dt.datetime(1970, 1, 1)


def _adapter_sources(spark, sf_dir):
    return {"orders": adapter.raw_orders(spark, sf_dir), "customers": adapter.raw_customers(spark, sf_dir),
            "products": adapter.raw_products(spark, sf_dir)}


def _landed_raw(spark, sf_dir, purpose):
    """Adapter output written as CSV files (the landing zone) and scanned back."""
    paths = S.land_inputs(_adapter_sources(spark, sf_dir), scratch_path(spark, purpose))
    return S.scan_landing(spark, paths, _EPOCH)


@register("raw_scan", O.with_ctes(f"SELECT {', '.join(ORDER_COLUMNS)} FROM raw_orders", "raw_orders"))
def q_raw_scan(spark, sf_dir):
    return _landed_raw(spark, sf_dir, "raw-scan")["orders"].select(*ORDER_COLUMNS)


def _lineage_sql() -> str:
    parts = []
    for table, cte_name, src, cols in (("raw_orders", "raw_orders", "lineitem.parquet", ORDER_COLUMNS),
                                       ("raw_customers", "raw_customers", "customer.parquet", CUSTOMER_COLUMNS),
                                       ("raw_products", "raw_products", "part.parquet", PRODUCT_COLUMNS)):
        parts.append(f"SELECT '{table}' AS table_name, '{src}' AS _source_file, count(*) AS rows, "
                     f"count(DISTINCT {O._hash(cols)}) AS distinct_hashes FROM {cte_name}")
    return "\nUNION ALL\n".join(parts)


@register("raw_lineage", O.with_ctes(_lineage_sql(), "raw_orders", "raw_customers", "raw_products"))
def q_raw_lineage(spark, sf_dir):
    p = _p(spark, sf_dir)
    out = None
    for name, df in (("raw_orders", p.raw_orders), ("raw_customers", p.raw_customers),
                     ("raw_products", p.raw_products)):
        g = df.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"),
                                           F.count_distinct("_row_hash").alias("distinct_hashes"))
        g = g.select(F.lit(name).alias("table_name"), "_source_file", "rows", "distinct_hashes")
        out = g if out is None else out.unionByName(g)
    return out


@register("row_hash", O.with_ctes(f"SELECT order_id, {O._hash(ORDER_COLUMNS)} AS _row_hash FROM raw_orders",
                                  "raw_orders"))
def q_row_hash(spark, sf_dir):
    return _p(spark, sf_dir).raw_orders.select("order_id", "_row_hash")


@register("publish_roundtrip", ORACLE["fact_sales"])
def q_publish_roundtrip(spark, sf_dir):
    raw = _landed_raw(spark, sf_dir, "publish-landing")
    root = scratch_path(spark, "publish")
    R.refresh(spark, raw, root, "v1")
    return present(R.read_published(spark, root, "fact_sales").drop("year"))


@register("refresh_idempotent", O.with_ctes(_LAYER_SQL.replace("AS rows FROM", "AS rows, CAST(0 AS BIGINT) AS diff_rows FROM"),
                                            "raw_customers", "raw_products", "raw_orders", "stg_orders",
                                            "orders_quarantine", "dim_date", "mart_daily", "mart_month", "mart_clv", "mart_prod"))
def q_refresh_idempotent(spark, sf_dir):
    raw = _landed_raw(spark, sf_dir, "idem-landing")
    root = scratch_path(spark, "idempotent")
    R.refresh(spark, raw, root, "run1")
    R.refresh(spark, raw, root, "run2")
    out = None
    for name in R.PUBLISHED:
        a = R.read_published(spark, root, name, "run1")
        b = R.read_published(spark, root, name, "run2")
        row = S.table_diff(a, b).select(F.lit(name).alias("table_name"),
                                        a.agg(F.count(F.lit(1))).scalar().alias("rows"), "diff_rows")
        with shuffles_dropped(spark):  # one table after the other: only one is in shuffle files at a time
            row = S.written(row, scratch_path(spark, "idempotent-diff"))
        out = row if out is None else out.unionByName(row)
    return out


_WEB_EXPORT_SQL = ("SELECT order_id, customer_id, sku, CAST(quantity AS VARCHAR) AS quantity, "
                   "CAST(CAST(unit_price AS DECIMAL(18,10)) AS VARCHAR) AS unit_price, CAST(order_date AS VARCHAR) AS order_date, channel, "
                   "id FROM intake_store")


@register("web_export", O.with_ctes(
    f"SELECT {', '.join(ORDER_COLUMNS)} FROM ({_WEB_EXPORT_SQL})", "intake_store"))
def q_web_export(spark, sf_dir):
    path = scratch_path(spark, "web-export")
    S.write_csv(S.web_export(_store(spark, sf_dir)), path)
    return spark.read.schema(", ".join(f"{c} string" for c in ORDER_COLUMNS)).option("header", True).csv(path)


def _web_raw(spark, sf_dir):
    return S.web_orders_as_raw(spark, _store(spark, sf_dir), scratch_path(spark, "web-landing"), _EPOCH)


@register("incremental_append", O.with_ctes(f"""
SELECT {', '.join(ORDER_COLUMNS)}, h AS _row_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY id) AS rn FROM (
    SELECT *, {O._hash(ORDER_COLUMNS)} AS h FROM ({_WEB_EXPORT_SQL})) w
  WHERE NOT EXISTS (SELECT 1 FROM raw_orders r WHERE {O._hash(['r.' + c for c in ORDER_COLUMNS])} = w.h))
WHERE rn = 1""", "intake_store", "raw_orders"))
def q_incremental_append(spark, sf_dir):
    with shuffles_dropped(spark):
        hist = S.written(_p(spark, sf_dir).raw_orders, scratch_path(spark, "append-history"))
        incoming = S.union_in_order([hist, _web_raw(spark, sf_dir)])
    return S.appended(hist, incoming, scratch_path(spark, "append-new")).select(*ORDER_COLUMNS, "_row_hash")


_STG0_COLS = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel", "is_return",
              "revenue"]


@register("web_merge", O.with_ctes(f"""
SELECT {_dbl(_STG0_COLS, {'quantity', 'unit_price', 'revenue'})} FROM (
  SELECT {', '.join(_STG0_COLS)} FROM stg_orders0
  UNION ALL
  SELECT order_id, customer_id, sku, quantity, unit_price, order_date, channel, coalesce(quantity < 0, false),
    quantity * unit_price FROM intake_store)""", "stg_orders0", "intake_store"))
def q_web_merge(spark, sf_dir):
    merged = S.union_in_order([_p(spark, sf_dir).raw_orders, _web_raw(spark, sf_dir)])
    return present(cleaning.stage_orders(merged))


_WITH_WEB = {
    "stg_base": O.CTES["stg_orders0"],
    "stg_orders0": (["stg_base", "intake_store"], """
SELECT * FROM stg_base UNION ALL
SELECT order_id, customer_id, sku, quantity, unit_price, order_date, channel, coalesce(quantity < 0, false) AS is_return,
  quantity * unit_price AS revenue FROM intake_store"""),
}
_FACT_WITH_WEB_SQL = O.with_ctes(f"SELECT {_dbl(_FACT_COLS, _FACT_MONEY)} FROM fact", "fact", **_WITH_WEB)


@register("refresh_with_web", _FACT_WITH_WEB_SQL)
def q_refresh_with_web(spark, sf_dir):
    """A full refresh that takes the stored web orders after the order files."""
    raw = _landed_raw(spark, sf_dir, "web-refresh-landing")
    raw["orders"] = S.in_sequence([raw["orders"], _web_raw(spark, sf_dir)])
    root = scratch_path(spark, "web-refresh")
    R.refresh(spark, raw, root, "v1")
    return present(R.read_published(spark, root, "fact_sales").drop("year"))


_COUNTED = {"customers": ("raw_rows", "duplicate_customer_id", "null_country", "null_segment", "invalid_created_at", "staged_rows"),
            "products": ("raw_rows", "duplicate_sku", "null_category", "negative_cost", "null_cost", "staged_rows"),
            "orders": ("raw_rows", "duplicate_order_id", "invalid_order_date", "negative_quantity", "null_unit_price", "staged_rows")}


def _refresh_counters_sql() -> str:
    """The counter reports of their own queries, one row per counter."""
    parts, reports = [], []
    for name, counters in _COUNTED.items():
        reports.append(f"{name}_r AS (SELECT * FROM ({ORACLE[f'dq_{name}']}) x)")
        parts += [f"SELECT '{name}' AS report, '{c}' AS counter, {c}::BIGINT AS total FROM {name}_r" for c in counters]
    reports.append(f"flags_r AS (SELECT * FROM ({ORACLE['dq_semantic']}) x)")
    for scope, prefix in (("stg_orders", "staged"), ("fact_sales", "fact")):
        parts += [f"SELECT 'flags', '{prefix}_{c}', {c}::BIGINT FROM flags_r WHERE scope = '{scope}'" for c in ("rows", "pre_signup", "inactive_sale", "below_cost")]
    return "WITH " + ", ".join(reports) + " " + " UNION ALL ".join(parts)


@register("refresh_counters", _refresh_counters_sql())
def q_refresh_counters(spark, sf_dir):
    """Counters that a full refresh took while it wrote its layers."""
    p = _p(spark, sf_dir)
    root = scratch_path(spark, "counters")
    R.refresh(spark, {"orders": p.raw_orders, "customers": p.raw_customers, "products": p.raw_products}, root, "v1")
    return R.read_counters(spark, root, "v1").select("report", "counter", "total")


@register("refresh_incremental", _FACT_WITH_WEB_SQL)
def q_refresh_incremental(spark, sf_dir):
    """A full refresh of the files, then an incremental one of the same files and the stored web orders."""
    raw = _landed_raw(spark, sf_dir, "incremental-landing")
    root = scratch_path(spark, "incremental")
    R.refresh(spark, raw | {"orders": S.in_sequence([raw["orders"]])}, root, "v1")
    R.refresh(spark, raw | {"orders": S.in_sequence([raw["orders"], _web_raw(spark, sf_dir)])}, root, "v2", base="v1")
    return present(R.read_published(spark, root, "fact_sales").drop("year"))
