"""The eleven KPI queries over the star schema.

Each takes the fact (and the dimensions it joins) and returns the result
set.  Money is summed exactly in DECIMAL and returned as DOUBLE; ratios are
DOUBLE, rounded half away from zero.  Grand totals used for shares are a
scalar subquery over the grouped result (never ``SUM() OVER ()``, which
moves every group into one task).  It sums every column of the groups, so its
exchange equals the main branch's and the fact is read and shuffled once.
Top-k ranks are filtered straight after the ``rank()`` so Spark plans a
partial WindowGroupLimit.  Results come in the order a reader expects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.numeric import money, pct, ratio, round_half_away
from tallyspark.operators.star import order_count


def _sales_aggs(prefix_orders: str = "orders"):
    return [
        order_count().alias(prefix_orders),
        F.sum("revenue").alias("_rev"),
        F.sum("gross_margin").alias("_mar"),
    ]


def _total_revenue(groups: DataFrame, sums: list[str]) -> Column:
    """Sum of ``_rev`` over ``groups`` as a scalar; ``sums`` are all their aggregates."""
    return groups.agg(F.struct(*[F.sum(c).alias(c) for c in sums]).alias("t")).scalar()["_rev"]


def _with_share(df: DataFrame, digits: int, out: str = "revenue_share_pct") -> DataFrame:
    """Share of the grand total."""
    return df.withColumn(out, pct("_rev", _total_revenue(df, df.columns[1:]), digits))


# G1
def kpi_scorecard(fact: DataFrame) -> DataFrame:
    a = fact.agg(
        F.sum("revenue").alias("_rev"), F.sum("gross_margin").alias("_mar"),
        order_count().alias("total_orders"),
        F.sum("quantity").cast("double").alias("total_units_sold"))
    return a.select(
        money("_rev").alias("total_revenue"),
        money("_mar").alias("total_margin"),
        "total_orders",
        round_half_away(ratio("_rev", "total_orders"), 2).alias("avg_ticket"),
        pct("_mar", "_rev", 1).alias("margin_pct"),
        "total_units_sold")


def _previous_growth(df: DataFrame, value: str, order: list[str], out: str) -> DataFrame:
    """(v - lag(v)) / lag(v) * 100 over the previous *present* period.

    The window has no partition key, but it runs over an aggregate with one
    row per period (months/quarters), not over facts.
    """
    w = Window.orderBy(*order)
    prev = F.lag(value).over(w)
    return df.withColumn(out, round_half_away(F.try_divide(F.col(value) - prev, prev) * 100.0, 1))


# G2 (flagship)
def kpi_monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly revenue, margin, orders and MoM growth of the *rounded* revenue.

    The fact is aggregated by ``date_id`` first (one row per day), then joined
    to the calendar — whose size is bounded by the number of days, so the
    broadcast is safe — and rolled up to months.  Distinct orders add up
    across days because an order id has one date in the fact.
    """
    daily = (fact.groupBy("date_id")
                 .agg(order_count().alias("_orders"),
                      F.sum("revenue").alias("_rev"), F.sum("gross_margin").alias("_mar")))
    cal = dim_date.select("date_id", "year", "month", "month_name")
    monthly = (daily.join(F.broadcast(cal), "date_id", "inner")
                    .groupBy("year", "month", "month_name")
                    .agg(money(F.sum("_rev")).alias("revenue"),
                         money(F.sum("_mar")).alias("margin"),
                         F.sum("_orders").alias("orders")))
    return _previous_growth(monthly, "revenue", ["year", "month"], "mom_revenue_growth_pct") \
        .select("year", "month", "month_name", "revenue", "margin", "orders", "mom_revenue_growth_pct") \
        .orderBy("year", "month")


# G3
def kpi_channel(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("channel").agg(*_sales_aggs(), F.sum("quantity").cast("double").alias("units"))
    g = _with_share(g, 1)
    return g.select(
        "channel", "orders", "units",
        money("_rev").alias("revenue"), money("_mar").alias("margin"),
        pct("_mar", "_rev", 1).alias("margin_pct"),
        round_half_away(ratio("_rev", "orders"), 2).alias("avg_ticket"),
        "revenue_share_pct").orderBy(F.desc("revenue"), "channel")


# G4
def _per_key(fact: DataFrame, key: str, *extra) -> DataFrame:
    """Partial result per dimension key, before the dimension join.

    Dimension keys are unique, so joining per-key partials and summing them
    per attribute equals joining the fact rows first; the fact is reduced
    map-side instead of being shuffled row by row into the join.  The inner
    join still drops NULL and orphan keys exactly as the row-level join does.
    """
    return fact.groupBy(key).agg(*_sales_aggs(), *extra)


def kpi_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per = _per_key(fact, "sku", F.sum("unit_price").alias("_ps"), F.count("unit_price").alias("_pn"))
    j = per.join(dim_product.select("sku", "category"), "sku", "inner")
    g = j.groupBy("category").agg(F.sum("orders").alias("orders"), F.sum("_rev").alias("_rev"),
                                  F.sum("_mar").alias("_mar"), F.sum("_ps").alias("_ps"), F.sum("_pn").alias("_pn"))
    return g.select(
        "category", "orders",
        money("_rev").alias("revenue"), money("_mar").alias("margin"),
        pct("_mar", "_rev", 1).alias("margin_pct"),
        round_half_away(ratio("_ps", "_pn"), 2).alias("avg_unit_price")).orderBy(F.desc("margin"), "category")


def _top_by_revenue(g: DataFrame, k: int) -> DataFrame:
    """rank() by exact revenue, ties share a rank, so > k rows are possible."""
    w = Window.orderBy(F.col("_rev").desc())
    return g.withColumn("revenue_rank", F.rank().over(w)).filter(F.col("revenue_rank") <= k)


# G5
def kpi_top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = 10) -> DataFrame:
    per = fact.groupBy("customer_id").agg(*_sales_aggs())
    dims = dim_customer.select("customer_id", "name", "country", "segment")
    g = per.join(dims, "customer_id", "inner")
    total = _total_revenue(per.join(dims.select("customer_id"), "customer_id", "inner"), ["orders", "_rev", "_mar"])
    top = _top_by_revenue(g, k).withColumn("_total", total)
    return top.select(
        "customer_id", "name", "country", "segment", "orders",
        money("_rev").alias("revenue"), money("_mar").alias("margin"),
        round_half_away(ratio("_rev", "orders"), 2).alias("avg_ticket"),
        pct("_rev", "_total", 2).alias("revenue_share_pct"),
        "revenue_rank").orderBy("revenue_rank", "customer_id")


# G6
def kpi_top_products(fact: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    per = fact.groupBy("sku").agg(*_sales_aggs(), F.sum("quantity").cast("double").alias("units_sold"))
    g = per.join(dim_product.select("sku", "category"), "sku", "inner")
    return _top_by_revenue(g, k).select(
        "sku", "category", "orders", "units_sold",
        money("_rev").alias("revenue"), money("_mar").alias("margin"),
        pct("_mar", "_rev", 1).alias("margin_pct"),
        "revenue_rank").orderBy("revenue_rank", "sku")


# G7
def _by_customer_attribute(fact: DataFrame, dim_customer: DataFrame, attr: str) -> DataFrame:
    per = _per_key(fact, "customer_id")
    j = per.join(dim_customer.select("customer_id", attr), "customer_id", "inner")
    # one row per customer after the join: counting rows counts distinct customers
    return j.groupBy(attr).agg(F.sum("orders").alias("orders"), F.count("customer_id").alias("customers"),
                               F.sum("_rev").alias("_rev"), F.sum("_mar").alias("_mar"))


def kpi_country(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    g = _by_customer_attribute(fact, dim_customer, "country")
    return g.select(
        "country", "orders", "customers",
        money("_rev").alias("revenue"), money("_mar").alias("margin"),
        round_half_away(ratio("_rev", "orders"), 2).alias("avg_ticket")).orderBy(F.desc("revenue"), "country")


# G8
def kpi_segment(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    g = _by_customer_attribute(fact, dim_customer, "segment")
    return g.select(
        "segment", "customers", "orders",
        money("_rev").alias("revenue"), money("_mar").alias("margin"),
        round_half_away(ratio("_rev", "orders"), 2).alias("avg_ticket"),
        round_half_away(ratio("_rev", "customers"), 2).alias("revenue_per_customer")).orderBy(F.desc("revenue"), "segment")


# G9
def kpi_quarterly(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Quarterly summary; growth uses the unrounded sum (unlike G2)."""
    daily = (fact.groupBy("date_id")
                 .agg(order_count().alias("_orders"),
                      F.sum("revenue").alias("_rev"), F.sum("gross_margin").alias("_mar")))
    cal = dim_date.select("date_id", "year", "quarter")
    q = (daily.join(F.broadcast(cal), "date_id", "inner")
              .groupBy("year", "quarter")
              .agg(F.sum("_rev").alias("_rev"), F.sum("_mar").alias("_mar"), F.sum("_orders").alias("orders"))
              .withColumn("_revd", money("_rev")))
    q = _previous_growth(q, "_revd", ["year", "quarter"], "qoq_growth_pct")
    return q.select(
        "year", "quarter",
        money("_rev").alias("revenue"), money("_mar").alias("margin"), "orders",
        round_half_away(ratio("_rev", "orders"), 2).alias("avg_ticket"),
        "qoq_growth_pct").orderBy("year", "quarter")


# G10
def kpi_active_status(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Grouped by the stored flag, labelled afterwards: NULL and false are
    two separate 'Inactive' rows, as in the reference."""
    per = _per_key(fact, "sku")
    j = per.join(dim_product.select("sku", "active"), "sku", "inner")
    g = j.groupBy("active").agg(
        F.count("sku").alias("skus"), F.sum("orders").alias("orders"),
        F.sum("_rev").alias("_rev"), F.sum("_mar").alias("_mar"))
    return g.select(
        F.when(F.col("active"), F.lit("Active")).otherwise(F.lit("Inactive")).alias("product_status"),
        "skus", "orders", money("_rev").alias("revenue"), money("_mar").alias("margin"))


# G11
def kpi_returns_audit(stg_orders: DataFrame) -> DataFrame:
    r = stg_orders.filter(F.col("is_return"))
    return r.agg(
        F.lit("Returns (negative qty)").alias("issue_type"),
        F.count(F.lit(1)).alias("row_count"),
        money(F.sum(F.abs("revenue"))).alias("implied_revenue_impact"))
