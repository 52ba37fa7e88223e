"""BI measures and dashboard result sets.

Measures are expressions over any slice of the fact: ``measures(fact, by)``
groups by whatever columns a visual needs.  DIVIDE semantics: a zero or
missing denominator gives NULL (blank), never an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.numeric import money, ratio
from tallyspark.operators.star import order_count


def total_revenue() -> Column:
    return F.sum("revenue")


def total_margin() -> Column:
    return F.sum("gross_margin")


def measure_columns() -> list[Column]:
    """H1-H5 for one group."""
    return [
        money(total_revenue()).alias("total_revenue"),
        money(total_margin()).alias("total_margin"),
        ratio(total_margin(), total_revenue()).alias("margin_pct"),
        ratio(total_revenue(), order_count()).alias("avg_ticket"),
        order_count().alias("total_orders"),
    ]


def measures(fact: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    return fact.groupBy(*by).agg(*measure_columns()) if by else fact.agg(*measure_columns())


def revenue_clean() -> Column:
    """H6: revenue of rows neither below cost nor pre-signup (blank if none)."""
    keep = ~F.col("is_below_cost") & ~F.col("is_pre_signup")
    return money(F.sum(F.when(keep, F.col("revenue"))))


def below_cost_pct() -> Column:
    """H7: below-cost rows / distinct orders."""
    return ratio(F.count_if("is_below_cost"), order_count())


def calendar_mom(fact: DataFrame) -> DataFrame:
    """H8: month revenue vs the previous *calendar* month (not the previous
    month present): a month after a gap has no comparison."""
    m = (fact.filter(F.col("order_date").isNotNull())
             .groupBy(F.trunc("order_date", "month").alias("month_start"))
             .agg(F.sum("revenue").alias("_rev")))
    prev = m.select(F.col("month_start").alias("_pm"), F.col("_rev").alias("_prev"))
    j = m.join(prev, F.add_months(m.month_start, -1) == prev._pm, "left")
    return j.select(
        "month_start", money("_rev").alias("revenue"), money("_prev").alias("prev_revenue"),
        ratio(F.col("_rev") - F.col("_prev"), F.col("_prev")).alias("revenue_mom_pct"))


def slice_sales(fact: DataFrame, dim_customer: DataFrame | None = None, dim_product: DataFrame | None = None,
                date_from: str | None = None, date_to: str | None = None,
                channels: Sequence[str] | None = None, categories: Sequence[str] | None = None,
                active: Sequence[bool] | None = None, segments: Sequence[str] | None = None,
                countries: Sequence[str] | None = None) -> DataFrame:
    """Dashboard slicers (I4, I7, I10).  Fact-level predicates are applied
    before any join so they reach the scan; a dimension is joined only when
    one of its attributes is sliced on, and its predicate is applied to the
    dimension first so the join sees only the qualifying keys."""
    f = fact
    if "year" in fact.columns:
        # the published fact is stored by year: the bounds prune its folders
        if date_from:
            f = f.filter(F.col("year") >= int(date_from[:4]))
        if date_to:
            f = f.filter(F.col("year") <= int(date_to[:4]))
    if date_from:
        f = f.filter(F.col("order_date") >= F.lit(date_from).cast("date"))
    if date_to:
        f = f.filter(F.col("order_date") <= F.lit(date_to).cast("date"))
    if channels:
        f = f.filter(F.col("channel").isin(list(channels)))
    if categories or active:
        p = dim_product.select("sku", "category", "active")
        if categories:
            p = p.filter(F.col("category").isin(list(categories)))
        if active:
            p = p.filter(F.col("active").isin(list(active)))
        f = f.join(p, "sku", "inner")
    if segments or countries:
        c = dim_customer.select("customer_id", "segment", "country")
        if segments:
            c = c.filter(F.col("segment").isin(list(segments)))
        if countries:
            c = c.filter(F.col("country").isin(list(countries)))
        f = f.join(c, "customer_id", "inner")
    return f


def below_cost_audit(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Every below-cost sale with product and customer context and the
    shortfall (cost − price) × quantity."""
    b = fact.filter(F.col("is_below_cost"))
    b = b.join(dim_product.select("sku", "category", F.col("cost").alias("unit_cost")), "sku", "left")
    b = b.join(dim_customer.select("customer_id", "name"), "customer_id", "left")
    return b.select(
        "order_id", "order_date", "channel", "customer_id", "name", "sku", "category", money("quantity").alias("quantity"),
        money("unit_price").alias("unit_price"), money("unit_cost").alias("unit_cost"),
        money(F.try_multiply(F.col("unit_cost") - F.col("unit_price"), F.col("quantity"))).alias("shortfall"))


def _best(g: DataFrame, label: str, value: str, kind: str) -> DataFrame:
    """Highest ``value``; ties broken by label so the answer is stable.  The
    rank filter is planned as a WindowGroupLimit (top-1 per task first)."""
    w = Window.orderBy(F.col(value).desc(), F.col(label).asc())
    return (g.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
             .select(F.lit(kind).alias("highlight"), F.col(label).cast("string").alias("label"),
                     F.col(value).cast("double").alias("value")))


def highlights(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Leading channel by revenue, best category by margin %, best
    customer by revenue."""
    ch = fact.groupBy("channel").agg(total_revenue().alias("_v"))
    per_sku = fact.groupBy("sku").agg(total_revenue().alias("_r"), total_margin().alias("_m"))
    cat = (per_sku.join(dim_product.select("sku", "category"), "sku", "inner")
                  .groupBy("category").agg(ratio(F.sum("_m"), F.sum("_r")).alias("_v")))
    cu = (fact.groupBy("customer_id").agg(total_revenue().alias("_v"))
              .join(dim_customer.select("customer_id"), "customer_id", "inner"))
    return (_best(ch, "channel", "_v", "top_channel_revenue")
            .unionByName(_best(cat, "category", "_v", "top_category_margin_pct"))
            .unionByName(_best(cu, "customer_id", "_v", "top_customer_revenue")))
