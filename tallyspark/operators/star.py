"""Star schema: dimensions, calendar and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.calendar import calendar_columns, date_id
from tallyspark.functions.numeric import ratio, round_half_away
from tallyspark.operators.rules import FLAGS

# The output schema of the fact.
FACT_COLUMNS = [
    "order_id", "customer_id", "sku", "channel", "date_id", "order_date",
    "quantity", "unit_price", "revenue", "cost_total", "gross_margin", "margin_pct",
    *FLAGS,
]


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select("customer_id", "name", "country", "segment", "created_at")


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("sku", "category", "cost", "active")


def dim_date(stg_orders: DataFrame) -> DataFrame:
    """Every day from Jan 1 of the first order year to Dec 31 of the last
    (returns included).  The only single-task step expands one bounds row;
    its output is bounded by the calendar (366 rows per year), not by data.
    An empty input gives an empty calendar.
    """
    bounds = stg_orders.agg(F.min("order_date").alias("_lo"), F.max("order_date").alias("_hi"))
    days = bounds.filter(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence(F.make_date(F.year("_lo"), F.lit(1), F.lit(1)),
                             F.make_date(F.year("_hi"), F.lit(12), F.lit(31)),
                             F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def fact_sales(flagged: DataFrame) -> DataFrame:
    """Sales without returns; cost from the product lookup already done by the
    rules step (no second join).  A missing cost gives a NULL margin."""
    sales = flagged.filter(~F.col("is_return"))
    cost_total = F.try_multiply("quantity", "cost")
    return sales.select(
        "order_id", "customer_id", "sku", "channel",
        date_id("order_date").alias("date_id"), "order_date",
        "quantity", "unit_price", "revenue",
        cost_total.alias("cost_total"),
        (F.col("revenue") - cost_total).alias("gross_margin"),
        round_half_away(ratio(F.col("revenue") - cost_total, F.col("revenue")), 4).alias("margin_pct"),
        *[(F.coalesce(F.col(f), F.lit(False)) if f in flagged.columns else F.lit(False)).alias(f) for f in FLAGS],
    )


def order_count():
    """COUNT(DISTINCT order_id) of the fact.

    ``order_id`` is the fact's primary key (keep-first dedupe upstream, checked
    by ``ref_integrity``) and dimension joins are on unique keys, so the
    distinct count equals a plain count.  That saves the (group, order_id)
    shuffle a distinct aggregate needs, which at scale moves every fact row.
    """
    return F.count("order_id")
