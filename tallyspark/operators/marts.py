"""Marts: keyed aggregates of the fact, enriched with dimension attributes.

pandas ``groupby`` drops NULL keys and sums an all-NULL group to 0; both are
kept here.  Aggregation runs before the dimension join, so only one row per
key crosses the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import ratio
from tallyspark.operators.star import order_count


def _zero_sum(c: str):
    return F.coalesce(F.sum(c), F.lit(0))


def mart_daily_channel(fact: DataFrame) -> DataFrame:
    """Per day and channel: distinct orders, revenue, margin, units."""
    return (fact.filter(F.col("date_id").isNotNull() & F.col("channel").isNotNull())
                .groupBy("date_id", "channel")
                .agg(order_count().alias("orders"),
                     _zero_sum("revenue").alias("revenue"),
                     _zero_sum("gross_margin").alias("margin"),
                     _zero_sum("quantity").alias("units")))


def mart_monthly_channel(fact: DataFrame) -> DataFrame:
    """Per calendar month and channel (the documented grain)."""
    return (fact.filter(F.col("order_date").isNotNull() & F.col("channel").isNotNull())
                .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"), "channel")
                .agg(order_count().alias("orders"),
                     _zero_sum("revenue").alias("revenue"),
                     _zero_sum("gross_margin").alias("margin"),
                     _zero_sum("quantity").alias("units")))


def mart_customer_lifetime(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    agg = (fact.filter(F.col("customer_id").isNotNull())
               .groupBy("customer_id")
               .agg(order_count().alias("total_orders"),
                    _zero_sum("revenue").alias("total_revenue"),
                    _zero_sum("gross_margin").alias("total_margin"),
                    ratio(F.sum("revenue"), F.count("revenue")).alias("avg_order_value"),
                    F.min("order_date").alias("first_order"),
                    F.max("order_date").alias("last_order")))
    dims = dim_customer.filter(F.col("customer_id").isNotNull()).select("customer_id", "name", "country", "segment")
    return agg.join(dims, "customer_id", "left")


def mart_product_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    agg = (fact.filter(F.col("sku").isNotNull())
               .groupBy("sku")
               .agg(order_count().alias("total_orders"),
                    _zero_sum("quantity").alias("total_units"),
                    _zero_sum("revenue").alias("total_revenue"),
                    _zero_sum("gross_margin").alias("total_margin")))
    dims = dim_product.filter(F.col("sku").isNotNull())
    return agg.join(dims, "sku", "left")


def customer_lifetime_of(state: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """``mart_customer_lifetime`` from the kept state of customers (and its folder column)."""
    dims = dim_customer.filter(F.col("customer_id").isNotNull()).select("customer_id", "name", "country", "segment")
    agg = state.select("customer_id", F.col("orders").alias("total_orders"), F.col("revenue").alias("total_revenue"), F.col("margin").alias("total_margin"),
                       ratio("revenue", "revenue_n").alias("avg_order_value"), F.col("first").alias("first_order"), F.col("last").alias("last_order"), "part")
    return agg.join(dims, "customer_id", "left")


def product_performance_of(state: DataFrame, dim_product: DataFrame) -> DataFrame:
    """``mart_product_performance`` from the kept state of products (and its folder column)."""
    agg = state.select("sku", F.col("orders").alias("total_orders"), F.col("units").alias("total_units"), F.col("revenue").alias("total_revenue"), F.col("margin").alias("total_margin"), "part")
    return agg.join(dim_product.filter(F.col("sku").isNotNull()), "sku", "left")
