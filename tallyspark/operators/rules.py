"""Semantic validation: cross-table business rules and quarantine."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.cleaning import ORDER_STAGE_COLUMNS
from tallyspark.operators.joins import null_safe_left_join

# Fixed value: the reason text stored with quarantined rows.
QUARANTINE_REASON = "order_date < customer created_at"
FLAGS = ["is_pre_signup", "is_inactive_sale", "is_below_cost"]


def flag_orders(stg_orders: DataFrame, stg_customers: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Staged orders with the three rule flags, plus the looked-up
    ``created_at``, ``active`` and ``cost`` that the quarantine and the fact
    need (one product lookup serves both, the reference joins twice).

    A comparison against a missing value is false, never NULL.
    """
    cust = stg_customers.select("customer_id", "created_at")
    prod = stg_products.select("sku", "active", "cost")
    j = null_safe_left_join(stg_orders, cust, "customer_id")
    j = null_safe_left_join(j, prod, "sku")
    return j.select(
        *ORDER_STAGE_COLUMNS, "created_at", "active", "cost",
        F.coalesce(F.col("order_date") < F.col("created_at"), F.lit(False)).alias("is_pre_signup"),
        F.col("active").eqNullSafe(F.lit(False)).alias("is_inactive_sale"),
        F.coalesce(F.col("unit_price") < F.col("cost"), F.lit(False)).alias("is_below_cost"),
    )


def staged_orders_with_flags(flagged: DataFrame) -> DataFrame:
    """The final stg_orders table: staged columns + the three flags."""
    return flagged.select(*ORDER_STAGE_COLUMNS, *FLAGS)


def quarantine(flagged: DataFrame, quarantined_at: _dt.datetime | None = None) -> DataFrame:
    """Copy of pre-signup orders with reason and time (rows stay in staging).

    Only ``is_pre_signup`` is carried: the other flags do not exist yet at
    the point where the reference writes its quarantine.
    """
    ts = quarantined_at or _dt.datetime(1970, 1, 1)
    return (flagged.filter(F.col("is_pre_signup"))
                   .select(*ORDER_STAGE_COLUMNS, "created_at", "is_pre_signup",
                           F.lit(QUARANTINE_REASON).alias("_quarantine_reason"),
                           F.lit(ts).alias("_quarantined_at")))
