"""Staging: typed, cleaned tables from the raw layer (one select chain each).

Order of operations follows the reference loader exactly, because it changes
results: dedupe comes *before* validity filters (a bad first row shadows a
good later one), NULL is imputed *before* trimming (a blank-only value ends
up as ''), and counters are taken at the step where the loader takes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.parse import NUMBER_TYPE, to_bool_exact, to_date_lenient, to_number
from tallyspark.functions.text import strip_ws, title_case
from tallyspark.operators.dedupe import keep_first
from tallyspark.operators.stats import exact_median

UNKNOWN = "Unknown"
UNCATEGORIZED = "Uncategorized"

# sees the deduped rows at the step where the loader counts its issues, and passes them on
Watch = Callable[[DataFrame], DataFrame]


def unwatched(df: DataFrame) -> DataFrame:
    return df


# -- single-column operators (B2-B10) -----------------------------------------

def impute_constant(c: str, value: str):
    return F.coalesce(F.col(c), F.lit(value))


def clean_label(c: str, fill: str):
    """NULL -> fill, then trim + title case (B2 then B5)."""
    return title_case(strip_ws(impute_constant(c, fill)))


def normalize_channel(c: str = "channel"):
    return F.lower(strip_ws(F.col(c)))


# -- customers (B16) -------------------------------------------------------------

def stage_customers(raw: DataFrame, watch: Watch = unwatched) -> DataFrame:
    first = watch(keep_first(raw, "customer_id"))
    return first.select(
        "customer_id",
        strip_ws("name").alias("name"),
        clean_label("country", UNKNOWN).alias("country"),
        clean_label("segment", UNKNOWN).alias("segment"),
        to_date_lenient("created_at").alias("created_at"),
    )


# -- products (B17) --------------------------------------------------------------

def typed_products(raw: DataFrame, watch: Watch = unwatched) -> DataFrame:
    first = watch(keep_first(raw, "sku"))
    return first.select(
        "sku",
        impute_constant("category", UNCATEGORIZED).alias("category"),
        F.abs(to_number("cost")).alias("cost"),
        to_bool_exact("active").alias("active"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    """Dedupe, fill category, cost to number, |cost|, NULL cost -> exact median."""
    typed = typed_products(raw)
    return fill_cost(typed, exact_median(typed, "cost", out="_median").select(F.col("_median").cast(NUMBER_TYPE)).scalar())


def fill_cost(typed: DataFrame, median) -> DataFrame:
    """Typed products with their missing costs filled."""
    return typed.select("sku", "category", F.coalesce(F.col("cost"), median).cast(NUMBER_TYPE).alias("cost"), "active")


# -- orders (B18) ----------------------------------------------------------------

ORDER_STAGE_COLUMNS = ["order_id", "customer_id", "sku", "quantity", "unit_price",
                       "order_date", "channel", "is_return", "revenue"]


def typed_orders(raw: DataFrame) -> DataFrame:
    """Deduped raw orders with parsed quantity, price and date (no filters yet)."""
    first = keep_first(raw, "order_id")
    return first.select(
        "order_id", "customer_id", "sku",
        to_number("quantity").alias("quantity"),
        to_number("unit_price").alias("unit_price"),
        to_date_lenient("order_date").alias("order_date"),
        "channel",
    )


def stage_orders(raw: DataFrame, watch: Watch = unwatched) -> DataFrame:
    return stage_typed(watch(typed_orders(raw)))


def stage_typed(t: DataFrame) -> DataFrame:
    """Typed orders without the rows that have no date or no price."""
    return (t.filter(F.col("order_date").isNotNull())
             .filter(F.col("unit_price").isNotNull())
             .select(
                 "order_id", "customer_id", "sku", "quantity", "unit_price", "order_date",
                 normalize_channel("channel").alias("channel"),
                 F.coalesce(F.col("quantity") < 0, F.lit(False)).alias("is_return"),
                 F.try_multiply("quantity", "unit_price").alias("revenue"),
             ))
