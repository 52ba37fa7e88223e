"""The layered pipeline as one lazy object.

``Pipeline`` holds the three raw inputs and exposes every downstream table as
a lazily built DataFrame.  Nothing runs until a caller writes or collects,
so a query that needs only the fact builds only the fact's lineage and
Catalyst prunes the rest.  ``from_tables`` derives the raw inputs from the
given Parquet tables; ``from_frames`` accepts any raw frames (CSV scans,
merged sources, tests).
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators import cleaning, marts, rules, star
from tallyspark.sources import adapter
from tallyspark.sources.raw import CUSTOMER_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS, to_raw

EPOCH = _dt.datetime(1970, 1, 1)


class Pipeline:
    def __init__(self, raw_orders: DataFrame, raw_customers: DataFrame, raw_products: DataFrame,
                 run_ts: _dt.datetime = EPOCH):
        self.raw_orders = raw_orders
        self.raw_customers = raw_customers
        self.raw_products = raw_products
        self.run_ts = run_ts

    # -- construction -------------------------------------------------------
    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, run_ts: _dt.datetime = EPOCH) -> "Pipeline":
        return cls(
            to_raw(adapter.raw_orders(spark, sf_dir), ORDER_COLUMNS, run_ts),
            to_raw(adapter.raw_customers(spark, sf_dir), CUSTOMER_COLUMNS, run_ts),
            to_raw(adapter.raw_products(spark, sf_dir), PRODUCT_COLUMNS, run_ts),
            run_ts,
        )

    @classmethod
    def from_frames(cls, raw_orders: DataFrame, raw_customers: DataFrame, raw_products: DataFrame,
                    run_ts: _dt.datetime = EPOCH) -> "Pipeline":
        return cls(raw_orders, raw_customers, raw_products, run_ts)

    def override(self, **frames: DataFrame) -> "Pipeline":
        """A copy whose named layers are replaced, e.g. by tables read back
        from storage, so later layers start from written data."""
        p = Pipeline(self.raw_orders, self.raw_customers, self.raw_products, self.run_ts)
        for k, v in self.__dict__.items():
            if k not in ("raw_orders", "raw_customers", "raw_products", "run_ts"):
                p.__dict__[k] = v
        for name, df in frames.items():
            if name in ("raw_orders", "raw_customers", "raw_products"):
                setattr(p, name, df)
            else:
                p.__dict__[name] = df
        return p

    # -- staging ------------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return cleaning.stage_customers(self.raw_customers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return cleaning.stage_products(self.raw_products)

    @cached_property
    def typed_orders(self) -> DataFrame:
        return cleaning.typed_orders(self.raw_orders)

    @cached_property
    def stg_orders_unflagged(self) -> DataFrame:
        return cleaning.stage_typed(self.typed_orders)

    # -- validation ---------------------------------------------------------
    @cached_property
    def flagged_orders(self) -> DataFrame:
        return rules.flag_orders(self.stg_orders_unflagged, self.stg_customers, self.stg_products)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return rules.staged_orders_with_flags(self.flagged_orders)

    @cached_property
    def orders_quarantine(self) -> DataFrame:
        return rules.quarantine(self.flagged_orders, self.run_ts)

    # -- star ---------------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.stg_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(self.stg_products)

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date(self.stg_orders_unflagged)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return star.fact_sales(self.flagged_orders)

    # -- marts --------------------------------------------------------------
    @cached_property
    def mart_daily_channel(self) -> DataFrame:
        return marts.mart_daily_channel(self.fact_sales)

    @cached_property
    def mart_monthly_channel(self) -> DataFrame:
        return marts.mart_monthly_channel(self.fact_sales)

    @cached_property
    def mart_customer_lifetime(self) -> DataFrame:
        return marts.mart_customer_lifetime(self.fact_sales, self.dim_customer)

    @cached_property
    def mart_product_performance(self) -> DataFrame:
        return marts.mart_product_performance(self.fact_sales, self.dim_product)

    # -- published tables ---------------------------------------------------
    def tables(self) -> dict[str, DataFrame]:
        """Every table the refresh publishes, by name."""
        return {
            "raw_customers": self.raw_customers,
            "raw_products": self.raw_products,
            "raw_orders": self.raw_orders,
            "stg_customers": self.stg_customers,
            "stg_products": self.stg_products,
            "stg_orders": self.stg_orders,
            "orders_quarantine": self.orders_quarantine,
            "dim_customer": self.dim_customer,
            "dim_product": self.dim_product,
            "dim_date": self.dim_date,
            "fact_sales": self.fact_sales,
            "mart_monthly_summary": self.mart_daily_channel,
            "mart_monthly_channel": self.mart_monthly_channel,
            "mart_customer_lifetime": self.mart_customer_lifetime,
            "mart_product_performance": self.mart_product_performance,
        }
