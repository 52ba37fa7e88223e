"""Hot keys: a third of the rows share one key; results stay exact and whole."""

from pyspark.sql import functions as F

from tallyspark.operators.dedupe import keep_first
from tallyspark.plans import kpis
from tallyspark.plans.pipeline import Pipeline
from tests.helpers import customers, orders, products


def _skewed_orders(spark, n=3000):
    rows = []
    for i in range(n):
        oid = "HOT" if i % 3 == 0 else f"O{i}"          # a third share one order id
        cust = None if i % 3 == 1 else f"C{i % 7}"      # a third have no customer
        rows.append((oid, cust, f"S{i % 5}", str(i % 4 + 1), "10.00", f"2021-0{i % 9 + 1}-15", "web"))
    return rows


def test_hot_keys_give_exact_results(spark):
    o = orders(spark, _skewed_orders(spark)).repartition(6)
    c = customers(spark, [(f"C{i}", f"N{i}", "Peru", "Retail", "2020-01-01") for i in range(7)]
                  + [(None, "nobody", "X", "Y", "2022-01-01")])
    p = products(spark, [(f"S{i}", "Gift", "4.00", "True") for i in range(5)])
    pipe = Pipeline.from_frames(o, c, p)
    stg = pipe.stg_orders
    assert stg.count() == 2001  # 1000 HOT rows collapse to the first one
    hot = stg.filter(F.col("order_id") == "HOT").collect()
    assert len(hot) == 1 and hot[0]["quantity"] == 1 and hot[0]["order_date"].month == 1
    # NULL customers match the NULL-keyed customer row (pandas merge semantics)
    nulls = pipe.flagged_orders.filter(F.col("customer_id").isNull())
    assert nulls.count() == 1000 and nulls.filter("is_pre_signup").count() == 1000
    # KPIs join on SQL equality: NULL customers drop out of the country view
    country = kpis.kpi_country(pipe.fact_sales, pipe.dim_customer).collect()
    assert sum(r["orders"] for r in country) == 2001 - 1000


def test_hot_key_dedupe_keeps_partial_limit(spark):
    o = orders(spark, _skewed_orders(spark))
    txt = keep_first(o, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert txt.count("WindowGroupLimit") >= 1
