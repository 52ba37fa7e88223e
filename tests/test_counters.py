"""Issue counters taken during the writes of a refresh equal the reports that scan the tables."""

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import quality
from tallyspark.plans import counters, layers
from tallyspark.plans import refresh as R
from tests.test_refresh import CUSTOMERS, LOADS, ORDERS, PRODUCTS, raw

DIRTY_ORDERS = ORDERS + [("O1", "C2", "S2", "8", "9", "2022-01-01", "export"), ("O12", "C1", "S1", "-2", "3", "not a date", "retail"), ("O13", "C1", "S1", "-2", "3", "2020-05-05", "retail"),
                         ("O14", "C1", "S1", "1", None, None, "retail"), (None, "C1", "S1", "1", "2", "2017-01-01", None), (None, "C1", "S1", "1", "2", "2017-01-01", None)]
DIRTY_CUSTOMERS = CUSTOMERS + [("C1", "Again", None, None, "x"), ("C7", None, None, None, "2019-13-01")]
DIRTY_PRODUCTS = PRODUCTS + [("S2", "Again", None, None), ("S7", None, "-4.5", "True"), ("S8", "Figs", "many", "no")]


def stored(spark, root, version, column="total"):
    out = {}
    for r in R.read_counters(spark, root, version).collect():
        out.setdefault(r.report, {})[r.counter] = r[column]
    return out


def scanned(spark, inputs, stg_orders, fact):
    out = {"customers": quality.dq_customers(inputs["customers"]), "products": quality.dq_products(inputs["products"]), "orders": quality.dq_orders(inputs["orders"])}
    out = {k: v.first().asDict() for k, v in out.items()}
    out["flags"] = {}
    for r in quality.dq_semantic(stg_orders, fact).collect():
        prefix = {"stg_orders": "staged", "fact_sales": "fact"}[r.scope]
        out["flags"] |= {f"{prefix}_{c}": r[c] for c in ("rows", "pre_signup", "inactive_sale", "below_cost")}
    return out


def check(spark, root, version, inputs):
    read = lambda name: R.read_published(spark, root, name, version)
    assert stored(spark, root, version) == scanned(spark, inputs, read("stg_orders"), read("fact_sales"))


def test_counters_of_full_refresh_and_loads(spark, tmp_path, monkeypatch):
    root, scans = str(tmp_path), []
    real = counters.count
    monkeypatch.setattr(counters, "count", lambda df, c: scans.append(df) or real(df, c))
    orders, customers, products = list(DIRTY_ORDERS), list(DIRTY_CUSTOMERS), list(DIRTY_PRODUCTS)
    inputs = raw(spark, orders, customers, products)
    R.refresh(spark, inputs, root, "v0")
    check(spark, root, "v0", inputs)
    assert stored(spark, root, "v0", "this_run") == stored(spark, root, "v0")
    assert not scans  # all of them were observed in the writes
    for i, (o, c, p) in enumerate(LOADS, 1):
        orders, customers, products = orders + o, customers + c, products + p
        inputs = raw(spark, orders, customers, products)
        R.refresh(spark, inputs, root, f"v{i}", base=f"v{i - 1}")
        check(spark, root, f"v{i}", {k: R.read_published(spark, root, f"raw_{k}", f"v{i}") for k in inputs})
    mine = stored(spark, root, "v1", "this_run")
    assert mine["orders"]["raw_rows"] == 2 and mine["orders"]["duplicate_order_id"] == 1 and mine["customers"]["raw_rows"] == 0
    before = stored(spark, root, "v3")
    R.refresh(spark, inputs, root, "v4", base="v3")  # nothing new
    assert stored(spark, root, "v4") == before and not any(v for r in stored(spark, root, "v4", "this_run").values() for v in r.values())


@pytest.mark.parametrize("rows", [[], [("O1", "C1", "S1", "1", "5", "never", "retail"), ("O2", "C1", "S1", "1", None, "2020-01-01", "retail")]])
def test_counters_where_no_order_is_staged(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(R, "check_keys", lambda *a: None)
    inputs = raw(spark, rows, [], [])
    R.refresh(spark, inputs, str(tmp_path), "v")
    check(spark, str(tmp_path), "v", inputs)


def test_counters_survive_a_failed_run(spark, tmp_path, monkeypatch):
    root, inputs = str(tmp_path), raw(spark, DIRTY_ORDERS, DIRTY_CUSTOMERS, DIRTY_PRODUCTS)
    real = layers.write

    def write(df, path, part):
        if path.endswith("/mart_customer_lifetime"):
            raise RuntimeError("lost")
        real(df, path, part)

    with monkeypatch.context() as m:
        m.setattr(layers, "write", write)
        with pytest.raises(RuntimeError):
            R.refresh(spark, inputs, root, "v")
    R.refresh(spark, inputs, root, "v")
    check(spark, root, "v", inputs)


def test_counters_reported_twice_are_counted_again(spark):
    rows = spark.range(10).select(F.col("id").alias("x"))
    c = counters.Counted([F.count(F.lit(1)).alias("staged_rows"), F.count_if(F.col("x") > 6).alias("big")])
    c(rows).collect()
    assert c.values(10) == {"staged_rows": 10, "big": 3}
    # what an observation says when tasks ran twice
    c.observation = type("Twice", (), {"get": {"staged_rows": 14, "big": 5}})()
    assert c.values(10) == {"staged_rows": 10, "big": 3}


def test_versions_written_without_counters_are_counted(spark, tmp_path):
    root, inputs = str(tmp_path), raw(spark, DIRTY_ORDERS, DIRTY_CUSTOMERS, DIRTY_PRODUCTS)
    R.refresh(spark, inputs, root, "v0")
    want = stored(spark, root, "v0")
    (tmp_path / "v0" / counters.FOLDER).rename(tmp_path / "v0" / "_kept_aside")
    assert counters.totals(spark, root, "v0", layers.manifest(spark, root, "v0")) == want
