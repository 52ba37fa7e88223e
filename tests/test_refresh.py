"""Refresh: taking up a failed run, publishing side by side, loads that write only what they change."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import state
from tallyspark.operators.stats import exact_median
from tallyspark.plans import layers
from tallyspark.plans import refresh as R
from tallyspark.plans.pipeline import Pipeline
from tallyspark.sources import commitlog
from tallyspark.sources import store as S
from tests import helpers as H

ORDERS = [("O1", "C1", "S1", "1", "5", "2019-01-02", "retail"), ("O2", "C2", "S2", "2", "9.5", "2019-06-02", "export"), ("O3", "C9", "S1", "3", "1", "2020-03-04", "retail"),
          ("O4", "C1", "S9", "1", "5", "2021-01-02", "retail"), ("O5", "C1", "S3", "-1", "5", "2021-02-02", "retail"), ("O6", None, "S3", "4", "2.25", "2021-02-03", None), ("O7", "C2", "S2", "1", "bad", "2019-06-03", "export"),
          ("O8", "C2", "S1", "2", "7", "2022-08-09", "wholesale")]
CUSTOMERS = [("C1", "Ann", "Peru", "Retail", "2018-01-01"), ("C2", "Bo", None, "Export", "2019-06-10")]
PRODUCTS = [("S1", "Roses", "1", "True"), ("S2", "Tulips", "3", "False"), ("S3", None, None, "True")]


def raw(spark, orders, customers, products):
    return {"orders": S.in_sequence([H.orders(spark, orders)]), "customers": S.in_sequence([H.customers(spark, customers)]), "products": S.in_sequence([H.products(spark, products)])}


def rows(df):
    kept = [c for c in df.columns if c not in ("_stg_loaded_at", "_quarantined_at", "_ord")]
    return sorted(repr(tuple(r)) for r in df.select(*kept).collect())


def same(spark, root, a, b, names=R.PUBLISHED):
    for name in names:
        assert rows(R.read_published(spark, root, name, a)) == rows(R.read_published(spark, root, name, b)), name


@pytest.mark.parametrize("kind", ["full", "incremental"])
def test_a_failed_run_is_taken_up_after_its_last_layer(spark, tmp_path, monkeypatch, kind):
    root, inputs = str(tmp_path), raw(spark, ORDERS, CUSTOMERS, PRODUCTS)
    more = raw(spark, ORDERS + [("O9", "C9", "S9", "1", "4", "2021-05-05", "retail")], CUSTOMERS + [("C9", "Cy", "Chad", "Retail", "2021-01-01")], PRODUCTS + [("S9", "Figs", "9", "True")])
    R.refresh(spark, inputs, root, "v0")
    args = (more, root) if kind == "incremental" else (inputs, root)
    base = "v0" if kind == "incremental" else None
    R.refresh(spark, *args, "whole", base=base)
    monkeypatch.setattr(layers, "AT_ONCE", 1)
    real, written = layers.write, []

    def write(df, path, part):
        if write.left == 0:
            raise RuntimeError("lost")
        write.left -= 1
        real(df, path, part)
        written.append(path)

    monkeypatch.setattr(layers, "write", write)
    attempts = 0
    while True:
        write.left = 1  # every attempt finishes one more layer
        attempts += 1
        try:
            R.refresh(spark, *args, "torn", base=base)
            break
        except RuntimeError:
            assert "torn" not in dict(layers.published(spark, root))
            assert R.current_version(spark, root) == "whole"
    assert attempts == len(written) == len(set(written)) >= 20  # no finished layer was written again
    same(spark, root, "torn", "whole")
    with pytest.raises(FileExistsError):
        R.refresh(spark, *args, "torn", base=base)


def test_a_begun_version_keeps_its_arguments(spark, tmp_path, monkeypatch):
    root, inputs = str(tmp_path), raw(spark, ORDERS, CUSTOMERS, PRODUCTS)

    def fail(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(layers, "write", fail)
        with pytest.raises(RuntimeError):
            R.refresh(spark, inputs, root, "v")
    with pytest.raises(ValueError, match="was begun with"):
        R.refresh(spark, inputs, root, "v", dt.datetime(2025, 1, 1))
    with pytest.raises(ValueError, match="not published"):
        R.refresh(spark, inputs, root, "w", base="v")
    R.refresh(spark, inputs, root, "v")


def test_interleaved_publishes_get_two_numbers(spark, tmp_path, monkeypatch):
    root, inputs = str(tmp_path), raw(spark, ORDERS, CUSTOMERS, PRODUCTS)
    real, within = commitlog.last_number, []

    def last_number(spark_, folder):
        n = real(spark_, folder)
        if not within:  # another refresh publishes after this one has read the log
            within.append(1)
            R.refresh(spark, inputs, root, "b")
        return n

    monkeypatch.setattr(commitlog, "last_number", last_number)
    R.refresh(spark, inputs, root, "a")
    assert [v for v, _ in layers.published(spark, root)] == ["b", "a"]
    assert R.current_version(spark, root) == "a"
    assert sorted(r.value[:12] for r in spark.read.text(f"{root}/_published").collect()) == ["000000000001", "000000000002"]


LOADS = [
    # new orders in one year, a known id again
    ([("O10", "C1", "S1", "2", "6", "2020-11-01", "retail"), ("O1", "C2", "S2", "9", "9", "2022-01-01", "export")], [], []),
    # a customer and a product that orders of 2020 and 2021 have named before, in a load without orders
    ([], [("C9", "Cy", "Chad", "Retail", "2020-03-05"), ("C1", "Other", "Peru", "Retail", "2018-01-01")], [("S9", "Figs", "9", "False")]),
    # the median moves the filled cost of S3
    ([("O11", "C9", "S3", "1", "2", "2024-01-01", "export")], [], [("S10", "Kale", "20", "True"), ("S11", "Peas", "30", "True")]),
]


def test_loads_equal_a_full_build_and_leave_other_years_alone(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    R.refresh(spark, raw(spark, ORDERS, CUSTOMERS, PRODUCTS), root, "v0")
    real, reads = layers.write, {}

    def write(df, path, part):
        reads[path.removeprefix(root + "/")] = list(df.inputFiles())
        real(df, path, part)

    monkeypatch.setattr(layers, "write", write)
    years = [{2020}, {2020, 2021}, {2021, 2024}]
    orders, customers, products = list(ORDERS), list(CUSTOMERS), list(PRODUCTS)
    for i, (o, c, p) in enumerate(LOADS, 1):
        orders, customers, products = orders + o, customers + c, products + p
        R.refresh(spark, raw(spark, orders, customers, products), root, f"v{i}", base=f"v{i - 1}")
        R.refresh(spark, raw(spark, orders, customers, products), root, f"full{i}")
        names = [n for n in R.PUBLISHED if not n.startswith("raw_")]
        same(spark, root, f"v{i}", f"full{i}", names)
        assert {int(d.split("=")[1]) for d in os.listdir(f"{root}/v{i}/fact_sales") if "=" in d} == years[i - 1]
        # orders and fact of other years are not read by any layer
        for layer, files in reads.items():
            if layer.startswith(f"v{i}/"):
                for f in files:
                    for table in ("_flagged_orders", "fact_sales", "stg_orders", "orders_quarantine"):
                        if f"/{table}/year=" in f:
                            assert int(f.split("year=")[1].split("/")[0]) in years[i - 1], (layer, f)
    # raw layers hold each load's own rows
    assert R.read_published(spark, root, "raw_orders", "v3").count() == len(orders)
    m = layers.manifest(spark, root, "v3")
    assert {owner for owner, folder, _ in m["fact_sales"].parts if folder in ("year=2019", "year=2022")} == {"v0"}
    assert m["fact_sales"].rows == R.read_published(spark, root, "fact_sales", "v3").count()
    # nothing new: nothing but empty layers
    R.refresh(spark, raw(spark, orders, customers, products), root, "v4", base="v3")
    same(spark, root, "v4", "v3")
    assert not os.path.exists(f"{root}/v4/fact_sales")


def test_rows_with_one_fingerprint_are_both_loaded(spark):
    a = H.orders(spark, [("O1", "C", "a|b", "c", "1", "2020-01-01", "x"), ("O2", "C", None, "1", "1", "2020-01-01", "x")])
    b = H.orders(spark, [("O1", "C", "a", "b|c", "1", "2020-01-01", "x"), ("O2", "C", None, "1", "1", "2020-01-01", "x"), ("O1", "C", "a", "b|c", "1", "2020-01-01", "x")])
    assert a.first()["_row_hash"] == b.first()["_row_hash"]
    assert [(r.order_id, r.sku) for r in S.incremental_append(a, b).collect()] == [("O1", "a")]


def test_state_follows_added_and_removed_rows(spark):
    schema = "k string, order_id string, revenue decimal(38,6), gross_margin decimal(38,6), quantity decimal(28,8), order_date date"
    day = lambda d: dt.date(2020, 1, d)
    row = lambda k, o, r, d: (k, o, None if r is None else Decimal(r), None if r is None else Decimal(r) / 2, Decimal(1), day(d))
    old = [row("a", "1", "1.5", 3), row("a", "2", "2.5", 9), row("b", "3", "1", 4), row("c", "4", None, 5), (None, "5", Decimal(1), None, None, day(1)), row("d", "6", "1", 5), row("d", "7", "1", 6), row("e", "8", "2", 7)]
    #  a's first leaves, b goes, c gets a price, d swaps rows of one date, e is unchanged, f comes
    new = [row("a", "2", "2.5", 9), row("a", "9", "1", 8), row("c", "4", "7", 5), (None, "5", Decimal(1), None, None, day(1)), row("d", "10", "4", 5), row("d", "7", "1", 6), row("e", "8", "2", 7), row("f", "11", "3", 2)]
    before, after = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    diff = state.change(before, after, "k")
    assert sorted(r.k for r in diff.collect()) == ["a", "b", "c", "d", "f"]
    merged = state.merge(state.summarise(before, "k"), diff, "k")
    assert sorted(r.k for r in merged.where("stale").collect()) == ["a"]
    want = sorted(map(tuple, state.summarise(after, "k").collect()))
    assert sorted(map(tuple, state.refreshed(merged, after, "k").collect())) == want


@pytest.mark.parametrize("values,ranges", [([1, 2, 2, 9], 1000), ([5], 1000), ([3, 1, 2], 2), (list(range(500)) + [7] * 900, 10), ([], 1000)])
def test_median_of_counts(spark, values, ranges):
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(28,8)")
    got = state.median_of_counts(state.value_counts(df, "v"), "v", ranges=ranges).first()
    assert (got and got[0]) == exact_median(df, "v").first()[0]
    twice = state.merged_counts(state.value_counts(df, "v"), state.value_counts(df, "v"), "v")
    assert state.median_of_counts(twice, "v", ranges=ranges).first()[0] == exact_median(df.union(df), "v").first()[0]


def test_published_marts_equal_those_of_the_pipeline(spark, tmp_path):
    R.refresh(spark, raw(spark, ORDERS, CUSTOMERS, PRODUCTS), str(tmp_path), "v")
    assert json.loads(commitlog.read_text(spark, f"{tmp_path}/v/_layers/_run"))["base"] is None
    p = R.published_pipeline(spark, str(tmp_path))
    direct = Pipeline.from_frames(*[raw(spark, ORDERS, CUSTOMERS, PRODUCTS)[k] for k in ("orders", "customers", "products")])
    assert rows(p.mart_customer_lifetime) == rows(direct.mart_customer_lifetime) and rows(p.mart_product_performance) == rows(direct.mart_product_performance)
    assert p.mart_customer_lifetime.dtypes == direct.mart_customer_lifetime.dtypes
    assert p.fact_sales.where(F.col("year") == 2019).count() == 2
