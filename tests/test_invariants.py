"""Whole-pipeline invariants, idempotence, replay and permutation checks."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark.operators import quality
from tallyspark.plans import catalog as C
from tallyspark.plans import kpis
from tallyspark.plans import refresh as R
from tallyspark.plans.pipeline import Pipeline
from tallyspark.session import scratch_path
from tallyspark.sources import adapter
from tallyspark.sources import store as S
from tallyspark.streaming import intake as J
from tallyspark.streaming.stream import read_store, run_intake_stream
from tests.conftest import SF_SMALL


def test_waterfall_adds_up(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    w = {r["step"]: r["rows"] for r in quality.dq_waterfall(p.raw_orders, p.stg_orders, p.fact_sales).collect()}
    assert w["raw_orders"] + w["duplicate_order_id"] + w["invalid_order_date"] + w["null_unit_price"] == w["stg_orders"]
    assert w["stg_orders"] + w["returns"] == w["fact_sales"]
    assert w["orders_quarantine"] == p.orders_quarantine.count()


def test_quarantine_is_subset_of_staging_and_marts_add_up(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    assert p.orders_quarantine.join(p.stg_orders.filter("is_pre_signup"), "order_id", "left_anti").count() == 0
    fact_rev = p.fact_sales.filter(F.col("channel").isNotNull()).agg(F.sum("revenue")).collect()[0][0]
    mart_rev = p.mart_daily_channel.agg(F.sum("revenue")).collect()[0][0]
    assert fact_rev == mart_rev
    shares = kpis.kpi_channel(p.fact_sales).agg(F.sum("revenue_share_pct")).collect()[0][0]
    assert abs(shares - 100.0) < 0.5
    ri = {r["check_name"]: r["violations"] for r in
          quality.ref_integrity(p.fact_sales, p.dim_customer, p.dim_product, p.dim_date).collect()}
    assert ri["fact_order_id_duplicates"] == 0 and ri["fact_date_orphans"] == 0
    assert ri["dim_customer_key_duplicates"] == 0 and ri["dim_product_key_duplicates"] == 0


def test_input_partitioning_does_not_change_results(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    q = Pipeline.from_frames(p.raw_orders.repartition(7), p.raw_customers.repartition(3, "name"),
                             p.raw_products.repartition(5))
    cols = p.fact_sales.columns
    assert p.fact_sales.select(*cols).exceptAll(q.fact_sales.select(*cols)).count() == 0
    assert q.fact_sales.select(*cols).exceptAll(p.fact_sales.select(*cols)).count() == 0


def test_refresh_is_idempotent_and_published_kpis_match(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    raw = {"orders": p.raw_orders, "customers": p.raw_customers, "products": p.raw_products}
    root = scratch_path(spark, "test-refresh")
    counts = R.refresh(spark, raw, root, "a")
    R.refresh(spark, raw, root, "b")
    assert set(counts) == set(R.PUBLISHED)
    assert counts["fact_sales"] == p.fact_sales.count() and counts["raw_orders"] == p.raw_orders.count()
    log = {r["table_name"]: r["rows"] for r in spark.read.parquet(f"{root}/a/_run_log").collect()}
    assert log == counts
    assert R.current_version(spark, root) == "b"
    for name in R.PUBLISHED:
        a = R.read_published(spark, root, name, "a")
        b = R.read_published(spark, root, name, "b")
        assert S.table_diff(a, b).collect()[0][0] == 0, name
    pub = R.published_pipeline(spark, root)
    direct = kpis.kpi_monthly_trend(p.fact_sales, p.dim_date)
    published = kpis.kpi_monthly_trend(pub.fact_sales, pub.dim_date)
    assert direct.exceptAll(published).count() == 0 and published.count() == direct.count()


def test_incremental_replay_adds_nothing(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    assert S.incremental_append(p.raw_orders, p.raw_orders).count() == 0


def test_csv_landing_roundtrip_keeps_file_order(spark):
    sources = {"orders": adapter.raw_orders(spark, SF_SMALL), "customers": adapter.raw_customers(spark, SF_SMALL),
               "products": adapter.raw_products(spark, SF_SMALL)}
    landed = S.scan_landing(spark, S.land_inputs(sources, scratch_path(spark, "test-landing")), dt.datetime(1970, 1, 1))
    direct = Pipeline.from_tables(spark, SF_SMALL)
    via_csv = Pipeline.from_frames(landed["orders"], landed["customers"], landed["products"])
    cols = direct.stg_orders.columns
    assert direct.stg_orders.exceptAll(via_csv.stg_orders.select(*cols)).count() == 0
    assert via_csv.stg_customers.exceptAll(direct.stg_customers).count() == 0


def test_stream_equals_batch_across_batches_and_replay(spark):
    cands = adapter.intake_candidates(spark, SF_SMALL)
    base = scratch_path(spark, "test-stream")
    src = base + "/incoming"
    # three drops, in submission order, processed one file per micro-batch
    src1, key = F.col("_ord.src") == 1, F.col("_ord.key")
    drops = [src1 & (key < 500), src1 & (key >= 500) & (key < 1000), (src1 & (key >= 1000)) | ~src1]
    for cond in drops:
        cands.filter(cond).coalesce(1).write.mode("append").json(src)
        paths = run_intake_stream(spark, src, base + "/out", C.INTAKE_RULES, dt.datetime(1970, 1, 1),
                                  max_files_per_trigger=1)
    stream_store = read_store(spark, paths["store"])
    batch_store = C._store(spark, SF_SMALL)
    cols = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel"]
    assert stream_store.count() == batch_store.count()
    assert stream_store.select(*cols).exceptAll(batch_store.select(*cols)).count() == 0
    ids = [r[0] for r in stream_store.select("id").orderBy("id").collect()]
    assert ids == list(range(1, len(ids) + 1))
    # replaying the same folder with the same checkpoint adds nothing
    run_intake_stream(spark, src, base + "/out", C.INTAKE_RULES, dt.datetime(1970, 1, 1))
    assert read_store(spark, paths["store"]).count() == stream_store.count()


def test_intake_rules_on_inline_rows(spark):
    rows = [
        (" o1 ", "c0001", "sku0001", "2", "25.00", "2025-01-15", " Retail"),  # valid
        ("o1", "C0001", "SKU0001", "3", "10", "2025-01-16", "export"),  # duplicate id
        ("   ", "C1", "SKU01", "0", "-1", "2025/01/15", "fax"),  # everything wrong
        ("o3", "C0002", "SKU0002", "10000", "100000", "2025-01-15", "wholesale"),  # revenue guard
        ("o4", "C0002", "SKU0002", "abc", "x", "2999-01-01", None),
    ]
    df = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)],
                               "order_id string, customer_id string, sku string, quantity string, "
                               "unit_price string, order_date string, channel string, _ord long")
    rules = J.IntakeRules(as_of=dt.date(2026, 1, 1))
    v = J.validate(df, rules).orderBy("_ord").collect()
    errs = [sorted((e["field"], e["code"]) for e in r["errors"]) for r in v]
    assert errs[0] == [] and errs[1] == []
    assert errs[2] == sorted([("order_id", "string_too_short"), ("customer_id", "pattern"), ("sku", "pattern"),
                              ("quantity", "greater_than"), ("unit_price", "greater_than"),
                              ("order_date", "date_parsing"), ("channel", "invalid_choice")])
    assert errs[3] == [("revenue", "revenue_anomaly")]
    assert errs[4] == sorted([("quantity", "int_parsing"), ("unit_price", "float_parsing"),
                              ("order_date", "date_future"), ("channel", "missing")])
    accepted, conflicts = J.accept(J.validate(df, rules))
    assert [r["order_id"] for r in accepted.collect()] == ["O1"]
    assert [r["_ord"] for r in conflicts.collect()] == [1]
    stored = J.insert(accepted, J.empty_store(spark), dt.datetime(2026, 1, 1))
    page = J.list_orders(stored, limit=1).collect()
    assert page[0]["revenue"] == 50.0 and page[0]["channel"] == "retail" and page[0]["id"] == 1
    remaining, report = J.delete_orders(stored, spark.createDataFrame([("o1",), ("zz",)], "order_id string"))
    assert remaining.count() == 0
    assert sorted(tuple(r) for r in report.collect()) == [("O1", 1), ("ZZ", 0)]
