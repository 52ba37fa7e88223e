"""Physical-plan shape: the properties the design relies on at scale."""

from tallyspark.operators import measures as M, quality
from tallyspark.operators.dedupe import keep_first
from tallyspark.plans import kpis
from tallyspark.plans import refresh as R
from tallyspark.plans.pipeline import Pipeline
from tallyspark.session import scratch_path
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keep_first_uses_partial_window_group_limit(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    txt = optimized(keep_first(p.raw_orders, "order_id"))
    assert "WindowGroupLimit" in txt


def test_top_k_is_group_limited_and_total_is_broadcast(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    df = kpis.kpi_top_customers(p.fact_sales, p.dim_customer)
    txt = optimized(df)
    assert "WindowGroupLimit" in txt
    assert "unboundedfollowing" not in txt.lower()  # no SUM() OVER () over all groups


def test_fact_scan_prunes_columns(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    df = kpis.kpi_scorecard(p.fact_sales)
    df.collect()
    txt = plan(df)
    li = [line for line in txt.splitlines() if "lineitem" in line and "ReadSchema" in line]
    assert li and all("l_discount" not in line and "l_tax" not in line for line in li)


def test_published_fact_slice_prunes_year_folders_and_pushes_filters(spark):
    p = Pipeline.from_tables(spark, SF_SMALL)
    root = scratch_path(spark, "test-plan-publish")
    R.refresh(spark, {"orders": p.raw_orders, "customers": p.raw_customers, "products": p.raw_products}, root, "v")
    fact = R.read_published(spark, root, "fact_sales")
    s = M.slice_sales(fact, date_from="1996-01-01", date_to="1997-12-31", channels=["1-urgent"])
    txt = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in txt
    assert "PushedFilters" in txt and "order_date" in txt and "channel" in txt
    dim = R.read_published(spark, root, "dim_customer")
    for df in (kpis.kpi_channel(fact), kpis.kpi_top_customers(fact, dim)):
        df.collect()
        # the total's branch reuses the exchange of the groups: one scan of the fact runs
        assert "ReusedExchange" in plan(df)
    checks = quality.ref_integrity(fact, dim, R.read_published(spark, root, "dim_product"), R.read_published(spark, root, "dim_date"))
    lines = [line.strip(" :+-") for line in optimized(checks).splitlines()]
    at = next(i for i, line in enumerate(lines) if line.startswith("Join LeftOuter, (customer_id"))
    assert lines[at + 1].startswith("Aggregate [customer_id")


def test_intake_keep_first_is_group_limited_and_scalars_are_subqueries(spark):
    from tallyspark.plans.catalog import INTAKE_RULES
    from tallyspark.sources import adapter
    from tallyspark.streaming import intake as J
    accepted, _ = J.accept(J.validate(adapter.intake_candidates(spark, SF_SMALL), INTAKE_RULES))
    assert "WindowGroupLimit" in optimized(accepted)
    p = Pipeline.from_tables(spark, SF_SMALL)
    txt = optimized(kpis.kpi_channel(p.fact_sales))
    assert "scalar-subquery" in txt and "Cross" not in txt
