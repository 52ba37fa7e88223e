"""One test per parity rule of the reference loader and KPI SQL."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.hashing import row_hash
from tallyspark.functions.numeric import pct, round_half_away
from tallyspark.functions.parse import to_bool_exact, to_date_lenient, to_number
from tallyspark.functions.text import strip_ws, title_case
from tallyspark.operators.stats import exact_median
from tallyspark.plans import kpis
from tallyspark.operators import measures as M

from tests.helpers import pipeline, rows

CUST = [("C1", "Ann", "Peru", "Retail", "2020-01-01")]
PROD = [("S1", "Gift", "10.00", "True")]


def one(df, col):
    return df.select(col).collect()[0][0]


def test_n1_n2_null_quantity_is_not_a_return_and_reaches_fact(spark):
    p = pipeline(spark, [("O1", "C1", "S1", "abc", "20.00", "2021-01-01", "web")], CUST, PROD)
    stg = p.stg_orders.collect()
    assert len(stg) == 1 and stg[0]["is_return"] is False and stg[0]["quantity"] is None
    f = p.fact_sales.collect()
    assert len(f) == 1 and f[0]["revenue"] is None and f[0]["margin_pct"] is None


def test_n3_null_keys_form_one_group(spark):
    p = pipeline(spark, [(None, "C1", "S1", "1", "20.00", "2021-01-01", "web"),
                         (None, "C1", "S1", "2", "20.00", "2021-01-02", "web")], CUST, PROD)
    assert rows(p.stg_orders, "quantity") == [(1,)]


def test_n4_null_customer_matches_in_staging_not_in_kpi(spark):
    cust = CUST + [(None, "Nobody", "X", "Y", "2022-01-01")]
    p = pipeline(spark, [("O1", None, "S1", "1", "20.00", "2021-01-01", "web")], cust, PROD)
    assert rows(p.flagged_orders, "created_at", "is_pre_signup") == [(dt.date(2022, 1, 1), True)]
    assert kpis.kpi_country(p.fact_sales, p.dim_customer).count() == 0


def test_n5_n6_null_group_dropped_and_all_null_sum_is_zero(spark):
    p = pipeline(spark, [("O1", "C1", "S1", "1", "20.00", "2021-01-01", None),
                         ("O2", "C1", "S1", "x", "20.00", "2021-01-01", "web")], CUST, PROD)
    daily = p.mart_daily_channel.collect()
    assert [(r["channel"], r["revenue"], r["units"]) for r in daily] == [("web", Decimal("0.00"), 0)]
    clv = p.mart_customer_lifetime.collect()[0]
    assert clv["total_revenue"] == Decimal("20.00") and clv["avg_order_value"] == 20.0
    p2 = pipeline(spark, [("O2", "C1", "S1", "x", "20.00", "2021-01-01", "web")], CUST, PROD)
    clv2 = p2.mart_customer_lifetime.collect()[0]
    assert clv2["total_revenue"] == 0 and clv2["avg_order_value"] is None


def test_n7_bad_first_row_shadows_good_later_row(spark):
    p = pipeline(spark, [("O1", "C1", "S1", "1", "20.00", "2025-13-40", "web"),
                         ("O1", "C1", "S1", "1", "20.00", "2021-01-01", "web")], CUST, PROD)
    assert p.stg_orders.count() == 0


def test_n8_blank_country_becomes_empty_not_unknown(spark):
    p = pipeline(spark, [], [("C1", " Ann ", "  ", None, "2020-01-01")], PROD)
    r = p.stg_customers.collect()[0]
    assert (r["name"], r["country"], r["segment"]) == ("Ann", "", "Unknown")


def test_n9_title_case_like_python(spark):
    df = spark.createDataFrame([("E-commerce",), ("UK",), ("gift box",), ("o'neil",), ("1st",)], "x string")
    got = [r[0] for r in df.select(title_case(strip_ws("x"))).collect()]
    assert got == ["E-Commerce", "Uk", "Gift Box", "O'Neil", "1St"]
    assert got == [s.title() for s in ["E-commerce", "UK", "gift box", "o'neil", "1st"]]


def test_n11_dates(spark):
    df = spark.createDataFrame([("2025-13-40",), ("2025-1-5",), ("2025-01-15 10:00",), (" 2025-01-16",),
                                ("15/01/2025",)], "x string")
    got = [r[0] for r in df.select(to_date_lenient("x")).collect()]
    assert got == [None, dt.date(2025, 1, 5), None, None, None]


def test_n12_numbers(spark):
    text = ["12d", " 12 ", "1e3", "1,000", "abc", "2.5", "3000000000", "1.005", "0.004", "-99999999999999999.99"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in text], "x string").select(to_number("x")).collect()]
    assert got == [None, 12, 1000, None, None, Decimal("2.5"), 3000000000, Decimal("1.005"), Decimal("0.004"), Decimal("-99999999999999999.99")]


def test_n13_zero_revenue_gives_null_margin_pct(spark):
    p = pipeline(spark, [("O1", "C1", "S1", "0", "20.00", "2021-01-01", "web")], CUST, PROD)
    assert one(p.fact_sales, "margin_pct") is None
    assert one(kpis.kpi_scorecard(p.fact_sales), "margin_pct") is None


def test_n14_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (1.0049,)], "x double")
    assert [r[0] for r in df.select(round_half_away("x", 0)).collect()] == [3.0, -3.0, 0.0, 1.0]
    assert [r[0] for r in df.select(round_half_away("x", 2)).collect()] == [2.5, -2.5, 0.13, 1.0]
    z = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert z.select(pct("a", "b")).collect()[0][0] is None


def test_n15_null_tokens(spark):
    p = pipeline(spark, [], [("C1", "Ann", "N/A", "null", "2020-01-01")], PROD)
    r = p.stg_customers.collect()[0]
    assert (r["country"], r["segment"]) == ("Unknown", "Unknown")


def test_n16_exact_boolean_map(spark):
    df = spark.createDataFrame([("True",), ("False",), ("true",), ("yes",)], "x string")
    assert [r[0] for r in df.select(to_bool_exact("x")).collect()] == [True, False, None, None]


def test_n17_rank_ties_return_more_than_k(spark):
    order_rows = [(f"O{i}", f"C{i}", "S1", "1", f"{100 - i}.00", "2021-01-01", "web") for i in range(10)]
    order_rows.append(("O10", "C10", "S1", "1", "91.00", "2021-01-01", "web"))  # ties with C9
    cust = [(f"C{i}", f"N{i}", "Peru", "Retail", "2020-01-01") for i in range(11)]
    p = pipeline(spark, order_rows, cust, PROD)
    top = kpis.kpi_top_customers(p.fact_sales, p.dim_customer)
    assert top.count() == 11
    assert sorted(r["revenue_rank"] for r in top.collect())[-2:] == [10, 10]


def test_n18_n19_lag_uses_present_months_calendar_mom_uses_calendar(spark):
    p = pipeline(spark, [("O1", "C1", "S1", "1", "10.00", "2021-01-05", "web"),
                         ("O2", "C1", "S1", "1", "20.00", "2021-03-05", "web")], CUST, PROD)
    trend = {(r["month"]): r["mom_revenue_growth_pct"]
             for r in kpis.kpi_monthly_trend(p.fact_sales, p.dim_date).collect()}
    assert trend == {1: None, 3: 100.0}
    mom = {r["month_start"].month: r["revenue_mom_pct"] for r in M.calendar_mom(p.fact_sales).collect()}
    assert mom == {1: None, 3: None}


def test_n20_inner_joins_drop_orphans_scorecard_does_not(spark):
    p = pipeline(spark, [("O1", "C1", "S1", "1", "10.00", "2021-01-05", "web"),
                         ("O2", "C1", "S404", "1", "20.00", "2021-01-05", "web")], CUST, PROD)
    assert one(kpis.kpi_scorecard(p.fact_sales), "total_revenue") == 30.0
    assert one(kpis.kpi_category(p.fact_sales, p.dim_product), "revenue") == 10.0


def test_n21_null_and_false_active_are_two_inactive_rows(spark):
    prod = [("S1", "A", "1.00", "True"), ("S2", "A", "1.00", "False"), ("S3", "A", "1.00", "maybe")]
    order_rows = [(f"O{i}", "C1", s, "1", "5.00", "2021-01-01", "web") for i, s in enumerate(["S1", "S2", "S3"])]
    p = pipeline(spark, order_rows, CUST, prod)
    got = sorted(r["product_status"] for r in kpis.kpi_active_status(p.fact_sales, p.dim_product).collect())
    assert got == ["Active", "Inactive", "Inactive"]


def test_n22_iso_week_with_calendar_year(spark):
    p = pipeline(spark, [("O1", "C1", "S1", "1", "10.00", "2024-12-30", "web")], CUST, PROD)
    r = p.dim_date.filter(F.col("date_id") == 20241230).collect()[0]
    assert (r["year"], r["week"], r["day_of_week"], r["is_weekend"]) == (2024, 1, "Monday", False)
    assert p.dim_date.count() == 366


def test_n23_exact_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)], "v double")
    assert exact_median(df, "v").collect()[0][0] == 6.0
    d = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "v decimal(18,2)")
    assert exact_median(d, "v").select(F.col("median").cast("decimal(18,2)")).collect()[0][0] == Decimal("1.01")


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 20001])
def test_exact_median_matches_sorting(spark, n):
    import random
    rnd = random.Random(n)
    vals = [rnd.randint(0, 500) / 4 for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    s = sorted(vals)
    expect = (s[(n - 1) // 2] + s[n // 2]) / 2
    assert exact_median(df, "v").collect()[0][0] == pytest.approx(expect)


def test_exact_median_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_median(df, "v").collect()[0][0] is None


def test_a4_row_hash_keeps_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r[0] for r in df.select(row_hash("x", "y", "z")).collect()]
    assert h[0] != h[1]
    import hashlib
    assert h[0] == hashlib.md5("a|nan|b".encode()).hexdigest()


def test_median_imputation_after_abs(spark):
    prod = [("S1", None, "-10.00", "True"), ("S2", "A", "20.00", "False"), ("S3", "A", "n/a", "True"),
            ("S4", "B", "40.00", "True")]
    p = pipeline(spark, [], CUST, prod)
    got = {r["sku"]: (r["category"], r["cost"], r["active"]) for r in p.stg_products.collect()}
    assert got == {"S1": ("Uncategorized", Decimal("10.00"), True), "S2": ("A", Decimal("20.00"), False),
                   "S3": ("A", Decimal("20.00"), True), "S4": ("B", Decimal("40.00"), True)}


def test_flags_and_quarantine(spark):
    cust = [("C1", "Ann", "Peru", "Retail", "2021-06-01")]
    prod = [("S1", "Gift", "50.00", "False")]
    p = pipeline(spark, [("O1", "C1", "S1", "2", "20.00", "2021-01-01", " WEB "),
                         ("O2", "C1", "S1", "-1", "20.00", "2021-07-01", "web")], cust, prod)
    f = {r["order_id"]: (r["is_pre_signup"], r["is_inactive_sale"], r["is_below_cost"], r["is_return"], r["channel"])
         for r in p.stg_orders.collect()}
    assert f == {"O1": (True, True, True, False, "web"), "O2": (False, True, True, True, "web")}
    q = p.orders_quarantine.collect()
    assert [r["order_id"] for r in q] == ["O1"] and q[0]["_quarantine_reason"] == "order_date < customer created_at"
    fact = p.fact_sales.collect()
    assert len(fact) == 1 and fact[0]["cost_total"] == Decimal("100.00") and fact[0]["gross_margin"] == Decimal("-60.00")
    assert fact[0]["margin_pct"] == -1.5 and fact[0]["date_id"] == 20210101


def test_a3_load_time_is_the_run_parameter(spark):
    from tallyspark.plans.pipeline import Pipeline
    from tests.helpers import customers, orders, products
    from tallyspark.sources.raw import ORDER_COLUMNS, to_raw
    run = dt.datetime(2026, 3, 1, 2, 0, 0)
    src = orders(spark, [("O1", "C1", "S1", "1", "10.00", "2021-01-01", "web")]).select(*ORDER_COLUMNS, "_ord",
                                                                                         "_source_file")
    raw = to_raw(src, ORDER_COLUMNS, run)
    assert [r["_loaded_at"] for r in raw.collect()] == [run]
    cust = customers(spark, [("C1", "Ann", "Peru", "Retail", "2022-01-01")])
    p = Pipeline.from_frames(raw, cust, products(spark, PROD), run_ts=run)
    assert [r["_quarantined_at"] for r in p.orders_quarantine.collect()] == [run]
