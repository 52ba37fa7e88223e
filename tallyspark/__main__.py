"""Command line.

  python -m tallyspark refresh --orders O.csv --customers C.csv --products P.csv --out ROOT [--version V]
                               [--mode full|incremental] [--web INTAKE_STORE]
  python -m tallyspark kpi NAME --root ROOT            (NAME: scorecard, monthly_trend, channel, ...)
  python -m tallyspark sql "SELECT ..." --root ROOT    (published tables as views)
  python -m tallyspark intake --input DIR --out DIR [--as-of YYYY-MM-DD]
  python -m tallyspark delete --store INTAKE_STORE ORDER_ID ...

An incremental refresh adds the rows that the current version has not seen; --web adds the stored web orders
after the order files.

Inputs are CSV files (or folders of them) with a header row, read as text.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from tallyspark.session import get_spark


def _kpi(name: str, p):
    from tallyspark.plans import kpis
    table = {
        "scorecard": lambda: kpis.kpi_scorecard(p.fact_sales),
        "monthly_trend": lambda: kpis.kpi_monthly_trend(p.fact_sales, p.dim_date),
        "channel": lambda: kpis.kpi_channel(p.fact_sales),
        "category": lambda: kpis.kpi_category(p.fact_sales, p.dim_product),
        "top_customers": lambda: kpis.kpi_top_customers(p.fact_sales, p.dim_customer),
        "top_products": lambda: kpis.kpi_top_products(p.fact_sales, p.dim_product),
        "country": lambda: kpis.kpi_country(p.fact_sales, p.dim_customer),
        "segment": lambda: kpis.kpi_segment(p.fact_sales, p.dim_customer),
        "quarterly": lambda: kpis.kpi_quarterly(p.fact_sales, p.dim_date),
        "active_status": lambda: kpis.kpi_active_status(p.fact_sales, p.dim_product),
        "returns_audit": lambda: kpis.kpi_returns_audit(p.stg_orders),
    }
    if name not in table:
        raise SystemExit(f"unknown KPI {name!r}; one of: {', '.join(table)}")
    return table[name]()


def _show(df) -> None:
    """Print every row."""
    df = df.persist()
    df.show(max(1, df.count()), truncate=False)
    df.unpersist()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tallyspark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--orders", required=True)
    r.add_argument("--customers", required=True)
    r.add_argument("--products", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--version", default=None)
    r.add_argument("--mode", choices=["full", "incremental"], default="full")
    r.add_argument("--web", default=None, help="store of the order intake")
    k = sub.add_parser("kpi")
    k.add_argument("name")
    k.add_argument("--root", required=True)
    q = sub.add_parser("sql")
    q.add_argument("query")
    q.add_argument("--root", required=True)
    i = sub.add_parser("intake")
    i.add_argument("--input", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--as-of", default=None)
    i.add_argument("--customer-pattern", default=r"^C[0-9]{4}$")
    i.add_argument("--sku-pattern", default=r"^SKU[0-9]{4}$")
    d = sub.add_parser("delete")
    d.add_argument("--store", required=True)
    d.add_argument("order_id", nargs="+")
    for p in sub.choices.values():
        p.add_argument("--profile", choices=["cluster"], default=None, help="settings for a large cluster, where the cluster sets none")
    a = ap.parse_args(argv)

    spark = get_spark(profile=a.profile)
    if a.cmd == "refresh":
        from tallyspark.plans import refresh as R
        from tallyspark.sources import store as S
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        raw = S.scan_landing(spark, {"orders": a.orders, "customers": a.customers, "products": a.products}, now)
        version = a.version or now.strftime("v%Y%m%dT%H%M%S")
        orders = [raw["orders"]]
        if a.web:
            from tallyspark.streaming.stream import read_store
            orders.append(S.web_orders_as_raw(spark, read_store(spark, a.web), f"{a.out}/_web/{version}", now))
        raw["orders"] = S.in_sequence(orders)
        base = R.current_version(spark, a.out) if a.mode == "incremental" else None
        counts = R.refresh(spark, raw, a.out, version, now, base)
        print(json.dumps({"version": version, "rows": counts}))
    elif a.cmd == "kpi":
        from tallyspark.plans import refresh as R
        _show(_kpi(a.name, R.published_pipeline(spark, a.root)))
    elif a.cmd == "sql":
        from tallyspark.plans import refresh as R
        R.register_views(spark, a.root)
        _show(spark.sql(a.query))
    elif a.cmd == "delete":
        from tallyspark.streaming.stream import delete_stored
        _show(delete_stored(spark, a.store, spark.createDataFrame([(o,) for o in a.order_id], "order_id string")))
    elif a.cmd == "intake":
        from tallyspark.streaming import intake as J
        from tallyspark.streaming.stream import run_intake_stream
        rules = J.IntakeRules(customer_pattern=a.customer_pattern, sku_pattern=a.sku_pattern,
                              as_of=dt.date.fromisoformat(a.as_of) if a.as_of else None)
        print(json.dumps(run_intake_stream(spark, a.input, a.out, rules)))


if __name__ == "__main__":
    main()
