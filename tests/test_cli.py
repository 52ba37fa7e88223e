"""The command-line refresh on CSV files, then KPIs and SQL on the published tables."""

import os

from pyspark.sql import functions as F

from tallyspark import __main__ as cli
from tallyspark.plans import refresh as R
from tallyspark.session import scratch_path
from tallyspark.sources import adapter
from tallyspark.sources import store as S
from tests.conftest import SF_SMALL


def test_cli_refresh_then_kpi_and_sql(spark, capsys):
    landing = scratch_path(spark, "cli-landing")
    paths = S.land_inputs({"orders": adapter.raw_orders(spark, SF_SMALL),
                           "customers": adapter.raw_customers(spark, SF_SMALL),
                           "products": adapter.raw_products(spark, SF_SMALL)}, landing)
    out = scratch_path(spark, "cli-out")
    cli.main(["refresh", "--orders", paths["orders"], "--customers", paths["customers"],
              "--products", paths["products"], "--out", out, "--version", "v1"])
    assert '"version": "v1"' in capsys.readouterr().out
    cli.main(["kpi", "scorecard", "--root", out])
    assert "total_revenue" in capsys.readouterr().out
    R.register_views(spark, out)
    n = spark.sql("SELECT count(*) FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id").collect()[0][0]
    assert n == spark.table("fact_sales").count() > 0
    assert os.path.basename(out)
    assert spark.table("stg_orders").filter(F.col("is_return")).count() > 0
