"""What refreshes and loads leave on disk, and results that do not depend on it."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tallyspark.plans import refresh as R
from tallyspark.session import SHUFFLE_CLEANUP, shuffles_dropped
from tallyspark.sources import store as S
from tallyspark.sources.raw import CUSTOMER_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS, to_raw


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def raw(spark, rows: list, columns: list[str]):
    named = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, " + ", ".join(f"{c} string" for c in columns))
    return to_raw(named.select(*columns, F.struct(F.lit(0).alias("src"), "n").alias("_ord"), F.lit("f").alias("_source_file")), columns)


ORDERS = [(f"O{i}", f"C{i % 5}", f"S{i % 3}", str(i % 7 - 1), "3.50", f"202{i % 3}-01-0{i % 9 + 1}", " Web ") for i in range(60)]


def test_refresh_leaves_no_shuffle_files(spark, tmp_path):
    frames = {"orders": raw(spark, ORDERS + ORDERS[:5], ORDER_COLUMNS), "customers": raw(spark, [(f"C{i}", "n", "fr", "x", "2020-01-01") for i in range(5)], CUSTOMER_COLUMNS),
              "products": raw(spark, [(f"S{i}", "c", str(i + 1), "True") for i in range(3)], PRODUCT_COLUMNS)}
    before, was = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    counts = R.refresh(spark, frames, str(tmp_path / "r"), "v1", dt.datetime(2024, 1, 1))
    assert counts["stg_orders"] == 60
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == was


def test_landing_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    S.write_csv(spark.range(2000, numPartitions=4).select(F.col("id").cast("string").alias("a"), (-F.col("id")).alias("_ord")), str(tmp_path / "csv"))
    assert not shuffle_files(spark) - before
    got = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert got.count() == 2000


def test_session_keeps_its_setting_after_a_failure(spark):
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    try:
        with shuffles_dropped(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == was


def test_difference_by_definition_with_one_shuffle_of_the_rows(spark):
    rng = random.Random(3)
    rows = lambda n: [(rng.choice([None, 1, 2]), rng.choice([None, "x", "", "y"]), rng.choice([0.0, float("nan"), None])) for _ in range(n)]
    schema = "a int, b string, c double"
    for one, two in ((rows(40), rows(55)), (rows(9), []), ([], []), ((r := rows(30)), r[::-1])):
        diff = S.table_diff(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema))
        x, y = Counter(map(str, one)), Counter(map(str, two))
        assert [r.diff_rows for r in diff.collect()] == [sum(((x - y) + (y - x)).values())]
        assert diff.schema["diff_rows"].dataType.typeName() == "long"
    planned = S.table_diff(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema))
    assert planned._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_slices_append_the_same_rows(spark, tmp_path):
    rng = random.Random(5)
    some = lambda n: [tuple(rng.choice([None, "a", "b|c", "nan"]) if c in (1, 6) else v for c, v in enumerate(rng.choice(ORDERS))) for _ in range(n)]
    old, new = raw(spark, some(80), ORDER_COLUMNS), raw(spark, some(150), ORDER_COLUMNS)
    columns = [*ORDER_COLUMNS, "_row_hash", "_ord"]
    want = sorted(map(str, S.incremental_append(old, new).select(*columns).collect()))
    before = shuffle_files(spark)
    got = S.appended(old, new, str(tmp_path / "new"))
    assert not shuffle_files(spark) - before
    assert len(want) > 10 and sorted(map(str, got.select(*columns).collect())) == want
