"""Inputs that a user has and the generated fixtures have not."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyspark import __main__ as cli
from tallyspark.functions.parse import to_date_lenient
from tallyspark.operators.star import FLAGS, fact_sales
from tallyspark.plans import refresh as R
from tallyspark.sources.raw import scan_csv
from tallyspark.streaming import intake as J
from tallyspark.streaming.stream import delete_stored, make_batch_writer, read_store, run_intake_stream, scanned

RULES = J.IntakeRules(as_of=dt.date(2026, 1, 1))
FORM = [
    {"order_id": "O1", "customer_id": "C0001", "sku": "SKU0001", "quantity": "2", "unit_price": "25.00", "order_date": "2025-01-15", "channel": "retail"},
    {"order_id": "O2", "customer_id": "C0001", "sku": "SKU0001", "quantity": "5.0", "unit_price": "1", "order_date": "2025-01-15", "channel": "Export"},
    {"order_id": "O1", "customer_id": "C0002", "sku": "SKU0002", "quantity": "9", "unit_price": "9", "order_date": "2025-01-16", "channel": "export"},
    {"order_id": "O3", "customer_id": "C0002", "sku": "SKU0002", "quantity": "many", "unit_price": "9", "order_date": "2025-13-16", "channel": "fax"},
    {"order_id": "O4"},
]


def rejected_ids(spark, path):
    return sorted((r.order_id, r.errors[0].code) for r in spark.read.parquet(path).collect())


def test_form_json_is_accepted_once_and_replay_changes_nothing(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(map(json.dumps, FORM)))
    paths = run_intake_stream(spark, str(src), str(tmp_path / "out"), RULES, dt.datetime(2025, 2, 1))
    store = lambda: sorted((r.id, r.order_id, r.quantity, r.channel) for r in read_store(spark, paths["store"]).collect())
    want = [(1, "O1", 2, "retail"), (2, "O2", 5, "export")]
    refused = [("O1", "duplicate"), ("O3", "int_parsing"), ("O4", "missing")]
    assert store() == want
    assert rejected_ids(spark, paths["rejected"]) == refused
    bad = spark.read.parquet(paths["rejected"]).where("order_id = 'O3'").first()
    assert (bad.quantity, bad.order_date, bad.channel) == ("many", "2025-13-16", "fax")
    # the same micro-batch once more, as after a failure
    schema = ", ".join(f"{c} string" for c in J.CANDIDATE_COLUMNS)
    batch = scanned(spark.read.schema(schema).json(str(src)))
    make_batch_writer(paths["store"], paths["rejected"], paths["checkpoint"], RULES, dt.datetime(2025, 2, 1))(batch, 0)
    assert store() == want
    assert rejected_ids(spark, paths["rejected"]) == refused
    # a later batch with a stored id
    make_batch_writer(paths["store"], paths["rejected"], paths["checkpoint"], RULES)(batch, 7)
    assert store() == want
    assert rejected_ids(spark, paths["rejected"]) == sorted(refused * 2 + [("O1", "duplicate"), ("O2", "duplicate")])


def test_unreadable_store_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        read_store(spark, str(tmp_path / "nowhere")).count()


def test_csv_columns_by_name_and_quotes(spark, tmp_path):
    for folder in ("2024", "2025"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "p.csv").write_text(f'category,sku,active,cost\n"Big ""red"", one",SKU1,True,{folder}\n')
    rows = scan_csv(spark, str(tmp_path / "*"), ["sku", "cost", "category"]).orderBy("_ord").collect()
    assert [(r.sku, r.cost, r.category) for r in rows] == [("SKU1", "2024", 'Big "red", one'), ("SKU1", "2025", 'Big "red", one')]
    with pytest.raises(ValueError, match="brand"):
        scan_csv(spark, str(tmp_path / "*"), ["sku", "brand"])


def test_dates_outside_nanosecond_range(spark):
    days = ["1600-05-05", "1677-09-21", "1677-09-22", "2262-04-11", "2262-04-12", "9999-12-31", "2024-2-30"]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d string").select(to_date_lenient("d")).collect()]
    assert [g and str(g) for g in got] == [None, None, "1677-09-22", "2262-04-11", None, None, None]


def test_missing_flag_column_is_false(spark):
    row = spark.sql("SELECT 'O1' order_id, 'C1' customer_id, 'S1' sku, 'retail' channel, DATE'2024-01-02' order_date, 2 quantity, 3.00BD unit_price, 6.00BD revenue, 1.00BD cost, false is_return")
    out = fact_sales(row).first()
    assert all(out[f] is False for f in FLAGS)


def test_delete_is_kept_and_ids_are_not_given_again(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(map(json.dumps, FORM)))
    run = lambda: run_intake_stream(spark, str(src), str(tmp_path / "out"), RULES, dt.datetime(2025, 2, 1))
    paths = run()
    report = delete_stored(spark, paths["store"], spark.createDataFrame([("o2",), ("O2",), ("zz",)], "order_id string"))
    assert sorted(tuple(r) for r in report.collect()) == [("O2", 1), ("ZZ", 0)]
    store = lambda: sorted((r.id, r.order_id) for r in read_store(spark, paths["store"]).collect())
    assert store() == [(1, "O1")]
    (src / "b.json").write_text(json.dumps(FORM[1]))
    run()
    assert store() == [(1, "O1"), (3, "O2")]


def test_listing_before_an_id(spark):
    rows = spark.range(1, 10).selectExpr("id", "'O' || id order_id", "'C' customer_id", "'S' sku", "1 quantity", "1.00BD unit_price",
                                         "DATE'2025-01-01' order_date", "'retail' channel", "TIMESTAMP'2025-01-01' created_at")
    assert [r.id for r in J.list_orders(rows, limit=3, before=5).collect()] == [4, 3, 2]


def test_incremental_loads_add_only_unseen_rows_in_sequence(spark, tmp_path, capsys):
    (tmp_path / "c.csv").write_text("customer_id,name,country,segment,created_at\nC1,Ann,Peru,Retail,2020-01-01\n")
    (tmp_path / "p.csv").write_text("sku,category,cost,active\nS1,Roses,1,True\n")
    head = "order_id,customer_id,sku,quantity,unit_price,order_date,channel\n"
    loads = ["O1,C1,S1,1,5,2024-01-02,retail\n", "O1,C1,S1,9,5,2024-01-02,retail\nO2,C1,S1,2,5,2024-01-03,retail\n",
             "O2,C1,S1,2,5,2024-01-03,retail\nO3,C1,S1,3,5,2024-01-04,retail\n"]
    out, files = str(tmp_path / "out"), ["b.csv", "a.csv", "c0.csv"]  # the second load's name sorts before the first's
    for i, (rows, name) in enumerate(zip(loads, files, strict=True)):
        (tmp_path / name).write_text(head + rows)
        cli.main(["refresh", "--orders", str(tmp_path / name), "--customers", str(tmp_path / "c.csv"), "--products", str(tmp_path / "p.csv"),
                  "--out", out, "--version", f"v{i}", "--mode", "incremental" if i else "full"])
    capsys.readouterr()
    assert R.load_chain(spark, out, "v2") == ["v0", "v1", "v2"]
    assert sorted(r.order_id for r in R.read_published(spark, out, "raw_orders").collect()) == ["O1", "O1", "O2", "O3"]
    assert R.read_published(spark, out, "raw_customers").count() == 1
    got = sorted((r.order_id, int(r.quantity)) for r in R.read_published(spark, out, "fact_sales").collect())
    assert got == [("O1", 1), ("O2", 2), ("O3", 3)]
    assert R.read_published(spark, out, "fact_sales", "v0").count() == 1
