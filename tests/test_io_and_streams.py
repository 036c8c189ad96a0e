import json

import pytest
from pyspark.sql import functions as F

from riskweft.operators import quality_report, validation
from riskweft.plans import jobs
from riskweft.schema import REQUIRED_COLUMNS
from riskweft.session import scratch_path
from riskweft.sources import inspection, readers, writers
from riskweft.sources.transactions import derive_transactions, read_table, transactions_with_gaps
from riskweft.streaming import aggregates, runner


def test_sources_and_sinks(spark, txn, tmp_path):
    table = txn.select(*REQUIRED_COLUMNS)
    with pytest.raises(ValueError):
        writers.export_table(table, str(tmp_path / "x"), "pickle")
    with pytest.raises(Exception):
        readers.load_table(spark, str(tmp_path / "missing"))
    path = writers.export_table(table, str(tmp_path / "t"), "parquet")
    assert readers.load_table(spark, path, max_rows=7).count() == 7
    assert readers.load_table(spark, path, max_rows=0).count() == 1000
    assert inspection.head_rows(txn, ["event_id"], 3).count() == 3
    stored = writers.write_predictions(txn.select("event_id", "score"), str(tmp_path))
    assert spark.read.option("header", True).csv(stored).count() == 1000


def test_json_payloads(spark):
    good = {"step": 1, "type": "PAYMENT", "amount": 5.0, "nameOrig": "C1", "oldbalanceOrg": 1.0, "newbalanceOrig": 2.0, "nameDest": "M1", "oldbalanceDest": 0.0, "newbalanceDest": 0.0}
    rows = [
        (1, json.dumps(good)),
        (2, json.dumps({k: v for k, v in good.items() if k != "amount"})),
        (3, json.dumps({**good, "type": None})),
        (4, json.dumps({**good, "amount": "abc"})),
        (5, json.dumps([good, good])),
    ]
    df = spark.createDataFrame(rows, "id int, payload string")
    errors = {r["id"]: r["error"] for r in validation.validate_payloads(df.filter("id < 5"), "payload").collect()}
    assert errors == {1: None, 2: "Missing required field: amount", 3: "Field type cannot be None", 4: validation.BAD_TYPES}
    records = readers.read_json_records(df.filter("id IN (1, 5)"), "payload", ["id"])
    assert records.groupBy("id").count().orderBy("id").collect() == [(1, 1), (5, 2)]


def test_required_columns_and_rows(txn):
    with pytest.raises(ValueError, match="amount"):
        validation.require_columns(txn.drop("amount"))
    with pytest.raises(ValueError):
        validation.validate_table(txn.filter("event_id < 0"))


def test_casts_leave_reasons(spark):
    df = spark.createDataFrame([("1", "2.5", "x"), ("1.5", "nan", "y"), (None, "oops", "z"), ("3.0", "1e3", "w")], "isFraud string, amount string, other string")
    rows = validation.cast_schema(df).collect()
    assert [(r["isFraud"], r["amount"]) for r in rows] == [(1, 2.5), (None, None), (None, None), (3, 1000.0)]
    failed = {r["column"]: r["failed"] for r in validation.cast_failures(df).collect()}
    assert failed == {"isFraud": 1, "amount": 2}


def test_quality_report_text(spark, sf):
    df = transactions_with_gaps(spark, sf).filter("oldbalanceOrg IS NULL OR abs(oldbalanceOrg) < double('Infinity')").select(*REQUIRED_COLUMNS)
    text = quality_report.render_markdown(quality_report.quality_report(df), quality_report.recommendations(df))
    assert "## overview" in text and "## recommendations" in text


def test_extract_job(spark, txn, tmp_path):
    tables = jobs.extract_job(txn.select("event_id", *REQUIRED_COLUMNS), str(tmp_path / "e"), 200)
    assert tables["sample"].count() == 200
    assert spark.read.json(str(tmp_path / "e" / "inspection")).filter("section = 'head'").count() == 5


@pytest.fixture(scope="module")
def event_files(spark, sf, tmp_path_factory):
    """The events in five files, oldest first."""
    folder = tmp_path_factory.mktemp("events")
    events = read_table(spark, sf, "events")
    for i in range(5):
        low, high = i * 200, (i + 1) * 200
        events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def test_windows_over_many_batches_equal_one_batch(spark, sf, event_files):
    schema = read_table(spark, sf, "events").schema
    stream = runner.read_stream(spark, event_files, schema, files_per_batch=1)
    out = scratch_path(spark, "w")
    counts = aggregates.windowed_counts(derive_transactions(spark, stream), lateness="40 days")
    runner.run_to_end(counts, aggregates.update_handler(out), scratch_path(spark, "c"), "update")
    batches = runner.read_batches(spark, out, aggregates.WINDOW_SCHEMA)
    assert batches.select("batch_id").distinct().count() >= 5
    streamed = {tuple(r) for r in aggregates.latest_windows(batches).select("window_start", "total", "fraud").collect()}
    batch = {tuple(r) for r in aggregates.windowed_counts(derive_transactions(spark, read_table(spark, sf, "events"))).collect()}
    assert streamed == batch


def test_account_counts_over_many_batches(spark, sf, event_files):
    schema = read_table(spark, sf, "events").schema
    stream = runner.read_stream(spark, event_files, schema, files_per_batch=2)
    out = scratch_path(spark, "a")
    runner.run_to_end(aggregates.account_counts(derive_transactions(spark, stream)), aggregates.update_handler(out), scratch_path(spark, "c"), "update")
    streamed = {tuple(r) for r in aggregates.latest_accounts(runner.read_batches(spark, out, aggregates.ACCOUNT_SCHEMA)).collect()}
    batch = {tuple(r) for r in aggregates.account_counts(derive_transactions(spark, read_table(spark, sf, "events"))).collect()}
    assert streamed == batch
