"""Registered queries: streams over the events files, run to the end of the available input."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.exprs import round_doubles
from riskweft.operators.scoring import response_records
from riskweft.operators.reference import store_reference
from riskweft.plans.queries_models import RESPONSE_SQL, fitted_model
from riskweft.plans.queries_profile import union
from riskweft.plans.queries_sources import DUCK_CASTS
from riskweft.plans.queries_stats import ks_sql, rounded_test, tested_sql
from riskweft.plans.queries_validation import REQUEST_ERROR_SQL
from riskweft.plans.registry import query
from riskweft.schema import MONEY_COLUMNS
from riskweft.session import scratch_path
from riskweft.sources.transactions import derive_text, derive_transactions, read_table, transactions
from riskweft.streaming import aggregates, drift, runner, scoring


def events_stream(spark, sf):
    schema = read_table(spark, sf, "events").schema
    # The file source wants a folder or a pattern.
    return runner.read_stream(spark, f"{sf}/event[s].parquet", schema)


@query("l1_response_stream", RESPONSE_SQL)
def _(spark, sf):
    out, checkpoint = scratch_path(spark, "responses"), scratch_path(spark, "checkpoint")
    records = scoring.response_stream(derive_transactions(spark, events_stream(spark, sf)), "score")
    stream = records.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.schema(response_records(transactions(spark, sf), "score").schema).parquet(out)


@query("l1_validated_stream", f"SELECT event_id, {DUCK_CASTS} FROM txn_text WHERE {REQUEST_ERROR_SQL} IS NULL")
def _(spark, sf):
    return _validated(spark, sf)[0]


@query("l2_quarantine_stream", f"SELECT event_id, e AS error FROM (SELECT event_id, {REQUEST_ERROR_SQL} AS e FROM txn_text) v WHERE e IS NOT NULL")
def _(spark, sf):
    return _validated(spark, sf)[1].select("event_id", "error")


def _validated(spark, sf):
    from riskweft.operators.validation import cast_schema, split_valid

    valid_out, bad_out = scratch_path(spark, "valid"), scratch_path(spark, "quarantine")
    runner.run_to_end(derive_text(spark, events_stream(spark, sf)), scoring.validation_handler(valid_out, bad_out), scratch_path(spark, "checkpoint"))
    valid, bad = split_valid(derive_text(spark, read_table(spark, sf, "events")))
    return (
        runner.read_batches(spark, valid_out, cast_schema(valid).schema).drop("batch_id"),
        runner.read_batches(spark, bad_out, bad.schema).drop("batch_id"),
    )


@query("l1_model_stream")
def _(spark, sf):
    from riskweft.operators.scoring import score_requests

    trained = fitted_model(spark, sf, "decision_tree")
    out, bad = scratch_path(spark, "scored"), scratch_path(spark, "rejected")
    runner.run_to_end(derive_text(spark, events_stream(spark, sf)), scoring.scoring_handler(trained, out, bad), scratch_path(spark, "checkpoint"))
    schema = score_requests(derive_text(spark, read_table(spark, sf, "events")), trained)[0].schema
    return runner.read_batches(spark, out, schema).select("event_id", "fraud_probability", "is_fraud")


@query(
    "l3_windowed_fraud_rate",
    """SELECT start AS window_start, count(*) AS total, CAST(sum(isFraud) AS BIGINT) AS fraud, round(avg(isFraud) * 100.0e0, 6) AS fraud_rate
       FROM (SELECT isFraud, date_trunc('hour', ts) - to_hours(CAST(unnest(range(24)) AS BIGINT)) AS start FROM txn) w GROUP BY start""",
)
def _(spark, sf):
    out = scratch_path(spark, "windows")
    counts = aggregates.windowed_counts(derive_transactions(spark, events_stream(spark, sf)))
    runner.run_to_end(counts, aggregates.update_handler(out), scratch_path(spark, "checkpoint"), "update")
    latest = aggregates.latest_windows(runner.read_batches(spark, out, aggregates.WINDOW_SCHEMA))
    return round_doubles(latest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


def _batch_drift_sql(part: int) -> str:
    """The test of one part of the events against the early hours."""
    return f"SELECT *, CAST({part} AS BIGINT) AS batch_id FROM ({tested_sql(union([ks_sql(c, 'ref', f'part{part}') for c in MONEY_COLUMNS]))}) b{part}"


PARTS = 3


@query(
    "l4_batch_drift",
    union([_batch_drift_sql(k) for k in range(PARTS)]),
    ctes="ref AS (SELECT * FROM txn WHERE step < 360), " + ", ".join(f"part{k} AS (SELECT * FROM txn WHERE event_id % {PARTS} = {k})" for k in range(PARTS)),
)
def _(spark, sf):
    """Three files that arrive one after the other, each a batch against the stored distribution."""
    arriving, out, path = scratch_path(spark, "arriving"), scratch_path(spark, "drift"), scratch_path(spark, "reference")
    store_reference(transactions(spark, sf).filter("step < 360"), MONEY_COLUMNS, path)
    events = read_table(spark, sf, "events")
    for k in range(PARTS):
        events.filter(F.col("event_id") % PARTS == k).coalesce(1).write.mode("append").parquet(arriving)
    stream = runner.read_stream(spark, arriving, events.schema, files_per_batch=1)
    runner.run_to_end(derive_transactions(spark, stream), drift.drift_handler(path, out), scratch_path(spark, "checkpoint"))
    return rounded_test(runner.read_batches(spark, out, drift.DRIFT_SCHEMA))


@query("l5_account_counts", "SELECT nameOrig AS account, count(*) AS n FROM txn GROUP BY nameOrig")
def _(spark, sf):
    out = scratch_path(spark, "accounts")
    counts = aggregates.account_counts(derive_transactions(spark, events_stream(spark, sf)))
    runner.run_to_end(counts, aggregates.update_handler(out), scratch_path(spark, "checkpoint"), "update")
    return aggregates.latest_accounts(runner.read_batches(spark, out, aggregates.ACCOUNT_SCHEMA))
