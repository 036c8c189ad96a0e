"""Checked queries: scans, sources, sinks and inspection."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators.validation import validate_table
from riskweft.plans.registry import query
from riskweft.schema import COLUMN_TYPES, REQUEST_FIELDS, REQUIRED_COLUMNS, TRANSACTION_SCHEMA
from riskweft.session import scratch_path
from riskweft.sources import inspection, readers, writers
from riskweft.sources.transactions import transactions, transactions_as_text, transactions_with_gaps

TXN_COLS = ", ".join(REQUIRED_COLUMNS)
REQ_COLS = ", ".join(REQUEST_FIELDS)

# The same coercion in DuckDB: text that does not parse and non-integral integers become NULL.
DUCK_CASTS = ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}"
    if t == "double"
    else f"CASE WHEN TRY_CAST({c} AS DOUBLE) = floor(TRY_CAST({c} AS DOUBLE)) THEN CAST(TRY_CAST({c} AS DOUBLE) AS {'BIGINT' if t == 'bigint' else 'INTEGER'}) END AS {c}"
    if t in ("int", "bigint")
    else c
    for c, t in COLUMN_TYPES.items()
)


@query("a1_table_scan", "SELECT * FROM events")
def _(spark, sf):
    return readers.load_table(spark, f"{sf}/events.parquet")


@query("a2_load_and_prepare", f"SELECT event_id, {DUCK_CASTS} FROM txn_text")
def _(spark, sf):
    return readers.load_and_prepare(transactions_as_text(spark, sf))


@query("a3_csv_source", f"SELECT {REQ_COLS} FROM txn")
def _(spark, sf):
    path = writers.export_table(transactions(spark, sf).select(*REQUEST_FIELDS), scratch_path(spark, "requests-csv"), "csv")
    return readers.read_requests_csv(spark, path)


@query("a4_query_source", "SELECT event_id, type, amount FROM txn WHERE amount > 100000 AND type = 'TRANSFER'")
def _(spark, sf):
    return readers.query_source(
        spark, "SELECT event_id, type, amount FROM {txn} WHERE amount > 100000 AND type = 'TRANSFER'", txn=transactions(spark, sf)
    )


@query("a5_json_records", f"SELECT event_id, {REQ_COLS} FROM txn")
def _(spark, sf):
    payloads = transactions(spark, sf).select("event_id", F.to_json(F.struct(*REQUEST_FIELDS)).alias("payload"))
    return readers.read_json_records(payloads, "payload", ["event_id"]).drop("record_index")


@query(
    "a5_json_props",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def _(spark, sf):
    events = readers.load_table(spark, f"{sf}/events.parquet")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("a6_export_parquet", f"SELECT {TXN_COLS} FROM txn")
def _(spark, sf):
    path = writers.export_table(transactions(spark, sf).select(*REQUIRED_COLUMNS), scratch_path(spark, "export"), "parquet")
    return readers.load_table(spark, path)


@query("a6_export_csv", f"SELECT {TXN_COLS} FROM txn")
def _(spark, sf):
    path = writers.export_table(transactions(spark, sf).select(*REQUIRED_COLUMNS), scratch_path(spark, "export"), "csv")
    return readers.read_requests_csv(spark, path, TRANSACTION_SCHEMA)


@query(
    "a9_table_info",
    """SELECT CAST(i AS INTEGER) AS position, c AS "column", t AS data_type, (SELECT count(*) FROM events) AS row_count
       FROM (VALUES (0,'event_id','bigint'),(1,'ts','timestamp_ntz'),(2,'user_id','bigint'),(3,'event_type','string'),
                    (4,'value','double'),(5,'props','string')) v(i, c, t)""",
)
def _(spark, sf):
    return inspection.table_info(readers.load_table(spark, f"{sf}/events.parquet")).drop("nullable")


@query("a10_head_rows", f"SELECT event_id, {TXN_COLS} FROM txn ORDER BY event_id LIMIT 5")
def _(spark, sf):
    return inspection.head_rows(transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS), ["event_id"], 5)


@query(
    "a11_distinct_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS expected_type, count(DISTINCT {c}) AS unique_values FROM txn_gaps"""
        for c, t in COLUMN_TYPES.items()
    ),
)
def _(spark, sf):
    return inspection.distinct_counts(transactions_with_gaps(spark, sf))


@query(
    "a12_inspection_report",
    "SELECT 'distinct' AS section, item, CAST(n AS VARCHAR) AS value FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS item, count(DISTINCT {c}) AS n FROM txn" for c in COLUMN_TYPES)
    + ") d UNION ALL SELECT 'table', 'row_count', CAST(count(*) AS VARCHAR) FROM txn UNION ALL SELECT 'schema', c, t FROM (VALUES ('event_id','bigint'), "
    + ", ".join(f"('{c}','{t}')" for c, t in COLUMN_TYPES.items())
    + ") v(c, t) UNION ALL SELECT * FROM (SELECT 'head', CAST(event_id AS VARCHAR), concat_ws('|', event_id, step, type, nameOrig, nameDest, isFraud) "
    + "FROM txn ORDER BY event_id LIMIT 5) h",
)
def _(spark, sf):
    """The head's values are compared field by field: JSON writes doubles in another way than SQL does."""
    report = inspection.inspection_report(transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS), ["event_id"])
    fields = F.concat_ws("|", *[F.get_json_object("value", f"$.{c}") for c in ("event_id", "step", "type", "nameOrig", "nameDest", "isFraud")])
    return report.withColumn("value", F.when(F.col("section") == "head", fields).otherwise(F.col("value")))


@query(
    "b2_validate_table",
    """SELECT 'rows' AS "check", count(*) AS "count" FROM txn_gaps UNION ALL """
    + " UNION ALL ".join(f"SELECT 'null_{c}', count(*) - count({c}) FROM txn_gaps" for c in REQUIRED_COLUMNS)
    + """ UNION ALL SELECT 'class_0', count(*) FILTER (isFraud = 0) FROM txn_gaps
          UNION ALL SELECT 'class_1', count(*) FILTER (isFraud = 1) FROM txn_gaps
          UNION ALL SELECT 'negative_amount', count(*) FILTER (amount < 0) FROM txn_gaps""",
)
def _(spark, sf):
    return validate_table(transactions_with_gaps(spark, sf))
