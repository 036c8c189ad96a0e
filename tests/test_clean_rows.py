import math

import duckdb

import __spark_entry__ as entry


def test_clean_rows_equal_their_sql_on_nan(spark, sf, tmp_path):
    odd = spark.read.parquet(f"{sf}/events.parquet").filter("event_id < 40").selectExpr(
        "event_id", "ts", "user_id", "event_type", "IF(event_id = 5, double('NaN'), value) AS value", "props"
    )
    odd.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = [tuple(r) for r in entry.queries()["b4_clean_rows"](spark, str(tmp_path)).collect()]
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        expected = con.execute(entry.oracle_sql()["b4_clean_rows"]).fetchall()
    assert any(isinstance(x, float) and math.isnan(x) for r in expected for x in r)
    assert sorted(map(str, found)) == sorted(map(str, expected))
