"""Checked queries: sorts, slices, splits, samples and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.exprs import round_doubles
from riskweft.operators import encoding, splits
from riskweft.plans.registry import query
from riskweft.sources.transactions import read_table, transactions, transactions_with_gaps


def key_sql(row_id: str = "event_id", seed: int = 42) -> str:
    """The seeded row key in DuckDB."""
    return f"CAST(('0x' || substr(md5(concat_ws(':', {row_id}, '{seed}')), 1, 15)) AS BIGINT)"


KEYED = f"keyed AS (SELECT event_id, step, isFraud, {key_sql()} AS k FROM txn)"


@query("f2_sort_by_step", "SELECT event_id, step FROM txn ORDER BY step, event_id")
def _(spark, sf):
    return splits.sort_rows(transactions(spark, sf).select("event_id", "step"))


@query("f3_shuffle_rows", "SELECT event_id, type FROM txn")
def _(spark, sf):
    return splits.shuffle_rows(transactions(spark, sf).select("event_id", "type"))


@query(
    "f4_slice_rows",
    """SELECT event_id, step FROM (SELECT event_id, step, row_number() OVER (ORDER BY step, event_id) - 1 AS i, count(*) OVER () AS n FROM txn) r
       WHERE i >= n // 4 AND i < n // 2""",
)
def _(spark, sf):
    df = transactions(spark, sf).select("event_id", "step")
    n = df.count()
    return splits.slice_rows(df, "step", "event_id", n // 4, n // 2)


@query(
    "f10_random_union_sample",
    "SELECT event_id, isFraud FROM keyed ORDER BY k, event_id LIMIT (SELECT count(*) // 3 FROM keyed)",
    ctes=KEYED,
)
def _(spark, sf):
    df = transactions(spark, sf).select("event_id", "isFraud")
    parts = [df.filter("isFraud = 1"), df.filter("isFraud = 0")]
    return splits.random_union_sample(parts, df.count() // 3)


@query("f11_union_rows", "SELECT event_id, type FROM txn WHERE isFraud = 1 UNION ALL SELECT event_id, type FROM txn WHERE isFraud = 0")
def _(spark, sf):
    df = transactions(spark, sf)
    return df.filter("isFraud = 1").select("event_id", "type").unionByName(df.filter("isFraud = 0").select("event_id", "type"))


def _positions(order: str, train: str, evaluate: str, table: str = "keyed") -> str:
    return f"""SELECT event_id, isFraud, CASE WHEN i <= {train} THEN 'train' WHEN i <= {train} + {evaluate} THEN 'eval' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (ORDER BY {order}, event_id) AS i, count(*) OVER () AS n FROM {table}) r"""


@query("g1_temporal_split", _positions("step", "4000", "1000"), ctes=KEYED)
def _(spark, sf):
    return splits.temporal_split(transactions(spark, sf), 4000, 1000).select("event_id", "isFraud", "split")


@query("g1_temporal_split_default_sizes", _positions("step", "4000000", "1000000"), ctes=KEYED)
def _(spark, sf):
    return splits.temporal_split(transactions(spark, sf)).select("event_id", "isFraud", "split")


@query(
    "g1_orders_temporal_split",
    """SELECT o_orderkey, CASE WHEN i <= n * 2 // 3 THEN 'train' WHEN i <= n * 2 // 3 + n // 6 THEN 'eval' ELSE 'test' END AS split
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY date_diff('day', TIMESTAMP '1990-01-01', o_orderdate), o_orderkey) AS i, count(*) OVER () AS n FROM orders) r""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").withColumn("day", F.expr("timestampdiff(DAY, TIMESTAMP_NTZ'1990-01-01 00:00:00', o_orderdate)"))
    n = orders.count()
    return splits.temporal_split(orders, n * 2 // 3, n // 6, "day", "o_orderkey").select("o_orderkey", "split")


@query("g2_shuffled_split", _positions("k", "n // 2", "n // 4"), ctes=KEYED)
def _(spark, sf):
    df = transactions(spark, sf)
    n = df.count()
    return splits.shuffled_split(df, n // 2, n // 4).select("event_id", "isFraud", "split")


@query("g3_fractional_split", _positions("step", "CAST(floor(n * 0.6e0) AS BIGINT)", "CAST(floor(n * 0.2e0) AS BIGINT)"), ctes=KEYED)
def _(spark, sf):
    return splits.fractional_split(transactions(spark, sf)).select("event_id", "isFraud", "split")


STRATIFIED = f"""{KEYED}, strat AS (SELECT *, CASE WHEN i <= part THEN 'test' WHEN i <= 2 * part THEN 'eval' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY k, event_id) AS i,
    CAST(floor(count(*) OVER (PARTITION BY isFraud) * 0.2e0 + 0.5e0) AS BIGINT) AS part FROM keyed) r)"""


@query("g4_stratified_split", "SELECT event_id, isFraud, split FROM strat", ctes=STRATIFIED)
def _(spark, sf):
    return splits.stratified_split(transactions(spark, sf)).select("event_id", "isFraud", "split")


@query("g4_split_summary", 'SELECT split, count(*) AS "rows", CAST(sum(isFraud) AS BIGINT) AS positives FROM strat GROUP BY split', ctes=STRATIFIED)
def _(spark, sf):
    return splits.split_summary(splits.stratified_split(transactions(spark, sf)))


@query(
    "g4_label_split",
    f"""SELECT doc_id, toxic, CASE WHEN i <= part THEN 'test' WHEN i <= 2 * part THEN 'eval' ELSE 'train' END AS split FROM (
        SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY k, doc_id) AS i, CAST(floor(count(*) OVER (PARTITION BY toxic) * 0.2e0 + 0.5e0) AS BIGINT) AS part
        FROM (SELECT doc_id, toxic, {key_sql('doc_id')} AS k FROM labels) b) r""",
)
def _(spark, sf):
    return splits.stratified_split(read_table(spark, sf, "labels"), label="toxic", row_id="doc_id").select("doc_id", "toxic", "split")


@query(
    "g5_stratified_sample",
    """SELECT event_id, isFraud FROM (SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY k, event_id) AS i,
         CAST(floor((n // 5) * p / n) AS BIGINT) AS fraud_quota, n // 5 AS size FROM (SELECT *, count(*) OVER () AS n, CAST(sum(isFraud) OVER () AS DOUBLE) AS p FROM keyed) c) r
       WHERE i <= CASE WHEN isFraud = 1 THEN fraud_quota ELSE size - fraud_quota END""",
    ctes=KEYED,
)
def _(spark, sf):
    df = transactions(spark, sf).select("event_id", "isFraud")
    return splits.stratified_sample(df, df.count() // 5)


@query("g6_random_sample", "SELECT event_id, isFraud FROM keyed ORDER BY k, event_id LIMIT (SELECT count(*) // 4 FROM keyed)", ctes=KEYED)
def _(spark, sf):
    df = transactions(spark, sf).select("event_id", "isFraud")
    return splits.random_sample(df, df.count() // 4)


@query(
    "g7_stratified_folds",
    """SELECT event_id, isFraud, CAST((i >= n * 1 // 5) AS INTEGER) + CAST((i >= n * 2 // 5) AS INTEGER) + CAST((i >= n * 3 // 5) AS INTEGER) + CAST((i >= n * 4 // 5) AS INTEGER) AS fold
       FROM (SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY k, event_id) - 1 AS i, count(*) OVER (PARTITION BY isFraud) AS n FROM keyed) r""",
    ctes=KEYED,
)
def _(spark, sf):
    return splits.stratified_folds(transactions(spark, sf)).select("event_id", "isFraud", "fold")


BLOCKS = """blocks AS (SELECT *, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE 5 - (n - 1 - i) // (n // 6) END AS block
  FROM (SELECT event_id, step, isFraud, row_number() OVER (ORDER BY step NULLS LAST, event_id) - 1 AS i, count(*) OVER () AS n FROM txn) r)"""


@query("p1_time_blocks", "SELECT event_id, CAST(block AS INTEGER) AS block FROM blocks", ctes=BLOCKS)
def _(spark, sf):
    return splits.time_blocks(transactions(spark, sf)).select("event_id", "block")


@query(
    "p1_time_folds",
    """SELECT CAST(fold AS INTEGER) AS fold, count(*) FILTER (block < fold) AS train_rows, CAST(sum(isFraud) FILTER (block < fold) AS BIGINT) AS train_positives,
       max(step) FILTER (block < fold) AS train_last, count(*) FILTER (block = fold) AS test_rows, CAST(sum(isFraud) FILTER (block = fold) AS BIGINT) AS test_positives,
       min(step) FILTER (block = fold) AS test_first, max(step) FILTER (block = fold) AS test_last
       FROM blocks, (VALUES (1), (2), (3), (4), (5)) f(fold) GROUP BY fold""",
    ctes=BLOCKS,
)
def _(spark, sf):
    return splits.time_folds(transactions(spark, sf))


# Accounts of txn_gaps in the folds of g7; the means of the other folds.
FOLDED = f"""keyed AS (SELECT event_id, nameDest, nameOrig, isFraud, {key_sql()} AS k FROM txn_gaps),
  folded AS (SELECT *, CAST((i >= n * 1 // 5) AS INTEGER) + CAST((i >= n * 2 // 5) AS INTEGER) + CAST((i >= n * 3 // 5) AS INTEGER) + CAST((i >= n * 4 // 5) AS INTEGER) AS fold
    FROM (SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY k, event_id) - 1 AS i, count(*) OVER (PARTITION BY isFraud) AS n FROM keyed) r),
  priors AS (SELECT a.fold, CAST(sum(b.p) AS DOUBLE) / sum(b.n) AS prior FROM (SELECT DISTINCT fold FROM folded) a
    JOIN (SELECT fold, sum(isFraud) AS p, count(*) AS n FROM folded GROUP BY fold) b ON a.fold <> b.fold GROUP BY a.fold)"""


def _means_sql(key: str) -> str:
    return f"""SELECT event_id, round((coalesce(w.p - o.p, 0) + 20.0e0 * prior) / (coalesce(w.n - o.n, 0) + 20.0e0), 6) AS encoded
      FROM folded f JOIN priors USING (fold)
      LEFT JOIN (SELECT {key}, CAST(sum(isFraud) AS DOUBLE) AS p, count(*) AS n FROM folded GROUP BY {key}) w ON f.{key} = w.{key}
      LEFT JOIN (SELECT {key}, fold, CAST(sum(isFraud) AS DOUBLE) AS p, count(*) AS n FROM folded GROUP BY {key}, fold) o ON f.{key} = o.{key} AND f.fold = o.fold"""


def _means(key: str):
    def run(spark, sf):
        df = transactions_with_gaps(spark, sf).select("event_id", "nameOrig", "nameDest", "isFraud")
        return round_doubles(encoding.out_of_fold_means(df, key, "encoded").select("event_id", "encoded"))

    return run


query("p2_out_of_fold_origin", _means_sql("nameOrig"), ctes=FOLDED)(_means("nameOrig"))
query("p2_out_of_fold_destination", _means_sql("nameDest"), ctes=FOLDED)(_means("nameDest"))


@query(
    "p2_target_encoding",
    """SELECT t.event_id, round((coalesce(w.p, 0) + 20.0e0 * prior) / (coalesce(w.n, 0) + 20.0e0), 6) AS encoded FROM txn_gaps t
       CROSS JOIN (SELECT CAST(sum(isFraud) AS DOUBLE) / count(*) AS prior FROM txn_gaps WHERE event_id % 2 = 0) a
       LEFT JOIN (SELECT nameDest, CAST(sum(isFraud) AS DOUBLE) AS p, count(*) AS n FROM txn_gaps WHERE event_id % 2 = 0 GROUP BY nameDest) w ON t.nameDest = w.nameDest""",
)
def _(spark, sf):
    """Means learned from the even rows, looked up for all rows."""
    df = transactions_with_gaps(spark, sf).select("event_id", "nameDest", "isFraud")
    return round_doubles(encoding.fit_target_encoder(df.filter("event_id % 2 = 0"), "nameDest").transform(df, "encoded").select("event_id", "encoded"))
