"""Checked queries: fitted preprocessing, neighbours and rebalancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.exprs import round_doubles
from riskweft.functions.features import amount_category
from riskweft.operators import knn, preprocess, resample
from riskweft.plans.queries_features import CATEGORY_SQL
from riskweft.plans.queries_features import GAPS, gaps
from riskweft.plans.queries_splits import key_sql
from riskweft.plans.registry import query
from riskweft.schema import MONEY_COLUMNS
from riskweft.sources.transactions import read_table, transactions, transactions_with_gaps

MED = {c: f"(SELECT quantile_cont({c}, 0.5) FROM gaps)" for c in MONEY_COLUMNS}


@query("h1_median_imputer", "SELECT event_id, " + ", ".join(f"round(coalesce({c}, {MED[c]}), 6) AS {c}" for c in MONEY_COLUMNS) + " FROM gaps", ctes=GAPS)
def _(spark, sf):
    df = gaps(spark, sf)
    fill = preprocess.fit_medians(df, MONEY_COLUMNS)
    return round_doubles(df.select("event_id", *[preprocess.impute(c, fill[c]).alias(c) for c in MONEY_COLUMNS]))


MODE = "(SELECT {c} FROM txn_gaps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "h2_most_frequent_imputer",
    f"SELECT event_id, coalesce(type, {MODE.format(c='type')}) AS type, coalesce(nameDest, {MODE.format(c='nameDest')}) AS nameDest FROM txn_gaps",
)
def _(spark, sf):
    df = transactions_with_gaps(spark, sf)
    modes = preprocess.fit_modes(df, ["type", "nameDest"])
    return df.select("event_id", *[preprocess.impute(c, m).alias(c) for c, m in modes.items()])


FILLED = f"{GAPS}, filled AS (SELECT event_id, {', '.join(f'coalesce({c}, {MED[c]}) AS {c}' for c in MONEY_COLUMNS)} FROM gaps)"


@query(
    "h3_standard_scaler",
    "SELECT event_id, " + ", ".join(f"round(({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled), 6) AS {c}" for c in MONEY_COLUMNS) + " FROM filled",
    ctes=FILLED,
)
def _(spark, sf):
    return _scaled(gaps(spark, sf), "standard")


@query(
    "h4_robust_scaler",
    "SELECT event_id, "
    + ", ".join(
        f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM filled)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM filled), 6) AS {c}"
        for c in MONEY_COLUMNS
    )
    + " FROM filled",
    ctes=FILLED,
)
def _(spark, sf):
    return _scaled(gaps(spark, sf), "robust")


def _scaled(df, scaling):
    fill = preprocess.fit_medians(df, MONEY_COLUMNS)
    fitted = preprocess.fit_scaling(df, MONEY_COLUMNS, fill, scaling)
    return round_doubles(df.select("event_id", *[preprocess.scale(preprocess.impute(c, fill[c]), *fitted[c]).alias(c) for c in MONEY_COLUMNS]))


TYPES = ["CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"]
BUCKETS = ["large", "medium", "small", "very_large", "very_small"]


def _hot(column: str, values: list[str]) -> str:
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS {column}_{v}" for v in values)


@query(
    "h5_one_hot_drop_first",
    f"""SELECT event_id, {_hot('type', TYPES[1:])}, CASE WHEN type IS NULL THEN 1.0e0 ELSE 0.0e0 END AS "type_None", {_hot('amount_category', BUCKETS[1:])},
        CASE WHEN amount_category IS NULL THEN 1.0e0 ELSE 0.0e0 END AS "amount_category_None" FROM (SELECT event_id, type, {CATEGORY_SQL} FROM txn_gaps) b""",
)
def _(spark, sf):
    df = transactions_with_gaps(spark, sf).withColumn("amount_category", amount_category(F.col("amount")))
    found = preprocess.fit_categories(df, ["type", "amount_category"])
    columns = {k: v for c in found for k, v in preprocess.one_hot(c, found[c], True).items()}
    return df.select("event_id", *[v.alias(k) for k, v in columns.items()])


@query("h6_one_hot_full", f"SELECT event_id, {_hot('type', TYPES)} FROM txn")
def _(spark, sf):
    df = transactions(spark, sf)
    found = preprocess.fit_categories(df, ["type"])
    return df.select("event_id", *[v.alias(k) for k, v in preprocess.one_hot("type", found["type"], False).items()])


@query("h7_label_encoder", "SELECT event_id, CASE type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TYPES)) + " END AS type_code FROM txn")
def _(spark, sf):
    df = transactions(spark, sf)
    return df.select("event_id", preprocess.label_code("type", preprocess.fit_categories(df, ["type"])["type"]).alias("type_code"))


def _composite_sql(centre: str, width: str, hot: str) -> str:
    numbers = ", ".join(f"round(({c} - (SELECT {centre.format(c=c)} FROM txn)) / (SELECT {width.format(c=c)} FROM txn), 6) AS {c}" for c in MONEY_COLUMNS)
    return f"SELECT event_id, {numbers}, {hot} FROM txn"


@query("h8_composite_standard", _composite_sql("avg({c})", "stddev_pop({c})", _hot("type", TYPES[1:])))
def _(spark, sf):
    df = transactions(spark, sf)
    fitted = preprocess.Preprocessor(preset="none", numericCols=MONEY_COLUMNS, categoricalCols=["type"]).fit(df)
    return round_doubles(fitted.to_frame(df, ["event_id"]))


@query("h10_composite_robust", _composite_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)", _hot("type", TYPES)))
def _(spark, sf):
    df = transactions(spark, sf)
    fitted = preprocess.Preprocessor.notebook(preset="none", numericCols=MONEY_COLUMNS, categoricalCols=["type"]).fit(df)
    return round_doubles(fitted.to_frame(df, ["event_id"]))


# Numeric features in the order of the assembled vector.
FEATURE_ORDER = [
    "amount",
    "oldbalanceOrg",
    "oldbalanceDest",
    "newbalanceOrig",
    "newbalanceDest",
    "balance_diff_orig",
    "balance_diff_dest",
    "balance_orig_zero",
    "balance_dest_zero",
    "zero_balance_after_transaction",
    "balance_orig_ratio",
    "balance_dest_ratio",
    "amount_log",
    "amount_per_balance_orig",
    "empties_origin",
    "creates_dest_balance",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_business_hours",
    "is_night",
    "same_account_transfer",
    "orig_is_customer",
    "dest_is_customer",
]


@query(
    "h9_feature_names",
    "SELECT CAST(i AS INTEGER) AS idx, n AS feature FROM (SELECT unnest(range(len(l))) AS i, unnest(l) AS n FROM (SELECT ["
    + ", ".join(f"'{c}'" for c in FEATURE_ORDER)
    + "] || (SELECT list('type_' || type ORDER BY type) FROM (SELECT DISTINCT type FROM txn) t WHERE type > (SELECT min(type) FROM txn)) || "
    + "(SELECT list('amount_category_' || amount_category ORDER BY amount_category) FROM (SELECT DISTINCT amount_category FROM c) t "
    + "WHERE amount_category > (SELECT min(amount_category) FROM c)) AS l) x) y",
    ctes=f"c AS (SELECT {CATEGORY_SQL} FROM txn)",
)
def _(spark, sf):
    return preprocess.Preprocessor().fit(transactions(spark, sf)).feature_table(spark)


# ---- neighbours ------------------------------------------------------------------------------------------------------

NEAR_COLUMNS = ["amount", "oldbalanceOrg", "oldbalanceDest"]
D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in NEAR_COLUMNS)
NEAR_SQL = f"""SELECT id, neighbour, d AS distance_sq, place FROM (
  SELECT a.event_id AS id, b.event_id AS neighbour, {D2} AS d, CAST(row_number() OVER (PARTITION BY a.event_id ORDER BY {D2}, b.event_id) AS INTEGER) AS place
  FROM (SELECT * FROM txn WHERE isFraud = 1) a JOIN (SELECT * FROM txn WHERE isFraud = 1) b ON a.event_id <> b.event_id) r WHERE place <= 5"""


@query("c3_minority_neighbours", f"SELECT id, neighbour, round(distance_sq, 3) AS distance_sq, place FROM ({NEAR_SQL}) n")
def _(spark, sf):
    points = knn.as_points(transactions(spark, sf).filter("isFraud = 1"), "event_id", NEAR_COLUMNS)
    near = knn.knn_join(points, points, 5, exclude_self=True)
    return near.withColumn("distance_sq", F.round("distance_sq", 3))


@query(
    "c3_embedding_neighbours",
    """SELECT id, neighbour, place FROM (SELECT a.vec_id AS id, b.vec_id AS neighbour, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY
       list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE))), b.vec_id) AS INTEGER) AS place
       FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) r WHERE place <= 5""",
)
def _(spark, sf):
    points = knn.as_points(read_table(spark, sf, "embeddings"), "vec_id", ["embedding"])
    return knn.knn_join(points, points, 5, exclude_self=True, points_per_pivot=256).select("id", "neighbour", "place")


VOTES = f"""parts AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY k, vec_id) AS i, CAST(floor(count(*) OVER (PARTITION BY label) * 0.2e0 + 0.5e0) AS BIGINT) AS part
    FROM (SELECT *, {key_sql('vec_id')} AS k FROM embeddings) e),
  near AS (SELECT a.vec_id AS id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY
      list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE))), b.vec_id) AS place
    FROM (SELECT * FROM parts WHERE i <= part) a, (SELECT * FROM parts WHERE i > 2 * part) b),
  votes AS (SELECT id, label, count(*) AS n FROM near WHERE place <= 5 GROUP BY id, label)"""


@query(
    "c4_knn_classifier",
    "SELECT id, label AS predicted, n / 5.0e0 AS share FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS r FROM votes) v WHERE r = 1",
    ctes=VOTES,
)
def _(spark, sf):
    from riskweft.operators.splits import stratified_split

    parts = stratified_split(read_table(spark, sf, "embeddings"), label="label", row_id="vec_id")
    return knn.knn_classify(parts.filter("split = 'train'"), parts.filter("split = 'test'"), ["embedding"], "label", "vec_id", 5)


# ---- rebalancing -----------------------------------------------------------------------------------------------------

SIZES = "n AS (SELECT count(*) FILTER (isFraud = 0) AS n0, count(*) FILTER (isFraud = 1) AS n1 FROM txn)"
SYNTHETIC = f"""{SIZES}, near AS ({NEAR_SQL}),
  base AS (SELECT event_id, {', '.join(NEAR_COLUMNS)}, (n0 - n1) // n1 + CASE WHEN row_number() OVER (ORDER BY {key_sql()}, event_id) <= (n0 - n1) % n1 THEN 1 ELSE 0 END AS m
    FROM txn, n WHERE isFraud = 1),
  copies AS (SELECT *, unnest(range(1, m + 1)) AS copy FROM base),
  drawn AS (SELECT *, {key_sql('event_id, copy', 43)} % 5 + 1 AS place, CAST({key_sql('event_id, copy', 44)} AS DOUBLE) / 1152921504606846976.0e0 AS u FROM copies),
  made AS (SELECT d.event_id, d.copy, 1 AS isFraud, {', '.join(f'd.{c} + d.u * (t.{c} - d.{c}) AS {c}' for c in NEAR_COLUMNS)}
    FROM drawn d JOIN near ON near.id = d.event_id AND near.place = d.place JOIN txn t ON t.event_id = near.neighbour)"""


@query("i1_smote_rows", f"SELECT event_id, copy, isFraud, {', '.join(f'round({c}, 6) AS {c}' for c in NEAR_COLUMNS)} FROM made", ctes=SYNTHETIC)
def _(spark, sf):
    return round_doubles(resample.synthetic_minority(transactions(spark, sf), NEAR_COLUMNS))


@query("i1_smote_class_counts", "SELECT c.isFraud, (SELECT greatest(n0, n1) FROM n) AS n FROM (SELECT DISTINCT isFraud FROM txn) c", ctes=SIZES)
def _(spark, sf):
    return resample.smote(transactions(spark, sf), NEAR_COLUMNS).groupBy("isFraud").agg(F.count(F.lit(1)).alias("n"))


@query(
    "i2_smote_guard",
    "SELECT event_id, isFraud, round(CASE WHEN isFraud = 1 THEN (n0 + n1) / (2.0e0 * n1) ELSE (n0 + n1) / (2.0e0 * n0) END, 9) AS weight FROM txn, n",
    ctes=SIZES,
)
def _(spark, sf):
    # More neighbours than the class can have, so the guard answers with class weights.
    df = transactions(spark, sf)
    guarded = resample.rebalance(df, NEAR_COLUMNS, k=df.count())
    return guarded.select("event_id", "isFraud", F.round("weight", 9).alias("weight"))


@query(
    "i3_random_oversample",
    "SELECT event_id, isFraud, 0 AS copy FROM txn UNION ALL SELECT event_id, 1, copy FROM copies",
    ctes=SYNTHETIC.split("drawn AS")[0].rstrip().rstrip(","),
)
def _(spark, sf):
    return resample.random_oversample(transactions(spark, sf).select("event_id", "isFraud"))


@query(
    "i4_class_weights",
    "SELECT event_id, round(CASE WHEN isFraud = 1 THEN (n0 + n1) / (2.0e0 * n1) ELSE (n0 + n1) / (2.0e0 * n0) END, 9) AS weight FROM txn, n",
    ctes=SIZES,
)
def _(spark, sf):
    return resample.with_class_weights(transactions(spark, sf)).select("event_id", F.round("weight", 9).alias("weight"))


@query(
    "i5_positive_weight",
    "SELECT event_id, round(CASE WHEN isFraud = 1 THEN CAST(n0 AS DOUBLE) / n1 ELSE 1.0e0 END, 9) AS weight FROM txn, n",
    ctes=SIZES,
)
def _(spark, sf):
    return resample.with_positive_weight(transactions(spark, sf)).select("event_id", F.round("weight", 9).alias("weight"))
