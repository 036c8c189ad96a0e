"""Checked queries: hypothesis tests and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.exprs import round_doubles
from riskweft.operators import drift, tests_of_difference as tests
from riskweft.plans.queries_profile import union
from riskweft.plans.registry import query
from riskweft.schema import MONEY_COLUMNS, NUMERIC_COLUMNS
from riskweft.session import scratch_path
from riskweft.sources.transactions import read_table, transactions

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def mann_whitney_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, CAST(n1 AS BIGINT) AS n_legit, CAST(n2 AS BIGINT) AS n_fraud, round(u, 3) AS u,
      round(greatest(abs(u - n1 * n2 / 2) - 0.5, 0) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z FROM (
        SELECT n1, n2, tie, rs - n1 * (n1 + 1) / 2 AS u FROM (
          SELECT CAST(sum(a) AS DOUBLE) AS n1, CAST(sum(b) AS DOUBLE) AS n2, CAST(sum(a * (before + (t + 1) / 2)) AS DOUBLE) AS rs, CAST(sum(t * t * t - t) AS DOUBLE) AS tie FROM (
            SELECT a, b, CAST(a + b AS DOUBLE) AS t, CAST(sum(a + b) OVER (ORDER BY v) - a - b AS DOUBLE) AS before FROM (
              SELECT {c} AS v, count(*) FILTER (isFraud = 0) AS a, count(*) FILTER (isFraud = 1) AS b FROM txn GROUP BY 1) g) r) s) m"""


@query("j1_mann_whitney", union([mann_whitney_sql(c) for c in NUMERIC_COLUMNS]))
def _(spark, sf):
    tested = tests.mann_whitney(transactions(spark, sf), NUMERIC_COLUMNS)
    return tested.select("feature", "n_legit", "n_fraud", F.round("u", 3).alias("u"), F.round("z", 6).alias("z"))


@query("j1_mann_whitney_significance")
def _(spark, sf):
    return tests.mann_whitney(transactions(spark, sf), NUMERIC_COLUMNS).select("feature", "p_value", "significant")


def contingency_sql(table: str, row: str, column: str) -> str:
    return f"""SELECT r.{row}, c.{column}, coalesce(o.n, 0) AS observed, r.n * CAST(c.n AS DOUBLE) / (SELECT count(*) FROM {table}) AS expected
      FROM (SELECT {row}, count(*) AS n FROM {table} GROUP BY 1) r CROSS JOIN (SELECT {column}, count(*) AS n FROM {table} GROUP BY 1) c
      LEFT JOIN (SELECT {row}, {column}, count(*) AS n FROM {table} GROUP BY 1, 2) o ON o.{row} = r.{row} AND o.{column} = c.{column}"""


def chi_square_sql(table: str, row: str, column: str) -> str:
    return f"""SELECT round(CASE WHEN dof = 1 THEN yates ELSE plain END, 6) AS statistic, dof FROM (
      SELECT sum((observed - expected) * (observed - expected) / expected) AS plain, sum(power(greatest(abs(observed - expected) - 0.5, 0), 2) / expected) AS yates,
        (count(DISTINCT {row}) - 1) * (count(DISTINCT {column}) - 1) AS dof FROM ({contingency_sql(table, row, column)}) t) s"""


@query("j2_expected_counts", f"SELECT type, isFraud, observed, round(expected, 6) AS expected FROM ({contingency_sql('txn', 'type', 'isFraud')}) t")
def _(spark, sf):
    return round_doubles(tests.contingency(transactions(spark, sf), "type", "isFraud"))


@query("j2_chi_square", chi_square_sql("txn", "type", "isFraud"))
def _(spark, sf):
    return round_doubles(tests.chi_square(transactions(spark, sf), "type", "isFraud")).select("statistic", "dof")


@query("j2_chi_square_orders", chi_square_sql("orders", "o_orderpriority", "o_orderstatus"))
def _(spark, sf):
    return round_doubles(tests.chi_square(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")).select("statistic", "dof")


@query("j2_chi_square_yates", chi_square_sql("labels", "quality", "toxic"))
def _(spark, sf):
    return round_doubles(tests.chi_square(read_table(spark, sf, "labels"), "quality", "toxic")).select("statistic", "dof")


@query(
    "j2_chi_square_significance",
    # The closed form of the tail for an even number of degrees of freedom, here 4.
    f"""SELECT statistic, dof, round(exp(-statistic / 2) * (1 + statistic / 2), 6) AS p_value, CASE WHEN exp(-statistic / 2) * (1 + statistic / 2) < 0.05e0 THEN 1 ELSE 0 END AS significant
        FROM ({chi_square_sql("txn", "type", "isFraud")}) x""",
)
def _(spark, sf):
    return round_doubles(tests.chi_square(transactions(spark, sf), "type", "isFraud"))


def ks_sql(c: str, reference: str, current: str) -> str:
    return f"""SELECT '{c}' AS feature, max(na) AS n_reference, max(nb) AS n_current, round(max(abs(ca / na - cb / nb)), 9) AS statistic FROM (
      SELECT CAST(sum(a) OVER () AS BIGINT) AS na, CAST(sum(b) OVER () AS BIGINT) AS nb, CAST(sum(a) OVER (ORDER BY v) AS DOUBLE) AS ca, CAST(sum(b) OVER (ORDER BY v) AS DOUBLE) AS cb FROM (
        SELECT v, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b FROM (SELECT {c} AS v, 1 AS a, 0 AS b FROM {reference} UNION ALL SELECT {c}, 0, 1 FROM {current}) s
        WHERE v IS NOT NULL GROUP BY v) g) r"""


def tested_sql(sql: str) -> str:
    """Adds p_value (Kolmogorov's series) and drifted to rows of the two-sample test."""
    effective = "sqrt(CAST(n_reference AS DOUBLE) * n_current / (n_reference + n_current))"
    series = "2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0e0 * k * k * x * x)))"
    tail = f"CASE WHEN x < 0.2e0 THEN 1.0e0 ELSE least(greatest({series}, 0.0e0), 1.0e0) END"
    argument = f"({effective} + 0.12e0 + 0.11e0 / {effective}) * statistic"
    return f"SELECT * EXCLUDE (x, p), round(p, 6) AS p_value, CASE WHEN p < 0.05e0 THEN 1 ELSE 0 END AS drifted FROM (SELECT *, {tail} AS p FROM (SELECT *, {argument} AS x FROM ({sql}) k0) k1) k2"


HALVES = "ref AS (SELECT * FROM txn WHERE step < 360), cur AS (SELECT * FROM txn WHERE step >= 360)"


def _halves(spark, sf):
    df = transactions(spark, sf).select("step", *MONEY_COLUMNS, "score")
    return df.filter("step < 360").drop("step"), df.filter("step >= 360").drop("step")


@query("j3_ks_two_sample", union([ks_sql(c, "ref", "cur") for c in MONEY_COLUMNS]), ctes=HALVES)
def _(spark, sf):
    return tests.ks_two_sample(*_halves(spark, sf), MONEY_COLUMNS).drop("p_value").withColumn("statistic", F.round("statistic", 9))


LINE_HALVES = """ref AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-17'), cur AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-06-17')"""


@query("j3_ks_lineitem", union([ks_sql(c, "ref", "cur") for c in LINE_COLUMNS]), ctes=LINE_HALVES)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    early = lines.filter("l_shipdate < TIMESTAMP_NTZ'1995-06-17 00:00:00'")
    late = lines.filter("l_shipdate >= TIMESTAMP_NTZ'1995-06-17 00:00:00'")
    return tests.ks_two_sample(early, late, LINE_COLUMNS).drop("p_value").withColumn("statistic", F.round("statistic", 9))


@query("j4_drift_report", tested_sql(union([ks_sql(c, "ref", "cur") for c in MONEY_COLUMNS + ["score"]])), ctes=HALVES)
def _(spark, sf):
    reference, current = _halves(spark, sf)
    return rounded_test(drift.DriftDetector().fit(reference).detect(current))


@query("j4_stored_reference", tested_sql(union([ks_sql(c, "ref", "cur") for c in MONEY_COLUMNS + ["score"]])), ctes=HALVES)
def _(spark, sf):
    """As ``j4_drift_report``, by the distribution that was stored and loaded again."""
    reference, current = _halves(spark, sf)
    path = scratch_path(spark, "reference")
    drift.DriftDetector().fit(reference).save(path)
    return rounded_test(drift.DriftDetector.load(spark, path).detect(current))


def rounded_test(report):
    return report.withColumns({"statistic": F.round("statistic", 9), "p_value": F.round("p_value", 6)})


@query(
    "j4_drift_summary",
    f"""SELECT count(*) AS features_tested, CAST(sum(drifted) AS BIGINT) AS features_drifted, max(drifted) AS drift_detected,
        coalesce(string_agg(CASE WHEN drifted = 1 THEN feature END, ',' ORDER BY feature), '') AS drifted_features
        FROM ({tested_sql(union([ks_sql(c, "ref", "cur") for c in MONEY_COLUMNS + ["score"]]))}) t""",
    ctes=HALVES,
)
def _(spark, sf):
    return drift.drift_summary(drift.drift_report(*_halves(spark, sf)))


@query(
    "c5_shared_columns",
    union([f"SELECT '{c}' AS feature, (SELECT count(*) FROM ref) AS n_reference, (SELECT count(*) FROM cur) AS n_current" for c in ("amount", "score")]),
    ctes=HALVES,
)
def _(spark, sf):
    reference, current = _halves(spark, sf)
    return drift.drift_report(reference, current.select("amount", "score")).select("feature", "n_reference", "n_current")


def anova_sql(c: str, table: str, label: str) -> str:
    return f"""SELECT '{c}' AS feature, round((sum(n * (m - gm) * (m - gm)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) AS f_score
      FROM (SELECT {label}, CAST(count({c}) AS DOUBLE) AS n, avg({c}) AS m, var_pop({c}) AS v FROM {table} GROUP BY 1) k, (SELECT avg({c}) AS gm FROM {table}) g"""


@query("j5_anova_f", union([anova_sql(c, "txn", "isFraud") for c in NUMERIC_COLUMNS]))
def _(spark, sf):
    return round_doubles(tests.anova_f(transactions(spark, sf), NUMERIC_COLUMNS))


@query("j5_anova_f_lineitem", union([anova_sql(c, "lineitem", "l_returnflag") for c in LINE_COLUMNS]))
def _(spark, sf):
    return round_doubles(tests.anova_f(read_table(spark, sf, "lineitem"), LINE_COLUMNS, "l_returnflag"))
