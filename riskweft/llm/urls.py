"""URL filters: rules by host and path, and logistic regression on hashed character n-grams for all other urls.

Everything on the way of a url is a built-in expression or a JVM model, so judging is one map without a shuffle or Python.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``, ``#`` or the
end. A rule (verdict and ``host/path``) fits its host and all subdomains if the url's path starts with the rule's; of those that
fit, the longest wins, and of equally long ones the first in order. Rules are a list in the query, at most ``MAX_RULES``.

The regression is trained from a small table of labelled urls: at most ``max_labelled`` rows, by the smallest hash. N-grams are
taken from host and path apart, with marks at their ends. A url without rule is blocked from a probability of 0.5 on.

Nulls and ties: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the regression;
repeated rows are judged alike; with no labelled url, or labels of one kind only, urls without rule are allowed and have the
probability null; an empty table gives no rows; very long urls take time in proportion to their length. Other columns are kept by
``judge``, whatever their names; host, path, rule, block_probability and verdict come last and replace columns of the same name.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import written

MAX_RULES = 1_000
MAX_LABELLED = 20_000
FEATURES = 1 << 14
SIZES = (3, 4)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str]
ADDED = ("host", "path", "rule", "block_probability", "verdict")


def _rest(url: Column) -> Column:
    """What follows the first ``://``, or an empty text."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def parsed(urls: DataFrame, column: str = "url") -> DataFrame:
    return urls.drop(*ADDED).withColumn("host", host_of(F.col(column))).withColumn("path", path_of(F.col(column)))


def _chosen(rules: list[Rule], value: int) -> Column:
    """A rule's verdict (0) or text (1) for host and path."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit one expression")
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        host, slash, path = rule[1].partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        out = F.when(fits, F.lit(rule[value])) if out is None else out.when(fits, F.lit(rule[value]))
    return F.lit(None).cast("string") if out is None else out


def ruled(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    return urls.withColumn("rule", _chosen(rules, 1)).withColumn("verdict", _chosen(rules, 0))


def _grams(text: Column, mark: str) -> Column:
    """N-grams of a text between end marks; each letter looks at those behind it, so the work is linear in the length."""
    letters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def of(n: int) -> Column:
        whole = F.transform(letters, lambda c, i: F.concat(F.lit(mark), c, *[F.get(letters, i + k) for k in range(1, n)]))
        return F.filter(whole, lambda g: g.isNotNull())

    return F.concat(*[of(n) for n in SIZES])


def train(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> PipelineModel | None:
    """Fit on url and verdict (allow or block); None unless both verdicts occur."""
    rows = labelled.filter(F.col("verdict").isin("allow", "block")).select("url", F.when(F.col("verdict") == "block", 1.0).otherwise(0.0).alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(max_labelled)
    rows = written(featured(parsed(rows)).select("grams", "label"), "labelled")
    if len(rows.select("label").distinct().take(2)) < 2:
        return None
    return Pipeline(
        stages=[
            HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True),
            LogisticRegression(featuresCol="features", labelCol="label", regParam=1e-3, maxIter=50),
        ]
    ).fit(rows)


def featured(urls: DataFrame) -> DataFrame:
    return urls.withColumn("grams", F.concat(_grams(F.col("host"), "h"), _grams(F.col("path"), "p")))


def judge(urls: DataFrame, rules: list[Rule], model: PipelineModel | None, column: str = "url") -> DataFrame:
    """The urls with host, path, rule (or null), block_probability and verdict."""
    columns = [c for c in urls.columns if c not in ADDED]
    found = ruled(parsed(urls, column), rules).withColumnRenamed("verdict", "ruled")
    if model is None:
        found = found.withColumn("block_probability", F.lit(None).cast("double"))
    else:
        # The model sees host and path alone, so that no name of the caller's meets one of its own.
        row = F.struct(*[F.col(f"`{c}`") for c in [*columns, "rule", "ruled"]]).alias("row")
        scored = model.transform(featured(found.select(row, "host", "path")))
        found = scored.select("row.*", "host", "path", vector_to_array("probability")[1].alias("block_probability"))
    own = F.when(F.col("block_probability") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return found.withColumn("verdict", F.coalesce("ruled", own)).select(*[F.col(f"`{c}`") for c in columns], *ADDED)
