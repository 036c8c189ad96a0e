from pyspark.sql import functions as F

from riskweft.operators import resample


def test_neighbour_search_reads_plain_columns(spark, monkeypatch):
    """A condition on many derived columns at once makes the planner's conditions double with every column."""
    names = [f"f{i}" for i in range(30)]
    shares = [((F.col("id") % (i + 3)) / (i + 1.0) - i).alias(c) for i, c in enumerate(names)]
    df = spark.range(60).select(F.col("id").alias("event_id"), (F.col("id") % 5 == 0).cast("int").alias("isFraud"), *shares)
    seen, search = [], resample.knn_join

    def join(left, right, *args, **kw):
        seen.extend(path for side in (left, right) for path in side.inputFiles())
        assert seen and all("/minority-" in path for path in seen)
        return search(left, right, *args, **kw)

    monkeypatch.setattr(resample, "knn_join", join)
    balanced = resample.rebalance(df, names)
    assert {r["isFraud"]: r["count"] for r in balanced.groupBy("isFraud").count().collect()} == {0: 48, 1: 48}
    assert seen and balanced.agg(F.min("weight"), F.max("weight")).first() == (1.0, 1.0)
