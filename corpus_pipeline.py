"""Corpus pipeline: toxic documents go, recurring lines, near copies and benchmark passages go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the columns of
documents. ``run`` writes every stage as Parquet to the shared folder and reads it again, so a lost executor costs one stage at
most. A stage whose table is empty hands on an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweft.llm import decontaminate, lines, minhash, packing, queries, toxicity
from riskweft.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of operator 5 calls toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that an earlier document has go (operator 10), and documents of which nothing else is left."""
    out = lines.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | (F.trim(F.regexp_replace("text", r"[\x09-\x0D]", " ")) != "")
    return out.filter(left).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id (operator 8)."""
    return minhash.mark(docs).filter("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that share a window with the benchmark are cut from the texts (operator 6); their documents stay."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most 2048 (operator 7)."""
    return packing.pack(docs, queries.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-duplicates", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
