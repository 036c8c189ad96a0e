"""The registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweft.llm import binary, decontaminate, embeddings, licenses, lines, lm, minhash, negatives, oracles, packing, substrings, toxicity, trie, urls
from riskweft.llm.common import table


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# The rules of the query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules judge what they fit; their verdicts are the labelled urls from which the others are judged."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = urls.train(urls.ruled(urls.parsed(pages), URL_RULES))
    return urls.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "block_probability")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.dedup_substrings(table(spark, sf_dir, "documents")))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.scan(documents, table(spark, sf_dir, "benchmark")).drop("text"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), default_tokenizer())


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.mark(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "kept")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.digest(lines.dedup_lines(documents))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.round_trip(table(spark, sf_dir, "documents"), default_tokenizer())


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    heads = F.crc32(conv.cast("string").cast("binary")) % 9
    return trie.rebuilt(table(spark, sf_dir, "conversations"), conv - conv % 5, heads, 8)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_embedding_dedup,
        op3_substring_dedup,
        op4_lm_score,
        op5_toxicity,
        op6_decontaminate,
        op7_packing,
        op8_minhash,
        op9_license_scan,
        op10_line_dedup,
        op11_token_files,
        op12_hard_negatives,
        op13_prefix_trie,
    )
}

#: The others hold a trained model, a tokenizer or similarities of all pairs; tests compare them with plain versions.
ORACLES: dict[str, str] = {
    "op2_embedding_dedup": oracles.OP2,
    "op3_substring_dedup": oracles.OP3,
    "op6_decontaminate": oracles.OP6,
    "op10_line_dedup": oracles.OP10,
    "op12_hard_negatives": oracles.OP12,
    "op13_prefix_trie": oracles.OP13,
}
