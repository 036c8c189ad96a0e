"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear in the presence of hashed word beginnings and whole words. It is trained in numpy on the driver from a
bounded sample: at most ``MAX_POSITIVE`` documents that are confirmed toxic and at most ``MAX_UNLABELLED`` documents of unknown
kind, both by the smallest hash of the id. The risk of calling unlabelled text harmless is corrected by the class prior and kept
from going below zero, so the negatives are never named; the prior is the share of toxic documents among the labelled ones.

Features are chosen by Spark from the sample: the grams that are most over-represented in toxic documents, and that at least
``LEAST_DOCUMENTS`` and a share of ``LEAST_SHARE`` of them have (rarer ones are what copies of one document share). What reaches the
driver is the chosen grams and, for each document of the sample, which of them it has. Scoring is one map over the documents without a
shuffle, with the chosen grams' weights sent along.

Only the text enters a score. Nulls and ties: a null text is empty; an empty text has the score of the intercept; labels that are
null are ignored, those of unknown documents count in the prior alone, and a document is toxic if any of its labels says so; documents without id are scored
but not learned from; repeated documents are scored alike; without any confirmed toxic document each score is the prior; an empty
table gives no rows. Other columns are kept by ``score``, whatever their names; score and predicted come last and replace columns
of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import alnum_words, packed, packed_schema, slices, tidy, written

MAX_POSITIVE, MAX_UNLABELLED = 3_000, 6_000
MAX_FEATURES, LEAST_DOCUMENTS, LEAST_SHARE = 2_048, 6, 0.01
#: Lengths of word beginnings, in characters; whole words count as well.
BEGINNINGS = (4, 5, 6)
FOLDS = 5
STEPS, RATE, DECAY = 300, 0.05, 1e-3
_CACHE_WORDS = 250_000


def grams(word: bytes) -> list[int]:
    """Hashes of a word and its beginnings."""
    text = word.decode("utf-8", "replace")
    parts = {word + b" ", *(text[:n].encode() for n in BEGINNINGS if len(text) >= n)}
    return [xxhash.xxh64_intdigest(p) for p in parts]


class _Grams(dict):
    def __missing__(self, word: bytes) -> np.ndarray:
        if len(self) >= _CACHE_WORDS // 4:
            self.clear()
        self[word] = found = np.array(grams(word), np.uint64)
        return found


@dataclass
class Model:
    """Weights of chosen grams; the score is the logistic function of their sum and the intercept."""

    weights: dict[int, float] = field(default_factory=dict)
    intercept: float = 0.0
    prior: float = 0.0

    def scorer(self):
        chosen, known = self.weights, {}

        def score(text: bytes | None) -> float:
            found: set[int] = set()
            for word in set(alnum_words(text)):
                own = known.get(word)
                if own is None:
                    if len(known) >= _CACHE_WORDS:
                        known.clear()
                    # Nearly all words have none of the chosen grams and share one empty tuple.
                    known[word] = own = tuple(g for g in grams(word) if g in chosen)
                if own:
                    found.update(own)
            z = self.intercept + math.fsum([chosen[g] for g in found])
            return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

        return score


def risk(z: np.ndarray, positive: int, prior: float) -> tuple[float, np.ndarray]:
    """The corrected risk of the scores of positives (the first ones) and unlabelled rows, and its gradient by the scores.

    R = prior * E_p[l(z, 1)] + max(0, E_u[l(z, 0)] - prior * E_p[l(z, 0)]) with the logistic loss l. Where the second term is below
    zero, the gradient steps back from it.
    """
    zp, zu = z[:positive], z[positive:]
    sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
    miss, alarm, loud = -(1 - sp) / len(zp), sp / len(zp), su / len(zu)
    negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    value = prior * np.logaddexp(0, -zp).mean() + max(0.0, negative)
    if negative >= 0:
        return value, np.concatenate((prior * miss - prior * alarm, loud))
    return value, np.concatenate((prior * alarm, -loud))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], names: list[int], prior: float) -> Model:
    """Train from the numbers of the chosen grams that each document has. Steps are Adam's."""
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    start = math.log(prior / (1 - prior))
    if not positive:
        return Model(intercept=start, prior=prior)
    # Without unlabelled documents there is one that has no chosen gram.
    rows = positive + (unlabelled or [np.zeros(0, np.int64)])
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate(rows)
    w, b = np.zeros(len(names)), start
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for k in range(1, STEPS + 1):
        _, by_score = risk(np.bincount(of, w[flat], len(rows)) + b, len(positive), prior)
        grad = np.append(np.bincount(flat, by_score[of], len(names)) + DECAY * w / len(rows), by_score.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model({g % 2**64: float(x) for g, x in zip(names, w)}, float(b), prior)


@tidy
def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Grams()
    for batch in batches:
        sets = []
        for text in batch.column("text"):
            words = set(alnum_words(text.as_py()))
            sets.append(np.unique(np.concatenate([known[w] for w in words])).tobytes() if words else b"")
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(sets, pa.binary())], ["doc_id", "toxic", "grams"])


@tidy
def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and unlabelled documents of a batch each gram is."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy() == 1
        sets = [np.frombuffer(g.as_buffer(), np.uint64) for g in batch.column("grams")]
        if not sets:
            continue
        of = np.repeat(toxic, [len(s) for s in sets])
        names, at = np.unique(np.concatenate(sets), return_inverse=True)
        hit = np.bincount(at, of, len(names)).astype(np.int64)
        rest = np.bincount(at, ~of, len(names)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(hit), pa.array(rest)], ["gram", "hit", "rest"])


def _chosen_of(chosen: np.ndarray):
    """Numbers of the chosen grams (in the order of the array) that each document has."""
    order = np.argsort(chosen)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [order[np.isin(chosen[order], np.frombuffer(g.as_buffer(), np.uint64))] for g in batch.column("grams")]
            numbers = pa.array([np.sort(x).astype("<u2").tobytes() for x in own], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), numbers], ["doc_id", "toxic", "numbers"])

    return run


def chosen_grams(sample: DataFrame, positives: int, unlabelled: int, prior: float) -> list[int]:
    """The most over-represented grams, on the side of caution: by as many standard deviations as the positives exceed the expected."""
    counts = sample.select("toxic", "grams").mapInArrow(_gram_counts, "gram bigint, hit bigint, rest bigint")
    counts = counts.groupBy("gram").agg(F.sum("hit").alias("hit"), F.sum("rest").alias("rest"))
    expected = positives * (F.col("rest") + 0.5) / (unlabelled + 1)
    usable = counts.filter(F.col("hit") >= max(LEAST_DOCUMENTS, LEAST_SHARE * positives)).withColumn("excess", (F.col("hit") - expected) / F.sqrt(expected))
    usable = usable.filter((F.col("excess") > 4) & (F.col("hit") > 4 * prior * expected))
    return [r["gram"] for r in usable.orderBy(F.desc("excess"), "gram").limit(MAX_FEATURES).select("gram").collect()]


def held_out(folds: int = FOLDS):
    """Whether a document is kept from learning: the remainder of the checksum of its id is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, folds: int = FOLDS) -> Model:
    """Learn from confirmed toxic documents and unlabelled text outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").dropna().filter(~held_out(folds))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    shares = known.agg(F.count(F.lit(1)), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).first()
    prior = (shares[1] or 0) / shares[0] if shares[0] else 0.0
    order = F.xxhash64("doc_id"), F.col("doc_id")
    positive = known.filter("toxic = 1").orderBy(*order).limit(max_positive).select("doc_id", F.lit(1).alias("toxic"))
    open_ids = documents.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().filter(~held_out(folds))
    open_ids = open_ids.orderBy(*order).limit(max_unlabelled).select("doc_id", F.lit(0).alias("toxic"))
    # At most max_positive + max_unlabelled ids, so they go to the documents.
    wanted = F.broadcast(positive.union(open_ids))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    sample = texts.join(wanted, "doc_id").select("doc_id", "toxic", "text").mapInArrow(_sample, "doc_id bigint, toxic int, grams binary")
    sample = written(sample, "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = chosen_grams(sample, sizes[1], sizes.get(0, 0), min(max(prior, 1e-4), 1 - 1e-4)) if sizes.get(1) else []
    chosen = np.array(names, np.int64).view(np.uint64)
    rows = sample.mapInArrow(_chosen_of(chosen), "doc_id bigint, toxic int, numbers binary").collect()
    rows = sorted((r["toxic"], r["doc_id"], bytes(r["numbers"])) for r in rows)
    sets = {kind: [np.frombuffer(x, "<u2").astype(np.int64) for t, _, x in rows if t == kind] for kind in (0, 1)}
    return fit(sets[1], sets[0], names, prior)


def _score(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            out = [score(t) for _, run_of in slices(batch.column("text")) for t in run_of]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.float64())], ["row", "score"])

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with score (0 to 1, higher is more toxic) and predicted (1 from 0.5 on)."""
    held = documents.drop("score", "predicted")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    out = packed(held, F.col("text").cast("binary").alias("text")).mapInArrow(_score(shared), packed_schema(held, "score double"))
    return out.select("row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
