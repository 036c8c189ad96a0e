"""LM scoring with a log-bilinear model trained by noise-contrastive estimation.

Words are lower-cased (A-Z) runs between ASCII white space; each text ends with one end token. Counts of all training words are
made in Spark and kept as a table of 64-bit word codes; they are never collected. The ``VOCABULARY`` most frequent words are
outputs of the neural model; every other word belongs to one of ``SHAPES`` classes of spelling (last letters and punctuation).

Model: each output has a vector for its place in the context and one as a target. The prediction is the sum of the context
vectors, each scaled dimension by dimension by its position's weights; a target's score is its product with the prediction plus
a bias. The softmax over all outputs, times the smoothed frequency of the word in its class, is the word's probability, so the
probabilities of all words add up to 1.

Training: numpy, noise-contrastive estimation with noise from the outputs' frequencies, shared by a batch. A bounded sample of
``WARM_DOCUMENTS`` documents (smallest hash of the id) is trained on the driver as a common start; then every partition of all
training documents goes on from it on its own share, and the parameters are averaged in Spark by the number of tokens.

Scoring: the log-normaliser of every context is computed once, by matrix products of blocks of contexts, in Spark. A document's
words are scored in a map; the counts of words beyond the ``COUNTED`` most frequent ones are joined to the (document, word) rows that need
them. What is sent to tasks is bounded by these constants.

Nulls and ties: a null text is empty and has the end token alone; documents without id are scored, not learned from and not held
out; repeated documents are scored alike, one row for each; without training documents the model is uniform over the classes; an
empty table gives no rows. Only the id and the text are read, so other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import CACHE_WORDS, slices, written

VOCABULARY, SUFFIXES, ENDINGS = 832, 64, 3
SHAPES = SUFFIXES * ENDINGS
OUTPUTS = VOCABULARY + SHAPES
COUNTED = 200_000
DIMENSIONS, CONTEXT = 16, 2
WARM_DOCUMENTS, WARM_EPOCHS = 1_500, 4
BATCH, NOISE, RATE = 4096, 100, 0.05
FOLDS = 10
END = b"\n"
END_CODE = xxhash.xxh64_intdigest(END)
_SIGN = 1 << 63


def tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


def shape(word: bytes) -> int:
    """Class of a word by its last letters and what punctuation follows them."""
    core = word.rstrip(b".,;:!?")
    ending = 0 if len(core) == len(word) else 1 if word[len(core)] == 0x2E else 2
    return ending * SUFFIXES + xxhash.xxh32_intdigest(core[-3:]) % SUFFIXES


def signed(code: int) -> int:
    return code - 2 * _SIGN if code >= _SIGN else code


class Words(dict):
    """Numbers of words in a task, in order of appearance, with their codes and shapes."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.shapes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.codes)
        self.codes.append(xxhash.xxh64_intdigest(word))
        self.shapes.append(shape(word))
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, counts = Words(), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        codes = np.array(words.codes, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(words.shapes, pa.int32()), pa.array(counts)], ["code", "shape", "n"])

    for batch in batches:
        for _, run_of in slices(batch.column("text")):
            found = np.concatenate([words.numbers(tokens(t)) for t in run_of])
            new = np.bincount(found, minlength=len(words.codes))
            new[: len(counts)] += counts
            counts = new
            if len(words.codes) > CACHE_WORDS:
                yield out()
                words, counts = Words(), np.zeros(0, np.int64)
    if len(words.codes):
        yield out()


@dataclass
class Vocabulary:
    """Counted words by code, and the totals that smoothed frequencies need."""

    codes: np.ndarray  # of the most frequent words, sorted
    counts: np.ndarray
    outputs: dict[int, int]  # code to output
    train_tokens: int
    distinct: int
    class_tokens: np.ndarray  # of each output: training tokens
    class_words: np.ndarray  # of each shape class: distinct words that are no outputs

    @staticmethod
    def of(counts: DataFrame) -> Vocabulary:
        shapes = {r["shape"]: (r["n"], r["v"]) for r in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
        # Words by steps of their frequency, a few hundred at most; the highest steps that hold COUNTED words or fewer are read.
        step = F.floor(F.log2("n") * 16)
        sizes = {r["step"]: r["v"] for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("v")).collect()}
        held, lowest = 0, math.inf
        for s in sorted(sizes, reverse=True):
            held += sizes[s]
            if held > COUNTED:
                break
            lowest = s
        some = (F.col("code") == signed(END_CODE)) | (step >= F.lit(float(lowest)))
        top = counts.filter(some).select("code", "shape", "n").toArrow().to_pylist()
        top.sort(key=lambda r: (r["code"] != signed(END_CODE), -r["n"], r["code"]))
        tokens_of, words_of = np.zeros(OUTPUTS), np.zeros(OUTPUTS)
        for s, (n, v) in shapes.items():
            tokens_of[VOCABULARY + s], words_of[VOCABULARY + s] = n, v
        outputs = {}
        for k, row in enumerate(top[:VOCABULARY]):
            outputs[row["code"] % (2 * _SIGN)] = k
            tokens_of[k], words_of[k] = row["n"], 1
            tokens_of[VOCABULARY + row["shape"]] -= row["n"]
            words_of[VOCABULARY + row["shape"]] -= 1
        codes = np.array([r["code"] % (2 * _SIGN) for r in top], np.uint64)
        order = np.argsort(codes)
        number = np.array([r["n"] for r in top], np.int64)
        n, v = (int(sum(x[i] for x in shapes.values())) for i in (0, 1))
        return Vocabulary(codes[order], number[order], outputs, n, v, tokens_of, words_of)

    def output(self, words: Words, since: int) -> np.ndarray:
        """Outputs of the words from number ``since`` on."""
        get = self.outputs.get
        return np.array([get(c, VOCABULARY + s) for c, s in zip(words.codes[since:], words.shapes[since:])], np.int32)

    def count(self, words: Words, since: int) -> np.ndarray:
        """Counts of the words from number ``since`` on, -1 for those that are not among the most frequent."""
        codes = np.array(words.codes[since:], np.uint64)
        if not len(self.codes):
            return np.full(len(codes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.counts[at], -1)


class Encoder:
    """Outputs and counts of the words of texts, in a task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._anew()

    def _anew(self) -> None:
        self.words, self.output, self.count = Words(), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of the texts one after the other, and where each text begins (and the last ends)."""
        if len(self.words.codes) > CACHE_WORDS:
            self._anew()
        own = [self.words.numbers(tokens(t)) for t in texts]
        since = len(self.output)
        self.output = np.concatenate([self.output, self.vocabulary.output(self.words, since)])
        self.count = np.concatenate([self.count, self.vocabulary.count(self.words, since)])
        return np.concatenate(own), np.concatenate(([0], np.cumsum([len(x) for x in own])))


def contexts(outputs: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The outputs one and two places before; texts end with ``end``, which also stands for what is before a text."""
    one = np.concatenate(([end], outputs[:-1]))
    two = np.concatenate(([end], one[:-1]))
    return one, np.where(one == end, end, two)


class Bilinear:
    """Parameters of the log-bilinear model, and its training by noise-contrastive estimation."""

    def __init__(self, frequencies: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        smooth = frequencies + 0.5
        self.noise = smooth / smooth.sum()
        self.context = rng.normal(0, 0.1, (OUTPUTS, DIMENSIONS)).astype(np.float32)
        self.target = rng.normal(0, 0.1, (OUTPUTS, DIMENSIONS)).astype(np.float32)
        self.position = np.full((CONTEXT, DIMENSIONS), 1.0, np.float32)
        self.bias = np.log(self.noise).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.context.ravel(), self.target.ravel(), self.position.ravel(), self.bias])

    def restore(self, flat: np.ndarray) -> Bilinear:
        at = 0
        for name in ("context", "target", "position", "bias"):
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def predict(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.context[one] * self.position[0] + self.context[two] * self.position[1]

    def trainer(self, rate: float = RATE):
        """A function that takes (one, two, target) events with their numbers and makes a pass over them."""
        memory = {n: np.full(getattr(self, n).shape, 1e-8, np.float32) for n in ("context", "target", "position", "bias")}
        rng, lines = np.random.default_rng(11), np.arange(DIMENSIONS)
        log_noise = np.log(NOISE * self.noise).astype(np.float32)

        def scatter(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
            out = np.zeros(OUTPUTS * DIMENSIONS, np.float32)
            np.add.at(out, (rows[:, None] * DIMENSIONS + lines).ravel(), values.ravel())
            return out.reshape(OUTPUTS, DIMENSIONS)

        def step(name: str, grad: np.ndarray) -> None:
            memory[name] += grad * grad
            setattr(self, name, getattr(self, name) + rate * grad / np.sqrt(memory[name]))

        def run(one: np.ndarray, two: np.ndarray, target: np.ndarray, number: np.ndarray) -> None:
            order = rng.permutation(len(target))
            for a in range(0, len(order), BATCH):
                at = order[a : a + BATCH]
                c1, c2, t = one[at], two[at], target[at]
                weight = (number[at] / number[at].sum()).astype(np.float32)
                q = self.predict(c1, c2)
                noise = rng.choice(OUTPUTS, NOISE, p=self.noise)
                real = np.einsum("ij,ij->i", q, self.target[t]) + self.bias[t] - log_noise[t]
                fake = q @ self.target[noise].T + (self.bias[noise] - log_noise[noise])
                # Gradients of the log-likelihood of telling data from noise, by the scores.
                gr = weight / (1 + np.exp(np.clip(real, -30, 30)))
                gf = -weight[:, None] / (1 + np.exp(np.clip(-fake, -30, 30)))
                gq = gr[:, None] * self.target[t] + gf @ self.target[noise]
                gt = scatter(t, gr[:, None] * q) + scatter(noise, gf.T @ q)
                gb = np.bincount(t, gr, OUTPUTS) + np.bincount(noise, gf.sum(axis=0), OUTPUTS)
                gp = np.stack([(gq * self.context[c1]).sum(axis=0), (gq * self.context[c2]).sum(axis=0)])
                gc = scatter(c1, gq * self.position[0]) + scatter(c2, gq * self.position[1])
                for name, grad in (("context", gc), ("target", gt), ("position", gp), ("bias", gb.astype(np.float32))):
                    step(name, grad)

        return run

    def log_normaliser(self, ones: np.ndarray) -> np.ndarray:
        """ln of the sum of exponentiated scores for every context (one, any)."""
        out = np.empty((len(ones), OUTPUTS), np.float32)
        rest = self.context * self.position[1]
        for k, one in enumerate(ones):
            scores = (rest + self.context[one] * self.position[0]) @ self.target.T + self.bias
            top = scores.max(axis=1, keepdims=True)
            out[k] = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1))
        return out


def events(outputs: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (one, two, target) of a stretch of text and how often each occurs."""
    one, two = contexts(outputs, end)
    codes, number = np.unique((one.astype(np.int64) * OUTPUTS + two) * OUTPUTS + outputs, return_counts=True)
    return codes // (OUTPUTS * OUTPUTS), codes // OUTPUTS % OUTPUTS, codes % OUTPUTS, number


def _encode(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for _, run_of in slices(batch.column("text")):
                numbers, _ = encoder(run_of)
                yield pa.RecordBatch.from_arrays([pa.array([encoder.output[numbers].astype(np.int32).tobytes()], pa.binary())], ["outputs"])

    return run


def _train(vocabulary, start):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, total, held, size = Encoder(vocabulary.value), vocabulary.value.outputs.get(END_CODE, 0), 0, [], 0
        model = Bilinear(vocabulary.value.class_tokens).restore(start.value)
        trainer = model.trainer(RATE / 2)
        for batch in batches:
            for _, run_of in slices(batch.column("text")):
                numbers, _ = encoder(run_of)
                held.append(encoder.output[numbers])
                size += len(numbers)
                if size >= 2_000_000:
                    trainer(*events(np.concatenate(held), end))
                    total, held, size = total + size, [], 0
        if size:
            trainer(*events(np.concatenate(held), end))
        if total + size:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(total + size)]), pa.array([model.flat().astype(np.float64)], pa.list_(pa.float64()))], ["weight", "flat"]
            )

    return run


def _score(vocabulary, model, normaliser):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Vocabulary = vocabulary.value
        net, log_z = Bilinear(known.class_tokens).restore(model.value), normaliser.value
        encoder, end, ln10 = Encoder(known), known.outputs.get(END_CODE, 0), math.log(10)
        base_total = math.log10(known.train_tokens + 0.1 * (known.distinct + 1))
        class_total = np.log10(known.class_tokens + 0.1 * (known.class_words + 1))
        class_total[:VOCABULARY] = 0
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for first, run_of in slices(batch.column("text")):
                numbers, starts = encoder(run_of)
                target, count = encoder.output[numbers], encoder.count[numbers]
                one, two = contexts(target, end)
                net_score = np.einsum("ij,ij->i", net.predict(one, two), net.target[target]) + net.bias[target] - log_z[one, two]
                # log10 of count + 0.1 where the count is at hand; the other words follow by their code.
                own = np.log10(np.maximum(count, 0) + 0.1)
                own[count < 0] = 0
                in_class = target >= VOCABULARY
                score = net_score.astype(np.float64) / ln10 + np.where(in_class, own, 0) - class_total[target]
                sums = [np.add.reduceat(x, starts[:-1]) for x in (own - base_total, score, (count > 0).astype(np.int64))]
                columns[0] += range(first, first + len(run_of))
                columns[1] += np.diff(starts).tolist()
                for c, x in zip(columns[2:5], sums):
                    c += x.tolist()
                codes = np.array(encoder.words.codes, np.uint64).view(np.int64)
                for k in range(len(run_of)):
                    part = numbers[starts[k] : starts[k + 1]]
                    rest, n = np.unique(part[count[starts[k] : starts[k + 1]] < 0], return_counts=True)
                    columns[5].append(codes[rest])
                    columns[6].append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(pa.array(columns[0], pa.int64())) for c in ("doc_id", "row")],
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.float64()),
                    pa.array(columns[4], pa.int64()),
                    pa.array(columns[5], pa.list_(pa.int64())),
                    pa.array(columns[6], pa.list_(pa.int64())),
                ],
                ["doc_id", "row", "n_tokens", "base", "score", "n_known", "codes", "numbers"],
            )

    return run


def remainder(folds: int = FOLDS):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def score(documents: DataFrame, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    spark = documents.sparkSession
    share = spark.sparkContext.broadcast
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    training = texts.filter(remainder(folds) != 0)
    counts = training.select("text").mapInArrow(_count, "code bigint, shape int, n bigint")
    counts = written(counts.groupBy("code").agg(F.min("shape").alias("shape"), F.sum("n").alias("n")), "counts")
    known = Vocabulary.of(counts)
    vocabulary, end = share(known), known.outputs.get(END_CODE, 0)

    model = Bilinear(known.class_tokens)
    warm = training.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(WARM_DOCUMENTS).distinct()
    rows = training.join(F.broadcast(warm), "doc_id").select("text").mapInArrow(_encode(vocabulary), "outputs binary").collect()
    if rows:
        trainer, found = model.trainer(), events(np.concatenate([np.frombuffer(x, np.int32) for x in sorted(bytes(r[0]) for r in rows)]), end)
        for _ in range(WARM_EPOCHS):
            trainer(*found)
    shares = training.select("text").mapInArrow(_train(vocabulary, share(model.flat())), "weight double, flat array<double>")
    mean = shares.select("weight", F.posexplode("flat").alias("at", "value")).groupBy("at")
    mean = mean.agg((F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("value")).collect()
    if mean:
        model.restore(np.array([r["value"] for r in sorted(mean, key=lambda r: r["at"])]))
    flat = share(model.flat())

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Bilinear(vocabulary.value.class_tokens).restore(flat.value)
        for batch in batches:
            ones = batch.column("id").to_numpy()
            rows = [r.tobytes() for r in net.log_normaliser(ones)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary())], ["id", "row"])

    rows = spark.range(0, OUTPUTS, 1, 16).mapInArrow(normalise, "id bigint, row binary").collect()
    log_z = np.stack([np.frombuffer(r["row"], np.float32) for r in sorted(rows, key=lambda r: r["id"])])

    # Equal rows have one key and the same scores, so sums over a key are shared by its rows.
    keyed = texts.withColumn("row", F.xxhash64("doc_id", "text"))
    fields = f"doc_id {kind}, row bigint, n_tokens bigint, base double, score double, n_known bigint, codes array<bigint>, numbers array<bigint>"
    scored = written(keyed.mapInArrow(_score(vocabulary, flat, share(log_z)), fields), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("codes", "numbers")).alias("w")).select("row", F.col("w.codes").alias("code"), F.col("w.numbers").alias("k"))
    rare = rare.join(counts.select("code", "n"), "code", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("more_known")
    )
    copies = scored.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    whole = scored.drop("codes", "numbers").join(rare.join(copies, "row"), "row", "left")
    more = F.coalesce(F.col("more") / F.col("copies"), F.lit(0.0))
    return whole.select(
        "doc_id",
        F.coalesce(remainder(folds) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("more_known") / F.col("copies"), F.lit(0)).cast("long")).alias("n_known"),
        F.lit(known.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
