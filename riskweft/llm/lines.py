"""Line dedup by a log-template tree: parse depth by token count and leading tokens, templates learned in the leaves.

A line is parsed at fixed depth: first by its number of words, then by its leading words, where a word with a digit is variable
and becomes a wildcard. That leads to a leaf, which holds templates. A line joins the first template that it agrees with in at
least four of five words at their places (runs of digits within words agree with one another); the words in which the members of
a template differ are its variable fields. A line that agrees with none starts a template of its own. Lines are taken by document
id and place in the document, so a template is led by its first line and no order of arrival matters. Every line that holds a
word is judged, lines of one word too: those of a single word and of two to four have no variable fields but digits. In a line
without any letter (rows of numbers, rules of signs) nothing is variable.

A template recurs if two documents have lines of it. Its lines are dropped from all documents but the one with the smallest id.

At scale: equal lines leave a map task once for each flush. Leaves are partitions of one sorted shuffle, and a task streams
through them; in memory it has the templates of one leaf, found by the hashes of their stretches: a line may differ in m words only, so
of m + 1 stretches one is the same, and only templates that share a stretch at its place are compared. If a leaf has more templates
than fit (``LEAF_STRETCHES``), lines that agree with none of them go on to another round, which takes up where this one ended: the
result is that of one pass. A leaf with more than ``LEAF_LINES`` lines is cut by a hash of the line, and each part learns its templates alone;
the leading lines of the parts then meet by leaf and stretch, where a line that agrees with an earlier document's is dropped too.
Only there can the order of merging tell: a line that is like a template of another part, but not like its leading one, may stay.

Nulls and ties: a null text stays null and has no lines; a text without line breaks is one line; documents without id neither
cause nor suffer removals; rows that share an id don't count against one another; a document whose lines are all dropped has an
empty text; an empty table gives no rows. Other columns are kept, whatever their names; n_lines and n_removed come last and
replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import ne

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import packed_schema, spans_of, tidy, written
from riskweft.llm.firsts import Hot, flagged, flushes, hot_numbers

LEADING = 2
#: A line may differ from its template's leading line in one of so many words.
DIFFER = 5
WILDCARD = b"<*>"
#: Lines of a leaf that one task parses, and stretches of templates that it keeps at once.
LEAF_LINES = 250_000
LEAF_STRETCHES = 400_000

#: What a row of the parsing holds: places of repeats, a repeated line, a line for the next round, a leading line of a part.
_RUNS, _LATE, _NEXT, _LEADS = range(4)
_ROW = "leaf bigint, part bigint, kind int, doc_id bigint, no bigint, hash bigint, data binary"
_NAMES = ["leaf", "part", "kind", "doc_id", "no", "hash", "data"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

_RUN = re.compile(rb"[0-9]+")
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_DIGITS = bytes(range(0x30, 0x3A))


def _variable(word: bytes) -> bool:
    return len(word.translate(None, _DIGITS)) < len(word)


def parsed(text: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """The tree above its leaves: a text's lines with words, as place, leaf, hash and words with masked digits."""
    for no, line in enumerate(text.split(b"\n")):
        words = line.split()
        if not words:
            continue
        lead, whole = words[:LEADING], b" ".join(words)
        if _variable(whole) and _LETTER.search(whole):
            lead = [WILDCARD if _variable(w) else w for w in lead]
            whole = _RUN.sub(WILDCARD, whole)
        leaf = xxhash.xxh64_intdigest(b"%d " % len(words) + b" ".join(lead))
        yield no, leaf, xxhash.xxh64_intdigest(whole, leaf), whole


def _hasher():
    def run(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        both = np.array([(h, leaf) for _, leaf, h, _ in parsed(text)], np.uint64).reshape(-1, 2)
        return both[:, 0].copy(), both[:, 1].copy()

    return run


def _stretches(words: list[bytes]) -> list[bytes]:
    """Stretches of a line, one more than words may differ, so similar lines share one."""
    n = len(words)
    parts = n // DIFFER + 1
    cuts = [n * j // parts for j in range(parts + 1)]
    return [b" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:])]


class Leaf:
    """Leading lines of a leaf's templates, found by their stretches. Most leaves hold one line and need no index."""

    def __init__(self) -> None:
        self.leads: list[tuple[bytes, int]] = []
        self.exact: dict[bytes, int] = {}
        self.index: dict[tuple[int, int], list[int]] = {}
        self.indexed = self.size = 0

    def add(self, line: bytes, doc: int) -> None:
        self.exact[line] = doc
        self.leads.append((line, doc))
        self.size += (line.count(b" ") + 1) // DIFFER + 1

    def find(self, line: bytes) -> int | None:
        """The document of the first template that the line agrees with."""
        doc = self.exact.get(line)
        if doc is not None or not self.leads:
            return doc
        words = line.split(b" ")
        allowed = len(words) // DIFFER
        if not allowed:
            return None
        for at in range(self.indexed, len(self.leads)):
            for j, part in enumerate(_stretches(self.leads[at][0].split(b" "))):
                self.index.setdefault((j, xxhash.xxh64_intdigest(part)), []).append(at)
        self.indexed = len(self.leads)
        tried: set[int] = set()
        for j, part in enumerate(_stretches(words)):
            tried.update(self.index.get((j, xxhash.xxh64_intdigest(part)), ()))
        for at in sorted(tried):
            lead, doc = self.leads[at]
            own = lead.split(b" ")
            if len(own) == len(words) and sum(map(ne, own, words)) <= allowed:
                return doc
        return None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def _signed(values: list[int]) -> list[int]:
    return np.array(values, np.uint64).view(np.int64).tolist()


def _opened(hot: Hot):
    """Each flush's different lines, with their first document, and the places of those that repeat within the flush."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in flushes(batches):
            held.sort(key=lambda row: row[0])
            seen: dict[int, int] = {}
            leaves, hashes, rest, out = [], [], [], []
            for doc, text in held:
                repeat = []
                for no, leaf, h, line in parsed(text):
                    first = seen.setdefault(h, doc)
                    repeat.append(first != doc)
                    if first == doc:
                        leaves.append(leaf)
                        hashes.append(h)
                        rest.append((doc, no, line))
                if any(repeat):
                    runs = np.array(spans_of(np.array(repeat)), np.int32)
                    out.append((doc, 0, _RUNS, doc, 0, 0, runs.tobytes()))
            parts = hot.part_of(np.array(leaves, np.uint64), np.array(hashes, np.uint64)).tolist()
            for leaf, part, h, (doc, no, line) in zip(_signed(leaves), parts, _signed(hashes), rest):
                out.append((leaf, part, _NEXT, doc, no, h, line))
            yield _batch(out)

    return run


def _judged(room: int):
    """Streams through sorted leaves; a part's lines that agree with no earlier document's are handed on as leading lines."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, leaf = None, Leaf()
        for batch in batches:
            out = []
            for row in zip(*[batch.column(n).to_pylist() for n in _NAMES]):
                key, part, kind, doc, no, h, line = row
                if kind == _RUNS:
                    out.append(row)
                    continue
                if (key, part) != current:
                    current, leaf = (key, part), Leaf()
                first = leaf.find(line)
                if first is not None and first < doc:
                    out.append((0, 0, _LATE, doc, 0, h, np.int64(h).tobytes()))
                elif first is None and leaf.leads and leaf.size >= room:
                    out.append(row)
                else:
                    if first is None:
                        leaf.add(line, doc)
                    if part:
                        out.append((key, 0, _LEADS, doc, no, h, line))
            yield _batch(out)

    return run


@tidy
def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leading lines of cut leaves, once for each stretch."""
    for batch in batches:
        out = []
        for leaf, _, _, doc, no, h, line in zip(*[batch.column(n).to_pylist() for n in _NAMES]):
            seed = leaf % (1 << 64)
            keys = [xxhash.xxh64_intdigest(b"%d " % j + part, seed) for j, part in enumerate(_stretches(line.split(b" ")))]
            out += [(key, 0, _NEXT, doc, no, h, line) for key in _signed(keys)]
        yield _batch(out)


def _rounds(rows: DataFrame, room: int) -> list[DataFrame]:
    """Written tables of all rounds of parsing; there is a second one only if a leaf has more templates than fit."""
    tables = []
    while True:
        dealt = rows.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "doc_id", "no", "hash")
        tables.append(written(dealt.mapInArrow(_judged(room), _ROW), "line-templates"))
        rows = tables[-1].filter(F.col("kind") == _NEXT)
        if rows.isEmpty():
            return tables


def recurring(source: DataFrame, leaf_lines: int = LEAF_LINES, room: int = LEAF_STRETCHES) -> DataFrame:
    """doc_id and answers (hashes of lines, or places among the lines with words) of lines whose template an earlier document has."""
    source = source.dropna()
    size = source.agg(F.sum(F.length("text"))).first()[0] or 0
    # A line with a word and its line break take two bytes, so smaller tables have no leaf of that many lines.
    hot = hot_numbers(source, _hasher, leaf_lines) if size >= 2 * leaf_lines else Hot()
    tables = _rounds(source.mapInArrow(_opened(hot), _ROW), room)
    if len(hot.numbers):
        leading = [t.filter(F.col("kind") == _LEADS) for t in tables]
        for more in leading[1:]:
            leading[0] = leading[0].unionAll(more)
        tables += _rounds(leading[0].mapInArrow(_spread, _ROW), room)
    answers = tables[0]
    for more in tables[1:]:
        answers = answers.unionAll(more)
    # As ``flagged`` names them: runs of places, or hashes.
    found = answers.filter(F.col("kind").isin(_RUNS, _LATE)).select("doc_id", F.struct("kind", "data").alias("answer"))
    return found.groupBy("doc_id").agg(F.collect_list("answer").alias("answers"))


@tidy
def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, removed = [], [], []
        for text, answers in zip(batch.column("text"), batch.column("answers")):
            data = text.as_py()
            n = data.count(b"\n") + 1 if data is not None else 0
            gone: set[int] = set()
            if data is not None and answers.is_valid:
                own = [(no, h) for no, _, h, _ in parsed(data)]
                late = flagged(np.array([h for _, h in own], np.uint64), answers.as_py())
                gone = {no for (no, _), x in zip(own, late.tolist()) if x}
                if gone:
                    data = b"\n".join([line for no, line in enumerate(data.split(b"\n")) if no not in gone])
            texts.append(data)
            lines.append(n)
            removed.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.binary()), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())],
            ["row", "text", "n_lines", "n_removed"],
        )


def dedup_lines(documents: DataFrame, leaf_lines: int = LEAF_LINES, room: int = LEAF_STRETCHES) -> DataFrame:
    """The documents with dropped lines cut from the text, n_chars brought up to date, n_lines (before) and n_removed."""
    columns = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    answers = recurring(source, leaf_lines, room).select(F.col("doc_id").alias("id"), "answers")
    # The text travels beside the other columns, and those as one.
    held = documents.select(*[F.col(f"`{c}`") for c in columns if c != "text"])
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in held.columns]).alias("row"), F.col("text").cast("binary").alias("text"))
    joined = own.join(answers, F.col("row.doc_id").cast("long") == F.col("id"), "left").select("row", "text", "answers")
    out = joined.mapInArrow(_dropped, packed_schema(held, "text binary, n_lines bigint, n_removed bigint"))
    out = out.withColumn("text", F.col("text").cast("string"))
    cut = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")) if "n_chars" in columns else None
    new = {"text": F.col("text")} | ({"n_chars": cut.cast(documents.schema["n_chars"].dataType)} if "n_chars" in columns else {})
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in columns], "n_lines", "n_removed")


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
