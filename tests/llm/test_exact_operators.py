"""Operators with exact results, against plain versions of their definitions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft.llm import decontaminate, firsts, packing, queries, substrings
from tests.llm import helpers as H

WORDS = [f"w{k}" for k in range(40)] + ["Ä", "Über", "the,", "a-b", "3"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def hard_rows():
    """Shared passages, copies, nulls, equal ids, rows without id, empty and very long texts."""
    rng = random.Random(3)
    shared, long = sentence(rng, 70), sentence(rng, 30_000)
    rows = [(k, sentence(rng, rng.choice([0, 3, 49, 50, 51, 120]))) for k in range(40)]
    rows += [(k, sentence(rng, 20) + "\t" + shared + "\n\n" + sentence(rng, 15)) for k in range(40, 60)]
    rows += [(k, shared) for k in range(60, 70)]
    rows += [(70, long), (71, long), (72, long[1000:]), (73, None), (74, ""), (75, " \x0b\n "), (76, "x " * 400), (77, "x " * 300)]
    rows += [(66, shared), (66, shared), (None, shared), (None, None), (-5, shared + " end")]
    return rows


def sf_rows(spark, sf, name="documents", columns=("doc_id", "text")):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*columns).collect()]


def test_substring_dedup_hard_rows(spark, hard_rows, monkeypatch):
    want = H.substring_dedup(hard_rows)
    df = H.docs_frame(spark, hard_rows).repartition(5)
    assert H.ordered(substrings.digest(substrings.dedup_substrings(df)).collect()) == H.ordered(want)
    many = substrings.dedup_substrings(df, bucket_windows=500)
    assert H.ordered(substrings.digest(many).collect()) == H.ordered(want)


def test_substring_windows_around_a_phrase_are_spread(spark, monkeypatch):
    rng, phrase, seen = random.Random(9), " ".join(f"p{k}" for k in range(30)), []
    rows = [(k, " ".join([*(f"w{rng.random()}"[:6] for _ in range(60)), phrase, *(f"w{rng.random()}"[:6] for _ in range(60))])) for k in range(400)]
    df, plain = H.docs_frame(spark, rows).repartition(4), substrings.repeats

    def sizes(source, hasher, buckets, *limit):
        opened = firsts.opened(source, hasher, buckets, *limit)
        seen.extend(r[1] for r in opened.groupBy("bucket").agg(F.sum(F.length("data") / 8)).collect())
        return plain(source, hasher, buckets, *limit)

    monkeypatch.setattr(substrings, "repeats", sizes)
    cut = substrings.dedup_substrings(df, bucket_windows=1000)
    assert sum(seen) == 400 * 101 and max(seen) < 4000
    assert H.ordered(substrings.digest(cut).collect()) == H.ordered(H.substring_dedup(rows))
    seen.clear()
    firsts_only = lambda source, hasher, buckets, limit: sizes(source, hasher, buckets)
    monkeypatch.setattr(substrings, "repeats", firsts_only)
    substrings.dedup_substrings(df, bucket_windows=1000)
    assert max(seen) > 4000  # what one anchor has without parts


def test_substring_dedup_table_and_empty(spark, sf):
    got = queries.QUERIES["op3_substring_dedup"](spark, sf)
    assert H.ordered(got.collect()) == H.ordered(H.substring_dedup(sf_rows(spark, sf)))
    empty = H.docs_frame(spark, []).withColumnRenamed("lang", "kept")
    assert substrings.dedup_substrings(empty).count() == 0


def test_substring_spans_and_text(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    df = H.docs_frame(spark, [(1, "a " + passage + " b"), (2, "c " + passage + " d")])
    rows = {r["doc_id"]: r for r in substrings.dedup_substrings(df).collect()}
    assert rows[1]["n_removed"] == 0
    assert [tuple(s) for s in rows[2]["removed_spans"]] == [(1, 61)] and rows[2]["kept"] == "c d"


def test_decontaminate_hard_rows(spark, hard_rows):
    rng = random.Random(5)
    items = [(k, sentence(rng, n)) for k, n in enumerate([0, 1, 4, 9, 10, 11, 40])] + [(10, "W7 w8"), (2, hard_rows[45][1]), (None, "w1"), (11, None), (12, "!!")]
    items = [(k, t) for k, t in items if t is None or H.alnum(t) != ["w1"]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = H.docs_frame(spark, hard_rows).repartition(4)
    want = H.ordered(H.decontaminate(hard_rows, items))
    assert H.ordered(decontaminate.digest(decontaminate.scan(df, bench)).collect()) == want
    parts = decontaminate.scan(df, bench, part_bytes=200)
    assert H.ordered(decontaminate.digest(parts).collect()) == want


def test_decontaminate_table_and_empty(spark, sf):
    got = queries.QUERIES["op6_decontaminate"](spark, sf).collect()
    want = H.decontaminate(sf_rows(spark, sf), sf_rows(spark, sf, "benchmark", ("item_id", "text")))
    assert H.ordered(got) == H.ordered(want) and any(r[5] for r in want)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    df = H.docs_frame(spark, [(1, "a b"), (2, None)])
    assert [tuple(r)[:3] for r in decontaminate.digest(decontaminate.scan(df, bench)).orderBy("doc_id").collect()] == [(1, 2, 0), (2, 0, 0)]
    assert decontaminate.scan(H.docs_frame(spark, []), bench).count() == 0


def test_remove_spans_leaves_no_window_and_clean_text(spark):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    half = item.split()
    rows = [
        (1, f"Before, {item.upper()}! after"),
        (2, "clean text stays  as it\nis"),
        # the inner copy keeps an outer one apart
        (3, " ".join(half[:5]) + " " + item + " " + " ".join(half[5:]) + " tail"),
        (4, None),
    ]
    df = H.docs_frame(spark, rows).withColumnRenamed("source", "hit_spans")
    out = {r["doc_id"]: r for r in decontaminate.remove_spans(df, bench).collect()}
    assert out[1]["text"] == "Before, ! after" and out[1]["n_chars"] == len("Before, ! after")
    assert out[2]["text"] == rows[1][1] and out[4]["text"] is None
    assert H.alnum(out[3]["text"]) == ["tail"] and out[3]["hit_spans"] == "src0"


def check_packing(rows, documents, encode):
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc, text in documents:
        ids = np.array(encode(text or "") + [1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences) * 2048 / sum(r["length"] for r in rows)


def test_packing(spark, sf):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(queries.default_tokenizer())

    def encode(text):
        return encoder.encode(text, add_special_tokens=False).ids

    documents = sf_rows(spark, sf)
    assert check_packing(queries.QUERIES["op7_packing"](spark, sf).collect(), documents, encode) < 1.03
    odd = [(1, None), (2, ""), (3, "it's ÀÉ é x y  12 ￼'s"), (4, "word " * 9000), (5, "́ a\x1cb\x85c"), (None, "x")]
    check_packing(packing.pack(H.docs_frame(spark, odd), queries.default_tokenizer()).collect(), odd, encode)
    assert packing.pack(H.docs_frame(spark, []), queries.default_tokenizer()).count() == 0
    same = packing.pack(H.docs_frame(spark, [(7, "a b"), (7, "a b")]), queries.default_tokenizer()).collect()
    assert len(same) == 2 and {r["offset"] for r in same} == {0, same[0]["length"]}


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(1)
    sizes = list(range(1, 33))
    demand = rng.integers(1, 500, 32).tolist()
    held = np.zeros(32, int)
    used = 0
    for times, pattern in packing.plan(sizes, demand, 64):
        assert sum(sizes[i] * c for i, c in pattern) <= 64
        for i, c in pattern:
            held[i] += times * c
        used += times
    assert held.tolist() == demand
    assert used <= 1.005 * sum(s * d for s, d in zip(sizes, demand)) / 64 + 1


def test_packing_of_special_tokens(spark):
    """Strings of special tokens are those tokens, as the tokenizer has it by default."""
    import struct
    import zlib as z

    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(queries.default_tokenizer())
    rows = [(1, "a <|endoftext|> b"), (2, "x<|startoftext|>y<|ENDOFTEXT|>"), (3, "plain Ünder ΣΑΣ ﬁ."), (4, None)]
    got = {r["doc_id"]: r for r in packing.pack(H.docs_frame(spark, rows), queries.default_tokenizer()).collect()}
    for i, text in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        assert (got[i]["doc_tokens"], got[i]["ids_crc32"]) == (len(ids), z.crc32(struct.pack(f"<{len(ids)}I", *ids)))


def test_benchmark_in_parts(spark, hard_rows):
    """A benchmark of many parts gives the rows of one part, also where cutting brings words together."""
    rng = random.Random(12)
    items = [(f"i{k}", sentence(rng, 14)) for k in range(12)]
    rows = [(k, f"{sentence(rng, 9)} {items[k % 12][1]} {sentence(rng, 9)}") for k in range(30)]
    rows.append((99, " ".join([*items[0][1].split()[:7], items[1][1], *items[0][1].split()[7:]])))
    df, bench = H.docs_frame(spark, rows).withColumnRenamed("lang", "row"), spark.createDataFrame(items, "item_id string, text string")
    for run in (decontaminate.scan, decontaminate.remove_spans):
        assert H.ordered(run(df, bench, part_bytes=200).collect()) == H.ordered(run(df, bench).collect())
    left = {r["doc_id"]: r["text"].split() for r in decontaminate.remove_spans(df, bench, part_bytes=200).collect()}
    assert left[99] == []


def test_columns_of_clashing_names(spark):
    """Whatever other columns are called, they are kept as they are."""
    from riskweft.llm import lines, minhash, toxicity

    names = ["__text", "__id", "__class", "__answers", "row", "text2", "answers", "id", "key", "a.b", "numbers"]
    df = H.docs_frame(spark, [(k, f"same words in each text but {k // 2} of them\nx") for k in range(6)])
    df = df.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    bench = spark.createDataFrame([("i", "same words in each text but 1 of them x")], "item_id string, text string")
    outs = [
        toxicity.score(df, toxicity.Model()), decontaminate.scan(df, bench), decontaminate.remove_spans(df, bench),
        lines.dedup_lines(df), minhash.mark(df),
    ]
    for out in outs:
        rows = out.collect()
        assert out.columns[: len(df.columns)] == df.columns and len(rows) == 6
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
