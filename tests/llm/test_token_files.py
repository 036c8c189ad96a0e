"""Token files: exact round trips and the contract's digest."""

import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskweft.llm import binary, queries
from tests.llm import helpers as H


@pytest.fixture(scope="module")
def plain():
    encoder = Tokenizer.from_file(queries.default_tokenizer())
    return lambda text: encoder.encode(text or "", add_special_tokens=False).ids + [1]


def test_coding_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 2 ** rng.integers(1, 33, n), dtype=np.uint64).astype("<u4")
        control, data = binary.coded(ranks)
        assert len(control) == -(-n // 4)
        assert (binary.decoded(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8))[:n] == ranks).all()
    control, data = binary.coded(np.array([0, 255, 256, 70_000, 2**24, 2**32 - 1], "<u4"))
    assert control == bytes([0 | 0 | 1 << 4 | 2 << 6, 3 | 3 << 2]) and len(data) == 1 + 1 + 2 + 3 + 4 + 4 + 2


def test_decoding_in_parts(monkeypatch):
    ranks = np.random.default_rng(2).integers(0, 2**20, 10_000).astype("<u4")
    control, data = (np.frombuffer(x, np.uint8) for x in binary.coded(ranks))
    monkeypatch.setattr(binary, "DECODE", 7)
    assert (binary.decoded(control, data) == ranks).all()


def expected(rows, plain):
    """Documents in ascending order; those with equal ids by number of tokens."""
    own = sorted(((i, plain(t)) for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, len(x[1])))
    out, start = [], 0
    for i, ids in own:
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_files_equal_plain_version(spark, plain, tmp_path):
    rng = random.Random(4)
    words = ["the", "Ünder", "don't", "x1y2", "<|endoftext|>", "a<|startoftext|>b", "ΣΑΣ", "한국어", "...", "ﬁn", "é"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(30)))) for k in range(300, 0, -1)]
    rows += [(7, None), (8, ""), (9, " \n"), (None, "no id"), (-4, "minus"), (5000, "long text " * 60_000)]
    rows += [(11, "the same")] * 50
    df = H.docs_frame(spark, rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "row").repartition(6)
    folder = str(tmp_path / "tokens")
    manifest = binary.write(df, folder, queries.default_tokenizer(), file_ids=20_000)
    assert manifest.count() > 1 and manifest.agg({"documents": "sum"}).first()[0] == len(rows)
    want = expected(rows, plain)
    got = binary.read(spark, folder, keep_ids=False).collect()
    strict = [tuple(r) for r in sorted(got, key=lambda r: r["start"])]
    assert [r[1:3] for r in strict] == [r[1:3] for r in want] and H.ordered(strict) == H.ordered(want)
    held = {r["start"]: (r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in binary.read(spark, folder).collect()}
    assert held[strict[-1][1]] == (5000, plain("long text " * 60_000))
    # The most frequent ids have one byte: the table is in order of frequency.
    table = binary.id_table(folder).tolist()
    assert len(table) == len(set(table)) and set(table[:2]) == set(plain("long text")[:2])


def test_registered_query(spark, sf, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_token_files"](spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert H.ordered(got.collect()) == H.ordered(expected(rows, plain))


def test_empty_table_and_broken_file(spark, tmp_path):
    assert binary.round_trip(H.docs_frame(spark, []), queries.default_tokenizer()).count() == 0
    (tmp_path / "x.tvb").write_bytes(b"something else")
    with open(tmp_path / "x.tvb", "rb") as stream, pytest.raises(ValueError, match="not a file"):
        list(binary.blocks(stream))
