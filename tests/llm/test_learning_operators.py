"""Operators with a trained part: exact columns against plain versions, learned ones by held-out quality."""

import math
import zlib

import numpy as np
import pytest

import corpus_pipeline
from riskweft.llm import licenses, lm, queries, toxicity, urls
from tests.llm import helpers as H


def table_rows(spark, sf, name="documents", columns=("doc_id", "text")):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*columns).collect()]


def plain_url(url):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
    path = rest[cut:]
    end = min([k for k in (path.find(c) for c in "?#") if k >= 0], default=len(path))
    host, path = rest[:cut].translate(H.A_TO_Z), path[:end]
    best = None
    for verdict, rule in queries.URL_RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def test_urls(spark, sf):
    rows = table_rows(spark, sf, "pages", ("page_id", "url"))
    got = queries.QUERIES["op1_url_filter"](spark, sf)
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    found = {r["page_id"]: r for r in got.collect()}
    for page, url in rows:
        host, path, best = plain_url(url)
        r = found[page]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best[0] if best else None)
        assert r["verdict"] == (best[1] if best else "block" if r["block_probability"] >= 0.5 else "allow")
    judged = [(best[1], found[p]["block_probability"]) for p, u in rows for best in [plain_url(u)[2]] if best]
    assert np.mean([(v == "block") == (q >= 0.5) for v, q in judged]) > 0.95


def test_urls_odd_and_untrained(spark):
    odd = ["http://A.Net/x", "http://anet/", "https://net?x=/", "x://y.org/fr/://z", "://net/", None, "", "net/", "http://É.ORG/fr/é#q", "http://a.org/" + "é/" * 5000, "http://a\nb.net/\n?x"]
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(odd)], "page_id bigint, url string, host string")
    for model in (None, urls.train(urls.ruled(urls.parsed(df), queries.URL_RULES))):
        out = urls.judge(df, queries.URL_RULES, model)
        for r in out.collect():
            host, path, best = plain_url(r["url"])
            assert (r["host"], r["path"], r["rule"]) == (host, path, best[0] if best else None), r["url"]
            assert r["verdict"] in ("allow", "block")
    assert urls.train(df.withColumn("verdict", H_lit("block"))) is None
    assert urls.judge(df.filter("page_id < 0"), queries.URL_RULES, None).count() == 0
    with pytest.raises(ValueError):
        urls.judge(df, [("block", f"h{k}/") for k in range(2000)], None)


def H_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def plain_base(rows):
    """Unigram columns of the language model."""
    texts = [(i, [w.translate(H.A_TO_Z) for w in H.SPACE_WORDS.findall(t or "")] + ["\n"]) for i, t in rows]
    rest = {i: zlib.crc32(str(i).encode()) % 10 if i is not None else None for i, _ in texts}
    counts = {}
    for i, words in texts:
        if rest[i]:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, words in texts:
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        yield i, rest[i] == 0, len(words), sum(counts.get(w, 0) > 0 for w in words), n, base


def same_base(got, want):
    got, want = H.ordered([tuple(r)[:5] + (round(r[5], 6),) for r in got]), H.ordered([w[:5] + (round(w[5], 6),) for w in want])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-5 for g, w in zip(got, want))


def test_lm_table(spark, sf):
    got = queries.QUERIES["op4_lm_score"](spark, sf).collect()
    same_base(got, plain_base(table_rows(spark, sf)))
    kept = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in kept) > sum(r["base_score"] for r in kept)


def test_lm_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "COUNTED", 900)
    rows = [(k, " ".join(f"w{(k * 31 + j * j) % 4000}" for j in range(60))) for k in range(200)]
    rows += [(500, None), (501, ""), (None, "w1 w2"), (7, rows[7][1]), (502, "Never SEEN é")]
    same_base(lm.score(H.docs_frame(spark, rows).repartition(4)).collect(), plain_base(rows))
    assert lm.score(H.docs_frame(spark, [])).count() == 0
    alone = lm.score(H.docs_frame(spark, [(None, "a b")])).collect()
    assert alone[0]["n_tokens"] == 3 and alone[0]["train_tokens"] == 0 and math.isfinite(alone[0]["score"])


def test_lm_probabilities_add_up():
    frequencies = np.arange(lm.OUTPUTS, dtype=float)
    net = lm.Bilinear(frequencies)
    rng = np.random.default_rng(0)
    net.trainer()(*lm.events(rng.integers(0, lm.OUTPUTS, 20_000).astype(np.int32), 0))
    log_z = net.log_normaliser(np.arange(4))
    two = np.arange(lm.OUTPUTS)
    for one in range(4):
        scores = net.predict(np.full(lm.OUTPUTS, one), two) @ net.target.T + net.bias
        assert np.allclose(np.exp(scores - log_z[one][:, None]).sum(axis=1), 1, atol=1e-3)


def toxic_rows(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    words, bad = [f"w{k}" for k in range(400)], ["vile", "vileness", "foul", "fouler"]
    rows, labels = [], []
    for k in range(n):
        text, toxic = list(rng.choice(words, 40)), int(k % 8 == 0)
        if toxic:
            text[5], text[20] = rng.choice(bad), rng.choice(bad)
        rows.append((k, " ".join(text)))
        if k % 2 == 0:
            labels.append((k, toxic))
    return rows, labels


def test_toxicity_held_out_and_odd_rows(spark):
    rows, labels = toxic_rows()
    truth = dict(labels)
    rows += [(9000, None), (9001, ""), (None, "vile foul"), (9003, "w1 " * 20_000), (4, rows[4][1])]
    df = H.docs_frame(spark, rows).withColumnRenamed("lang", "score").repartition(4)
    more = [(None, 1), (12, None), (77777, 1)]
    marks = spark.createDataFrame([*labels, *more], "doc_id bigint, toxic int")
    model = toxicity.train(df, marks)
    out = toxicity.score(df, model).withColumn("held", toxicity.held_out()).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in out if r["held"] and r["doc_id"] in truth]
    assert np.mean([a == b for a, b in held]) > 0.97 and sum(a for a, _ in held) > 10
    empty = {r["doc_id"]: r["score"] for r in out}
    assert empty[9000] == empty[9001] < 0.5 and empty[None] > 0.5
    # Labels of the held-out fold change nothing.
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    flipped = spark.createDataFrame([*flipped, *more], marks.schema)
    again = toxicity.train(df, flipped)
    assert again.weights == model.weights and again.intercept == model.intercept
    none = toxicity.train(df, marks.filter("toxic = 0"))
    assert toxicity.score(df, none).filter("predicted = 1").count() == 0
    assert toxicity.score(H.docs_frame(spark, []), model).count() == 0


def test_licences(spark, sf):
    rows = table_rows(spark, sf)
    odd = [(-1, None), (-2, ""), (-3, "MIT License, mit-license. CC BY cc cc by; GNU General Public general public License gnu general public license"), (None, "apache license"), (-4, "the of " * 20_000)]
    body = licenses.TEMPLATES[0][1]
    odd += [(-5, "before " + body + " after"), (-6, " ".join(body.split()[:9]) + " xx " + " ".join(body.split()[10:]))]
    scanned = licenses.scan(H.docs_frame(spark, rows + odd))
    got = {r["doc_id"]: r for r in licenses.digest(scanned).collect()}
    for i, text in rows + odd:
        n, places = H.licence_base(text)
        r = got[i]
        starts = [k for k, _ in places]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    spans = {r["doc_id"]: r["spans"] for r in scanned.collect()}
    assert [(s["label"], s["first"], s["end"]) for s in spans[-5] if s["share"] == 1.0] == [("apache", 1, 1 + len(H.alnum(body)))]
    assert any(s["label"] == "apache" and s["share"] > 0.9 for s in spans[-6]) and not spans[-4]
    assert licenses.scan(H.docs_frame(spark, [])).count() == 0


def test_automaton_matching_statistics():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"x{k}" for k in rng.integers(0, 3, 12)) for _ in range(4)]
    auto = licenses.Automaton.of({}, [("t", t) for t in texts])
    stream = [f"x{k}" for k in rng.integers(0, 3, 300)]
    codes = [auto.vocabulary.get(w.encode(), 0) for w in stream]
    plain = [" " + t + " " for t in texts]
    for i, (_, size) in enumerate(auto.statistics(codes)):
        best = max(n for n in range(14) if n <= i + 1 and (n == 0 or any(" " + " ".join(stream[i + 1 - n : i + 1]) + " " in t for t in plain)))
        assert size == best


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()] if name != "packing" else None
        out = stage(spark, docs, sf)
        if name == "packing":
            break
        assert out.columns == columns
        out = spark.createDataFrame(out.collect(), docs.schema)
        kept[name] = {r["doc_id"]: r for r in out.collect()}
        texts = dict(before)
        if name == "line dedup":
            want = {i: s for i, _, _, s in H.line_dedup(before)}
            assert all(H.sha(r["text"]) == want[i] for i, r in kept[name].items())
            assert all(r["n_chars"] == len(r["text"]) for r in kept[name].values())
        elif name == "near-duplicates":
            want = H.near_classes(before)
            assert set(kept[name]) == {i for i in want if want[i] == i}
        elif name == "decontamination":
            items = table_rows(spark, sf, "benchmark", ("item_id", "text"))
            hits = {r[0]: r[2] for r in H.decontaminate(before, items)}
            assert all(r["text"] == texts[i] for i, r in kept[name].items() if not hits[i])
            assert not any(r[2] for r in H.decontaminate([(i, r["text"]) for i, r in kept[name].items()], items))
        docs = out
    rows = out.collect()
    assert {r["doc_id"] for r in rows} == set(kept["decontamination"])
    assert set(out.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_pipeline_stages_take_empty_tables(spark, sf):
    docs = H.docs_frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0, name
