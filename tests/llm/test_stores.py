"""WARC archives, vector search, the n-gram model, the pipeline."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.conftest import lower, words
from tidemart.llm import ngrams, search, warc
from tidemart.session import written


def read_pages(spark, pages, path, least_bytes=0):
    warc.write_warc(pages, path, least_bytes=least_bytes)
    return warc.read_warc(spark, path)


EVIL = (
    "before WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 900000\r\n\r\nafter WARC/1.1\r\n")


@pytest.fixture(scope="module")
def pages(spark):
    bodies = ["<p>é</p>", None, "", "same", "same", EVIL, "\r\n\r\n", "WARC/1.1\r\n", "x" * 200_000, EVIL, "\n", "same"]
    rows = [(i, f"http://h/{i}\r\nX: y" if i % 2 else None, b, "extra") for i, b in enumerate(bodies)]
    rows += [(100 + i, "u", f"page {i} " * (i % 50), "extra") for i in range(300)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_round_trip(spark, pages, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # records span many splits
    try:
        records = read_pages(spark, pages.repartition(3), str(tmp_path / "a")).select(
            warc.field("WARC-Record-ID").alias("id"), warc.field("WARC-Type").alias("type"),
            warc.field("WARC-Refers-To").alias("refers"), "body").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    bodies = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    first = {}
    for i in sorted(bodies):
        first.setdefault(bodies[i], i)
    assert sorted(r["id"] for r in records) == sorted(f"<urn:page:{i}>" for i in bodies)
    for r in records:
        i = int(r["id"][10:-1])
        if first[bodies[i]] == i:
            assert (r["type"], bytes(r["body"]), r["refers"]) == ("response", bodies[i], "")
        else:
            assert (r["type"], bytes(r["body"])) == ("revisit", b"")
            assert r["refers"] == f"<urn:page:{first[bodies[i]]}>"


def test_warc_query(spark):
    rows = {r["page_id"]: r for r in warc.op4_warc(spark, SMALL).collect()}
    for p in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        data = (p["html"] or "").encode()
        r = rows.pop(p["page_id"])
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert not rows


def test_warc_limits(spark, pages, tmp_path):
    few = read_pages(spark, pages.where("page_id < 12"), str(tmp_path / "b"), 5)
    assert few.where(warc.field("WARC-Type") == "revisit").count() == 1  # only the long equal pair
    assert read_pages(spark, pages.limit(0), str(tmp_path / "c")).count() == 0
    nameless = pages.limit(2).withColumn("page_id", F.lit(None).cast("long"))
    assert read_pages(spark, nameless, str(tmp_path / "d")).count() == 2


def test_pointer_jumping(spark):
    chain = [(7, i * 10, i * 10 + 10) for i in range(40) if i != 25]  # broken at 250
    inside = [(7, 33, 50), (7, 47, 999), (8, 5, 10)]
    got = warc.reached(spark.createDataFrame(chain + inside, "file long, offset long, next long")).collect()
    assert sorted(r["offset"] for r in got) == [i * 10 for i in range(25)]


def best(vectors, k, asks):
    found = []
    for q, v in vectors:
        if asks(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q and len(w) == len(v))
            found += [(q, r + 1, i, -int(s)) for r, (s, i) in enumerate(scores[:k])]
    return sorted(found)


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [float(math.floor(256 * x)) for x in vector]


def test_search_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 100)
    monkeypatch.setattr(search, "CHUNK", 7)
    monkeypatch.setattr(search, "LEAF", 10)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(500)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.0, 0.0, 0.0]) for i in range(300)]  # ties of equal vectors
    rows += [(5000, None), (5001, [1.0, None, 0.0]), (5002, [float("nan")] * 6), (5003, [float("inf")] * 6),
             (5010, [1.0, 2.0]), (5020, [2.0, 1.0]), (5050, []), (None, [1.0] * 6), (0, rows[0][1])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, v string")
    vectors = {}
    for r in frame.collect():
        if r["vec_id"] is not None and whole(r["embedding"]) is not None:
            vectors[r["vec_id"]] = whole(r["embedding"])
    got = search.top_k(frame, F.col("vec_id") % 10 == 0).collect()
    assert sorted(tuple(r) for r in got) == best(sorted(vectors.items()), 5, lambda i: i % 10 == 0)
    assert search.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_dual_tree_prunes():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8)) * 300
    x = np.floor(np.concatenate([c + rng.normal(size=(200, 8)) for c in centres]))
    compared = []
    plain = search._compare
    search._compare = lambda *a: (compared.append(len(a[4]) * len(a[5])), plain(*a))
    try:
        search.dual_search(x[::40], np.arange(0, len(x), 40), np.full(100, -np.inf), x, np.arange(len(x)), 5)
    finally:
        search._compare = plain
    assert sum(compared) < 0.3 * 100 * len(x)


def reference_model(training):
    """Modified Kneser-Ney on plain dictionaries; gives log10 of a text's probability."""
    grams, unigrams = Counter(), Counter()
    for text in training:
        seq = ["<s>", *words(lower(text)), "</s>"]
        grams.update(zip(seq, seq[1:]))
        unigrams.update(seq[1:])
    kinds, after = Counter(w for _, w in grams), defaultdict(Counter)
    for (h, w), c in grams.items():
        after[h][w] = c

    def discounts(counts):
        return ngrams._discounts(np.array([sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]))

    d, dw = discounts(list(grams.values())), discounts(list(kinds.values()))
    cut = lambda c, x: x[min(c, 3) - 1]
    v, t = len(unigrams), len(grams)
    spare = sum(cut(c, dw) for c in kinds.values()) / t if t else 1.0

    def word(w):
        return (kinds[w] - cut(kinds[w], dw) if kinds[w] else 0) / max(t, 1) + spare / (v + 1)

    def score(text):
        seq = ["<s>", *words(lower(text)), "</s>"]
        total = 0.0
        for h, w in zip(seq, seq[1:]):
            n = sum(after[h].values()) if h in after else 0
            if n:
                p = (max(after[h][w] - cut(after[h][w], d), 0) if after[h][w] else 0) / n
                p += sum(cut(c, d) for c in after[h].values()) / n * word(w)
            else:
                p = word(w)
            total += math.log10(p)
        return total

    return score, unigrams


def check_scores(rows, texts, training):
    score, unigrams = reference_model(training)
    n, v = sum(unigrams.values()), len(unigrams)
    for r in rows:
        tokens = [*words(lower(texts[r["doc_id"]])), "</s>"]
        assert (r["n_tokens"], r["train_tokens"]) == (len(tokens), n)
        assert r["n_known"] == sum(unigrams[t] > 0 for t in tokens)
        assert r["base_score"] == pytest.approx(
            sum(math.log10((unigrams[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens), rel=1e-9)
        assert r["score"] == pytest.approx(score(texts[r["doc_id"]]), rel=1e-6)


def test_model_against_dictionaries(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    import zlib

    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    rows = ngrams.op9_ngrams(spark, SMALL).collect()
    assert {r["doc_id"] for r in rows if r["held_out"]} == held and len(rows) == len(texts)
    check_scores(rows, texts, [t for i, t in texts.items() if i not in held])


def test_model_edge_cases(spark, edge, empty):
    once = edge.dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in once.collect()}
    model = ngrams.train(once)
    keep = {"doc_id": F.col("doc_id")}
    check_scores(ngrams.score(once, model, keep).collect(), texts, list(texts.values()))
    assert ngrams.score(empty, model, keep).count() == 0
    untrained = ngrams.train(empty)
    assert {r["score"] for r in ngrams.score(once, untrained, keep).collect()} == {0.0}


def test_probabilities_sum_to_one(spark):
    rows = [(0, "a b a b c"), (1, "b c a d a"), (2, "a a a b"), (3, "d b b a c c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = ngrams.train(docs)
    tokens = np.concatenate([t for *_, t in ngrams.token_pairs(
        docs.select("text").toArrow().column(0).combine_chunks())])
    vocabulary = np.unique(tokens)
    for before in [ngrams.START, *vocabulary]:
        every = np.append(vocabulary, np.uint64(12345))  # one unknown word
        _, _, score = ngrams._token_scores(model, np.full(len(every), before, np.uint64), every)
        assert (10.0 ** score).sum() == pytest.approx(1, abs=1e-9)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == docs.columns and 0 < kept.count()
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
    per = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert per.where("n > 4096").count() == 0


def test_stages_take_edge_cases(spark, edge, empty):
    """Nulls, repeated rows, long and empty texts, and columns whose names the operators use inside."""
    *stages, (_, pack) = corpus_pipeline.STAGES
    for frame in (edge, empty):
        kept = frame
        for name, stage in stages:
            before, kept = kept, written(stage(spark, kept, SMALL), name)
            assert kept.columns == frame.columns
            ids = {r["doc_id"] for r in before.collect()}
            assert {r["doc_id"] for r in kept.collect()} <= ids
            if name == "language":
                assert {r["doc_id"] for r in kept.collect()} == {
                    r["doc_id"] for r in before.collect() if any(map(str.isalpha, r["text"] or ""))}
            if name == "near_duplicates":  # equal texts: one document stays
                texts = [r["text"] for r in kept.dropDuplicates(["doc_id"]).collect()]
                assert len(texts) == len(set(texts))
        rows = pack(spark, kept, SMALL).collect()
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in kept.collect()}


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
