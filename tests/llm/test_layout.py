"""Packing, mixing, sharding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.conftest import words
from tidemart.llm import common, mixing, packing, sharding

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def check_pieces(rows, texts, tokenizer):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by) == set(texts)
    for i, text in texts.items():
        want = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], np.uint32)
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            ids = want[r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and r["length"] == len(ids) and r["doc_tokens"] == len(want)
            assert r["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
            at += r["length"]
        assert at == len(want)
    used, padded = 0, 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
        used, padded = used + at, padded + (at if at & (at - 1) == 0 else 4096)
    return used / padded


def test_pack_documents(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert check_pieces(packing.op3_pack(spark, SMALL).collect(), texts, tokenizer) > 0.9


def test_pack_edge_cases(spark, edge, empty, tokenizer):
    once = edge.dropDuplicates(["doc_id"])
    odd = [(1000 + i, t) for i, t in enumerate([
        "it's 'TIS don't x ́e  <|endoftext|> \x1cq\x85z", "İstanbul ΣΑΣ ﬁ 中文 123 4.5  x",
        "$$$ a1b2,c3. __x \x7f ​ z", " '́s", "A" * 300])]
    frame = once.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = packing.pack(frame, PATH).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, {r["doc_id"]: r["text"] for r in frame.collect()}, tokenizer)
    assert packing.pack(empty, PATH).count() == 0
    assert packing.pack(edge, PATH).where("doc_id = 5").count() >= 3  # repeated rows are packed each


def test_long_texts_come_in_chunks(monkeypatch, tokenizer):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "quick", "é", "don't", "x1"]) for _ in range(n)) for n in (3000, 0, 2, 900, 5)]
    for size in (64, 1000):
        monkeypatch.setattr(common, "CHUNK", size)
        got = dict(packing.tokenized(pa.array(texts), packing.WordIds(PATH)))
        for i, t in enumerate(texts):
            assert got[i].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [2]


def test_plain_words_skip_the_normalizer(tokenizer):
    """Words with Western letters go to the model many at a time, as ASCII words do."""
    texts = ["Élan DÉJÀ vu, groß. x1 ÿ</w> ÀÖØÞ$$$ 42", "naïve–", "l'été × ÷ \u00a0 Straße"]
    made = packing.WordIds(PATH)
    got = [ids.tolist() for _, ids in packing.tokenized(pa.array(texts), made)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    made.clear()
    made.tokenizer = None
    (_, ids), = packing.tokenized(pa.array(texts[:1]), made)
    assert ids.tolist() == got[0]


def test_differencing():
    rng = random.Random(2)
    sizes = [rng.randint(1, 400) for _ in range(300)]
    dealt = packing.differenced(sizes, 10)
    loads = np.bincount(dealt, sizes, 10)
    assert loads.sum() == sum(sizes) and loads.max() - loads.min() <= 4  # nearly equal
    for some in ([5], [3, 3], [4096] * 3, [4095, 4095, 4], [1] * 5000):
        windows = packing.windows_of(some)
        assert sorted(i for w in windows for i in w) == list(range(len(some)))
        assert all(sum(some[i] for i in w) <= 4096 for w in windows)
    assert len(packing.windows_of([3000, 3000, 2000])) == 3  # two windows would exceed the capacity


def reference_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        free = sum(weight[s] for s in names if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in stopped and target[s] > most * sizes[s]}
        if not over:
            return target
        stopped |= over


def check_mix(rows, docs):
    sizes, taken = Counter(), Counter()
    by = {}
    for r in docs:
        sizes[r["source"]] += len(words(r["text"]))
    target = reference_targets(dict(sizes))
    for r in rows:
        by[r["doc_id"]] = r
    for d in docs:
        r = by[d["doc_id"]]
        assert r["size"] == len(words(d["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[d["source"]]
        assert r["target"] == pytest.approx(target[d["source"]], abs=1e-6)
        taken[d["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1


def test_mix(spark, edge, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    first = mixing.op5_mix(spark, SMALL).collect()
    check_mix(first, docs)
    assert sorted(first) == sorted(mixing.op5_mix(spark, SMALL).collect())
    once = edge.dropDuplicates(["doc_id"])
    check_mix(mixing.mix(once).collect(), once.collect())
    assert mixing.mix(edge).count() == edge.count()
    assert mixing.mix(empty).count() == 0
    blank = edge.withColumn("text", F.lit(None).cast("string"))
    assert {r["taken"] for r in mixing.mix(blank).collect()} == {0}


def test_better_documents_come_first(spark):
    rows = [(i, "word " * 50 if i % 2 else "wo#d $$$ " * 25, s) for s in "ab" for i in range(4000)]
    rows = [(k, t, s) for k, (_, t, s) in enumerate(rows)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("source = 'b'")
    share = {r["good"]: r["s"] for r in got.groupBy((F.col("doc_id") % 2 == 1).alias("good")).agg(
        F.avg((F.col("taken") > 0).cast("int")).alias("s")).collect()}
    assert share[True] > 1.5 * share[False]


def test_mixed_rows(spark, edge):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(edge.dropDuplicates(["doc_id"])).collect()}
    got = Counter(r["doc_id"] for r in mixing.mixed(edge.dropDuplicates(["doc_id"])).collect())
    assert got == Counter({i: n for i, n in plan.items() if n})
    assert mixing.mixed(edge).columns == edge.columns


def check_shards(rows, frame, slack):
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
                    for r in frame.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == texts
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    total, largest = sum(sizes.values()), max(r["size"] for r in rows)
    assert set(sizes) <= set(range(8))
    for s in range(8):
        assert abs(sizes[s] - total / 8) <= largest + slack * total / 8


def test_shards(spark, edge, empty):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    check_shards(sharding.op6_shard(spark, SMALL).collect(), frame, 0.05)
    check_shards(sharding.shard(edge).collect(), edge, 0.2)
    assert sharding.shard(empty).count() == 0


def test_middle_lies_inside():
    near = [(-7759772254953089058, -7687749143748030744), (-3, -2), (-1, 0), (0, 1), ((1 << 63) - 2, (1 << 63) - 1),
            (-(1 << 63), (1 << 63) - 1)]
    for low, high in near:
        assert low < sharding._middle((low, 5), (high, 1))[0] <= high
        assert sharding._middle((7, low), (7, high))[0] == 7
        assert low < sharding._middle((7, low), (7, high))[1] <= high


@pytest.mark.parametrize("keys", [[(-7759772254953089058, 1), (-7687749143748030744, 2), (-7687749143748030744, 3)],
                                  [(5, 9007199254740993), (5, 9007199254740994), (5, 9007199254740995)]])
def test_ranges_that_doubles_cannot_cut(spark, keys, monkeypatch):
    monkeypatch.setattr(sharding, "_sample", lambda *a: [])  # only the halving is left
    rows = spark.createDataFrame([(*k, 1000) for k in keys], "_key long, _id long, size long")
    found, sums = sharding.splitters(rows, 3000, 8)
    assert len(sums) == len(set(keys)) and sum(s[2] for s in sums) == 3


def test_a_hot_text_is_cut_by_id(spark):
    frame = spark.createDataFrame(
        [(i, "the same text" if i % 3 else f"text number {i}") for i in range(6000)], "doc_id long, text string")
    rows = sharding.shard(frame).collect()
    check_shards(rows, frame, 0.02)
    assert len({r["shard"] for r in rows if r["doc_id"] % 3}) >= 5


def test_equal_texts_lie_together(spark):
    frame = spark.createDataFrame([(i, f"text number {i % 900}") for i in range(3600)], "doc_id long, text string")
    shards = defaultdict(set)
    for r in sharding.shard(frame).collect():
        shards[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 7
