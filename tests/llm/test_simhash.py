import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.conftest import lower, words
from tidemart.llm import simhash


def shingles(text, k):
    w = words(lower(text))
    if not w:
        return []
    return [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]


def fingerprint(text, k=3):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, k)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(prints, most=2):
    """id -> least id reachable, by comparing all pairs."""
    label = {i: i for i in range(len(prints))}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def test_against_all_pairs(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    prints = [fingerprint(r["text"]) for r in docs]
    want = {docs[i]["doc_id"]: (f"{prints[i]:016x}", docs[g]["doc_id"]) for i, g in enumerate(groups(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op1_simhash(spark, SMALL).collect()}
    assert got == want


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_the_keys_of_the_fingerprints_are_not_broadcast(spark):
    plan = simhash.links(spark.range(1000).toDF("fp"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_every_link_is_found_once(spark):
    rng = random.Random(4)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    prints = sorted(prints)
    want = {frozenset((_signed(a), _signed(b))) for i, a in enumerate(prints) for b in prints[:i]
            if (a ^ b).bit_count() <= 2}
    frame = spark.createDataFrame([(_signed(p),) for p in prints], "fp long")
    got = [frozenset(r) for r in simhash.links(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    with pytest.raises(ValueError):
        simhash.links(frame, 3)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(40)] + [(300, 301)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r["node"]: r["label"] for r in simhash.components(
        spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 140), 200]} | {300: 300, 301: 300}
    assert got == want


def test_edge_cases(edge, empty):
    rows = simhash.duplicate_groups(edge).collect()
    assert len(rows) == edge.count()
    ids = {}
    for r in edge.collect():
        ids.setdefault(fingerprint(r["text"]), []).append(r["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in edge.collect()}
    for r in rows:
        assert r["fp"] % (1 << 64) == fingerprint(texts[r["doc_id"]])
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {0}
    assert simhash.duplicate_groups(empty).count() == 0


def similar(a, b, k=5):
    x, y = set(shingles(a, k)), set(shingles(b, k))
    return not (x | y) or len(x & y) >= 0.8 * len(x | y)


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, truth = [], {}
    for g in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 120, 400]))]
        for c in range(rng.choice([1, 1, 2, 5])):
            text = list(base)
            if c == 1:
                text[rng.randrange(len(text))] = "changed"
            rows.append((len(rows), " ".join(text)))
            truth[rows[-1][0]] = g
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [r["doc_id"] for r in simhash.deduplicate(docs).collect()]
    first = {}
    for i, g in sorted(truth.items()):
        first.setdefault(g, i)
    text = dict(rows)
    assert sorted(kept) == sorted(
        i for i, g in truth.items() if i == first[g] or not similar(text[i], text[first[g]]))


def test_near_duplicates_of_the_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = sorted(docs)
    sets = {i: set(shingles(docs[i], 5)) for i in ids}
    pairs = {(i, j) for i in ids for j in ids if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    gone = {r["doc_id"] for r in simhash.near_duplicates(frame).collect()}
    parted = {j for _, j in pairs}
    assert len(gone & parted) >= 0.97 * len(parted) and gone <= parted


def test_near_copies_among_texts_that_share_a_passage(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows = []
    for share in (300, 320):
        passage = [rng.choice(vocabulary) for _ in range(share)]
        for _ in range(80):
            own = [rng.choice(vocabulary) for _ in range(400 - share)]
            copy = list(own)
            for at in range(5, len(own), len(own) // 8):
                copy[at] = f"changed{rng.random()}"
            rows += [(len(rows) + i, " ".join(passage + t)) for i, t in enumerate((own, copy))]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    text = {i: t for i, (_, t) in zip(ids, rows)}
    sets = {i: set(shingles(t, 5)) for i, t in text.items()}
    pairs = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(pairs) == 160
    assert all(len(sets[i] & sets[j]) < 0.85 * len(sets[i] | sets[j]) for i, j in pairs)
    docs = spark.createDataFrame(sorted(text.items()), "doc_id long, text string").repartition(4)
    got = {(r["keeper"], r["doc_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == set(pairs)


def test_deduplicate_edge_cases(edge, empty):
    kept = simhash.deduplicate(edge)
    assert kept.columns == edge.columns
    texts = [r["text"] or "" for r in kept.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]).collect()]
    assert len(texts) == len(set(texts))
    assert simhash.deduplicate(empty).count() == 0


def test_candidates_by_counts_of_all_shingles(spark, monkeypatch):
    # No pair is tried whose common shingles are all among the common ones, however many texts there are.
    monkeypatch.setattr(simhash, "COUNTED", 1, raising=False)
    passages = [[f"p{i}_{j}" for j in range(20)] for i in range(60)]
    texts = [(i, i, " ".join(passages[i] + [f"own{i}_{j}" for j in range(60)] + passages[(i + 1) % 60])) for i in range(60)]
    twin = texts[7][2].rsplit(" ", 1)[0] + " other"
    texts += [(100, 100, twin), (101, 101, ""), (102, 102, " "), (100, 100, twin)]
    frame = spark.createDataFrame(texts, "doc_id long, label long, _text string").repartition(3)
    found = sorted((r["a"], r["b"]) for r in simhash._prefix_pairs(frame, k=5, similarity=0.8).collect())
    assert found == [(7, 100), (101, 102)]
