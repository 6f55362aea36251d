"""Repeated windows against a plain dictionary of windows."""

import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.conftest import words
from tidemart.llm import repeats


def plain(docs, window=50):
    first = {}
    for i, text in docs:
        w = words(text)
        for k in range(len(w) - window + 1):
            at = tuple(w[k:k + window])
            if i is not None:
                first[at] = min(i, first.get(at, i))
    out = []
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(frame, **options):
    rows = repeats.deduplicate(frame, keep_text=False, **options).collect()
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows], key=str)


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = repeats.op13_repeats(spark, SMALL).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found], key=str) == plain(docs)
    assert sum(r["n_removed"] for r in found) > 0


def made(seed):
    rng = random.Random(seed)
    draw = lambda n, kinds=5000: [f"w{rng.randrange(kinds)}é"[:rng.choice([2, 3, 6])] for _ in range(n)]
    passages = [draw(n) for n in (49, 50, 51, 80, 300)]
    docs = []
    for i in range(120):
        text = draw(rng.randrange(0, 90))
        for _ in range(rng.randrange(3)):
            text += rng.choice(passages) + draw(rng.randrange(4))
        docs.append((rng.randrange(10_000) * 100 + i, rng.choice([" ", "\n", "  "]).join(text)))
    docs += [(i, docs[i % 7][1]) for i in range(7, 15)] + [(5, "buy " * 200), (6, "now buy " * 90), (4, "buy " * 49)]
    changed = docs[3][1].split() or ["x"]
    changed[len(changed) // 2] = "changed"
    docs += [(1_000_001, " ".join(changed)), (3, "same id " * 40), (3, "same id " * 41), (3, "same id " * 41)]
    return docs


@pytest.mark.parametrize("group", [2, 30, 2000])
def test_any_group_size(spark, group):
    docs = made(group)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert result(frame, group=group) == plain(docs)


def test_short_windows(spark):
    docs = made(9)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert result(frame, window=7, prefix=3, group=50) == plain(docs, 7)


def test_edge_cases(spark, edge, empty):
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert result(edge) == plain(docs)
    assert result(empty) == []
    texts = {r["doc_id"]: r["kept_text"] for r in repeats.deduplicate(edge).collect()}
    assert texts[3] == "one" and texts[1] == ""


def test_long_texts_in_pieces(spark):
    long = " ".join(f"w{i}" for i in range(400_000))  # several pieces of CHUNK bytes
    docs = [(2, long), (1, "intro " + long[-300_000:]), (9, "x " + long[:40_000])]
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs)


def test_common_prefix_lengths():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 3, 400)
    tree = repeats.Subtree([b" ".join(str(t).encode() for t in tokens)], 6)
    order, nodes = tree.deep_nodes(np.arange(395))
    groups = [tuple(tokens[i:i + 6]) for i in order[nodes]]
    assert len(set(groups)) == len(groups) == len({tuple(tokens[i:i + 6]) for i in range(395)})
    for a, b in zip(nodes, [*nodes[1:], len(order)]):
        assert len({tuple(tokens[i:i + 6]) for i in order[a:b]}) == 1
