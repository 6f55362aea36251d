"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.conftest import SMALL
from tests.llm.conftest import lower
from tidemart.llm import spelling

RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(docs):
    counts = Counter()
    for i, text in docs:
        for run in RUNS.findall(text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= 5:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def one_edit(word, symbols):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in symbols} | {
        a + c + b[1:] for a, b in cuts if b for c in symbols} - {word}


def plain(counts):
    """word -> n, n_near, form, form_n, root, by deleting a letter from every word."""
    shorter = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            shorter[w[:i], w[i + 1:]].add(w)  # equal but for one letter
    near = defaultdict(set)
    for group in shorter.values():
        for w in group:
            near[w] |= group - {w}
    for w in counts:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            if cut in counts:
                near[w].add(cut)
                near[cut].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], counts[form[w]] if form[w] is not None else None, root)
    return out


def as_dict(rows):
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert as_dict(spelling.op12_spelling(spark, SMALL).collect()) == plain(plain_words(docs))


def test_edge_cases(spark, edge, empty):
    assert as_dict(spelling.variants(spelling.vocabulary(edge)).collect()) == plain(
        plain_words([(r["doc_id"], r["text"]) for r in edge.collect()]))
    assert spelling.variants(spelling.vocabulary(empty)).collect() == []


@pytest.mark.parametrize("block", [7, 60, 5000])
def test_any_range_size(spark, block):
    rng = random.Random(block)
    words = {"".join(rng.choice("abé÷") for _ in range(rng.randint(5, 7))) for _ in range(300)}
    words |= {"a" * n for n in range(5, 40)} | {"same" + "".join(rng.choice("xyz") for _ in range(4)) for _ in range(60)}
    words |= {"x" * 2_000, "x" * 2_001, "x" * 1_999 + "y", "xy" * 900}
    counts = {w: rng.choice([3, 3, 4, 6, 8, 20, 100]) for w in words}
    frame = spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(3)
    assert as_dict(spelling.variants(frame, block).collect()) == plain(counts)


def test_searches_see_every_edit():
    word = "abcdeé"
    others = sorted(one_edit(word, "abcdeéz"))
    found = set()
    for side in (0, 1):
        index = spelling.Index([o[::-1] for o in others] if side else others)
        ask, hit = index.near([word[::-1] if side else word], spelling.np.array([3]))
        found |= {others[j] for j in hit}
    assert found == set(others)
