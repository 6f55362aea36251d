"""Whitening against numpy's own decompositions."""

import numpy as np
import pytest

from tests.conftest import SMALL
from tidemart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, x int, component int"


def plain(rows, components=4):
    """(vec_id, component) -> deviation, whitened, explained, from the covariance itself."""
    x = [np.floor(256 * np.array(v, float)).astype(np.int64) for _, v in rows]
    distinct = np.array(sorted({tuple(map(int, v)) for v in x}))
    n, total = len(distinct), distinct.sum(0)
    centred = distinct - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    out = {}
    for (i, _), v in zip(rows, x):
        for c in range(min(components, len(total))):
            e = values[order[c]]
            out[i, c + 1] = (int(((n * v - total) ** 2).sum()), (v - total / n) @ vectors[:, order[c]] / np.sqrt(e),
                             e / values.sum(), n)
    return out


def check(found, want):
    assert len(found) == len(want)
    for c in {c for _, c in want}:
        got = {r["vec_id"]: r for r in found if r["component"] == c}
        ids = [i for i, k in want if k == c]
        a, b = np.array([got[i]["whitened"] for i in ids]), np.array([want[i, c][1] for i in ids])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        for i in ids:
            assert (got[i]["deviation"], got[i]["n"]) == (want[i, c][0], want[i, c][3])
            assert got[i]["explained"] == pytest.approx(want[i, c][2], rel=1e-9)
            assert got[i]["identity_error"] < 1e-9


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
            if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    check(whitening.op11_whiten(spark, SMALL).collect(), plain(rows))


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(np.float32(c)) for c in np.random.default_rng(i).normal(size=3) * [5, 2, 1]]) for i in range(40)]
    rows = [(i, v, "s", 1, 2) for i, v in good] + [(i + 100, v, "s", 1, 2) for i, v in good[:7]]
    bad = [(900, None), (901, [1.0, None, 2.0]), (902, [nan, 1.0, 1.0]), (903, [inf, 1.0, 1.0]), (904, []), (905, [1.0]),
           (906, [1e38, 0.0, 0.0])]
    rows += [(i, v, None, None, None) for i, v in bad]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    check(found, plain(good + [(i + 100, v) for i, v in good[:7]]))
    # a null id and a repeated row stay; the list of distinct vectors does not change
    more = rows + [(None, good[0][1], None, None, None), (1, good[1][1], "s", 1, 2)]
    again = whitening.whiten(spark.createDataFrame(more, SCHEMA)).collect()
    assert len(again) == len(found) + 6 and {r["n"] for r in again} == {40}
    assert sum(r["vec_id"] is None for r in again) == 3


def test_without_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], None, None, None)] * 2, SCHEMA)).collect()
    assert len(one) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one} == {(1, 0, None, None)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.5], None, None, None) for i in range(9)], SCHEMA)
    found = whitening.whiten(line).collect()
    assert {r["component"] for r in found if r["whitened"] is None} == {2, 3}
    assert {r["explained"] for r in found if r["component"] > 1} == {0.0}
    assert max(r["identity_error"] for r in found) < 1e-12


def test_beyond_a_long():
    x = np.array([[1 << 30, 5], [3, -(1 << 31)], [1 << 20, 1]])
    total = [int(t) for t in x.sum(0)]
    for n in (3, 1 << 33):
        want = [sum((n * int(v) - t) ** 2 for v, t in zip(row, total)) for row in x]
        assert whitening.deviations(x, n, total) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("kind", ["plain", "graded", "equal", "low rank", "zeros", "clusters"])
def test_directions(kind):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(300, 20))
    if kind == "graded":
        a *= 10.0 ** -np.arange(20)
    if kind == "equal":
        a = np.repeat(np.eye(20) * 3, 4, 0)
    if kind == "low rank":
        a = a[:, :3] @ rng.normal(size=(3, 20))
    if kind == "zeros":
        a[:, 5:9] = 0
    if kind == "clusters":
        a = np.linalg.qr(a)[0] * np.array([5.0] * 3 + [5 - 1e-9] + [1.0] * 16) @ np.linalg.qr(rng.normal(size=(20, 20)))[0]
    values, rows = whitening.directions(np.linalg.qr(a, mode="r"))
    want = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.abs(values - want).max() < 1e-13 * want[0]
    if kind == "graded":
        assert np.abs(np.sqrt(values / want) - 1).max() < 1e-6
    kept = values[:4] > 1e-20 * values[0]
    assert np.abs(rows[kept] @ rows[kept].T - np.eye(kept.sum())).max() < 1e-10
    assert np.abs(rows[kept] @ a.T @ a - values[:4][kept, None] * rows[kept]).max() < 1e-9 * want[0]
