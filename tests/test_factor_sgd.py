import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemart.learn import factor_sgd
from tidemart.learn.factor_sgd import fit_sgd, fit_svdpp_sgd
from tidemart.session import few_at_once, written


def _ratings(spark, n=25, seed=5):
    """User 0 has rated every item and item 0 is rated by all: hot ends."""
    rng = np.random.default_rng(seed)
    rows = {(f"u{u}", f"i{i}") for u in range(n) for i in rng.integers(0, 12, 4)}
    rows |= {("u0", f"i{i}") for i in range(12)} | {(f"u{u}", "i0") for u in range(n)}
    return [(u, i, float(1 + (int(u[1:]) + 2 * int(i[1:])) % 5)) for u, i in sorted(rows)]


def _plain(rated, start, order, mean, rounds, step, reg, implicit):
    """Sequential descent: one loop over all ratings in the given order of cells."""
    p, q = start["p"], start["q"]
    rank = len(next(iter(p.values())))
    bu, bi = dict.fromkeys(p, 0.0), dict.fromkeys(q, 0.0)
    y = {i: np.zeros(rank) for i in q}
    z, late = {u: np.zeros(rank) for u in p}, {u: np.zeros(rank) for u in p}
    n = {u: sum(1 for a, _, _ in rated if a == u) for u in p}
    for _ in range(rounds):
        zs, errors = {u: np.zeros(rank) for u in p}, {u: np.zeros(rank) for u in p}
        for cell in order:
            for u in sorted({a for a, _, _ in cell}):
                mine = sorted((i, r) for a, i, r in cell if a == u)
                for i, r in mine:
                    x = p[u] + z[u] / math.sqrt(n[u])
                    e = r - mean - bu[u] - bi[i] - q[i] @ x
                    bu[u] += step * (e - reg * bu[u])
                    bi[i] += step * (e - reg * bi[i])
                    errors[u] += e * q[i]
                    p[u], q[i] = p[u] + step * (e * q[i] - reg * p[u]), q[i] + step * (e * x - reg * q[i])
                for i, _ in mine if implicit else ():
                    y[i] = y[i] * (1 - step * reg) ** n[u] + step * late[u] / math.sqrt(n[u])
                    zs[u] += y[i]
        z, late = zs, errors
    final = {u: sum((y[i] for a, i, _ in rated if a == u), np.zeros(rank)) for u in p}
    return bu, bi, {u: p[u] + final[u] / math.sqrt(n[u]) for u in p}, q


@pytest.mark.parametrize("implicit,blocks", [(True, 3), (True, 1), (False, 2)])
def test_equals_sequential_descent(spark, monkeypatch, implicit, blocks):
    named = _ratings(spark)
    frame = written(spark.createDataFrame(named, "user string, item string, r double"), "sgd")
    numbers = {}
    plain_ids = factor_sgd.dense_ids

    def watched(df, col):
        numbers[col] = written(plain_ids(df, col), "watched")
        return numbers[col]

    monkeypatch.setattr(factor_sgd, "dense_ids", watched)
    rank, rounds, step, reg = 3, 4, 0.05, 0.02
    model = fit_sgd(frame, rank, rounds, step, reg, implicit, seed=9, blocks=blocks)
    users = {r["user"]: r["idx"] for r in numbers["user"].collect()}
    items = {r["item"]: r["idx"] for r in numbers["item"].collect()}
    rated = [(users[u], items[i], r) for u, i, r in named]

    def starts(kind, ids):
        df = spark.createDataFrame([(k,) for k in ids], "id int")
        rows = df.select("id", factor_sgd._uniform(9, kind, rank).alias("v"),
                         factor_sgd.block_of("id", kind, blocks).alias("b")).collect()
        return {r["id"]: np.array(r["v"]) for r in rows}, {r["id"]: r["b"] for r in rows}

    (p, ub), (q, ib) = starts("u", users.values()), starts("i", items.values())
    order = []
    for s in range(blocks):
        for b in reversed(range(blocks)):  # any order within a stratum gives the same
            order.append([x for x in rated if ub[x[0]] == b and ib[x[1]] == (b + s) % blocks])
    assert sum(map(len, order)) == len(rated)
    mean = sum(r for _, _, r in rated) / len(rated)
    bu, bi, pu, qi = _plain(rated, {"p": p, "q": q}, order, mean, rounds, step, reg, implicit)
    got_users = {users[r["user"]]: r for r in model.users.collect()}
    got_items = {items[r["item"]]: r for r in model.items.collect()}
    assert set(got_users) == set(bu) and set(got_items) == set(bi)
    for u, row in got_users.items():
        assert row["_bu"] == pytest.approx(bu[u], abs=1e-9)
        np.testing.assert_allclose(row["_p"], pu[u], atol=1e-9)
    for i, row in got_items.items():
        assert row["_bi"] == pytest.approx(bi[i], abs=1e-9)
        np.testing.assert_allclose(row["_q"], qi[i], atol=1e-9)


def test_waves_keep_the_order_of_every_user_and_item():
    rng = np.random.default_rng(4)
    users, items = np.divmod(np.sort(rng.permutation(60 * 80)[:3000]), 80)
    dealt = factor_sgd.waves(users, items)
    assert sorted(np.concatenate(dealt).tolist()) == list(range(3000)) and len(dealt) < 1000
    wave = np.empty(3000, int)
    for number, some in enumerate(dealt):
        wave[some] = number
        assert len(set(users[some])) == len(set(items[some])) == len(some)
    for ends in (users, items):
        for one in set(ends):
            assert (np.diff(wave[ends == one]) > 0).all()
    assert factor_sgd.waves(users[:0], items[:0]) == []


def test_rows_with_lists_come_in_small_batches(spark):
    rows = few_at_once(spark.range(3000, numPartitions=1).select(F.array("id").alias("x")))
    sizes = rows.mapInPandas(lambda fs: (pd.DataFrame({"n": [len(f)]}) for f in fs), "n long").collect()
    assert max(r["n"] for r in sizes) <= 512 and sum(r["n"] for r in sizes) == 3000


def test_learns_and_knows_strangers(spark):
    frame = written(spark.createDataFrame(_ratings(spark), "user string, item string, r double")
                    .withColumn("r", F.when(F.col("item") < "i3", 5.0).otherwise(1.0)), "sgd")
    model = fit_svdpp_sgd(frame, rank=2, rounds=10, step=0.05, blocks=2)
    gap = model.predict(frame).agg(F.sqrt(F.avg((F.col("prediction") - F.col("r")) ** 2))).first()[0]
    assert gap < 0.5
    odd = spark.createDataFrame([("u1", "new"), ("new", "i1"), (None, None)], "user string, item string")
    got = {(r["user"], r["item"]): r["prediction"] for r in model.predict(odd).collect()}
    assert got[None, None] == pytest.approx(model.mean) and got["new", "i1"] > 3.5


def test_empty_null_and_repeated(spark):
    empty = spark.createDataFrame([], "user string, item string, r double")
    model = fit_svdpp_sgd(empty, rank=2, rounds=1)
    pair = spark.createDataFrame([("a", "b")], "user string, item string")
    assert [r["prediction"] for r in model.predict(pair).collect()] == [1.0]  # clipped to the scale
    rows = [("a", "b", 4.0), ("a", "b", 4.0), ("a", None, 1.0), (None, "b", 1.0), ("a", "c", None)]
    some = spark.createDataFrame(rows, "user string, item string, r double")
    model = fit_svdpp_sgd(some, rank=2, rounds=2)
    assert model.users.count() == 1 and model.items.count() == 1 and model.mean == 4.0
