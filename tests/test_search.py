"""Search with a Gaussian process."""

import math

import numpy as np
import pytest

from tidemart.learn import models, search

SPACE = {"a": ("real", 0.0, 1.0), "b": ("log", 0.001, 10.0), "c": ("int", 1, 30), "d": ("pick", ["x", "y", "z"])}


def surface(p):
    """Best at a = 0.7, b = 0.1, c = 12, d = y."""
    return (-4 * (p["a"] - 0.7) ** 2 - 0.3 * math.log10(p["b"] / 0.1) ** 2
            - ((p["c"] - 12) / 15) ** 2 - 0.5 * (p["d"] != "y"))


def best_of(seed, trials, guided):
    rng, tried = np.random.default_rng(seed), []
    for _ in range(trials):
        p = search.next_point(SPACE, tried, rng, 8) if guided else search.draw(SPACE, rng)
        tried.append((p, surface(p)))
    return max(v for _, v in tried), tried


def test_guided_beats_random_on_a_planted_surface():
    guided = [best_of(s, 35, True)[0] for s in range(6)]
    drawn = [best_of(s, 35, False)[0] for s in range(6)]
    assert np.median(guided) > 0.3 * np.median(drawn)  # the optimum is 0, the rest is negative
    assert sum(g > d for g, d in zip(guided, drawn)) >= 5


def test_points_stay_in_the_space_and_are_new():
    _, tried = best_of(3, 35, True)
    for i, (p, _) in enumerate(tried):
        assert 0 <= p["a"] <= 1 and 0.001 <= p["b"] <= 10 and 1 <= p["c"] <= 30 and p["d"] in "xyz"
        assert isinstance(p["c"], int) and p not in [q for q, _ in tried[:i]]
    assert tried == best_of(3, 35, True)[1]


def test_exhausted_and_flat_spaces():
    space, rng = {"k": ("int", 1, 3)}, np.random.default_rng(0)
    tried = []
    for _ in range(8):
        tried.append((search.next_point(space, tried, rng, 2), 0.5))
    assert {p["k"] for p, _ in tried} == {1, 2, 3}


def test_process_meets_its_points_and_the_plain_posterior():
    rng = np.random.default_rng(1)
    x = rng.random((20, 3))
    y = np.sin(3 * x[:, 0]) + x[:, 1]
    gp = search.GaussianProcess(x, y)
    mean, deviation = gp.predict(x)
    assert np.allclose(mean, y, atol=0.05)
    far = rng.random((5, 3)) + 40
    mean, deviation = gp.predict(far)
    assert np.allclose(mean, y.mean(), atol=1e-6) and np.allclose(deviation, y.std(), rtol=1e-6)
    draws = 0.3 + 0.5 * rng.normal(size=2_000_000)
    gain = search.expected_improvement(np.array([0.3]), np.array([0.5]), 0.4)[0]
    assert gain == pytest.approx(np.maximum(draws - 0.4, 0).mean(), rel=0.01)


def test_trials_run_on_prepared_folds(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    rows = [(i, int(a + 0.2 * n > 0), [float(a), float(b)]) for i, (a, b, n) in enumerate(rng.normal(size=(300, 3)))]
    data = spark.createDataFrame(rows, "row_id long, label int, v array<double>").select(
        "row_id", "label", array_to_vector("v").alias("features")).cache()
    folds = [search.Prepared(data.where(F.col("row_id") % 2 != f), data.where(F.col("row_id") % 2 == f), None)
             for f in range(2)]
    found = search.bayesian_search("tree", models.decision_tree, search.TREE_SPACE, 4, folds, start=2)
    assert len(found.trials) == 4 and all(len(t.scores) == 2 for t in found.trials)
    assert found.best.mean > 0.85 and len(found.rows()) == 8
