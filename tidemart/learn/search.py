"""Fold preparation, successive halving, random search and search with a Gaussian process."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import hash_unit
from tidemart.learn.balance import balanced
from tidemart.learn.evaluate import classification_scores
from tidemart.learn.prep import LABEL, ChurnPrep, with_stratified_fold
from tidemart.session import written


def row_identity(df: DataFrame) -> DataFrame:
    """Add a long ``row_id`` from the content of the row."""
    return df.withColumn("row_id", F.xxhash64(*df.columns))


@dataclass
class Prepared:
    """A prepared training frame (balanced) and test frame, both written once."""

    train: DataFrame
    test: DataFrame
    prep: ChurnPrep


def prepare(train: DataFrame, test: DataFrame, k: int = 5, seed: int = 42) -> Prepared:
    """Fit the preparation on the training rows alone and balance those rows only."""
    prep = ChurnPrep().fit(train)

    def ready(df: DataFrame) -> DataFrame:
        return prep.transform(
            df.withColumn("label", F.col(LABEL).cast("int")), "row_id", "label"
        )

    even = balanced(written(ready(train), "prepared"), "label", "row_id", k, seed)
    return Prepared(written(even, "train"), written(ready(test), "test"), prep)


def prepare_folds(df: DataFrame, folds: int, seed: int, *keys: str) -> list[Prepared]:
    """Every fold prepared once; all candidates of a search then share them."""
    rows = written(with_stratified_fold(df, folds, seed, LABEL, *keys), "folds")
    def fold(f: int) -> Prepared:
        return prepare(
            rows.filter(F.col("fold") != f).drop("fold"),
            rows.filter(F.col("fold") == f).drop("fold"), seed=seed,
        )

    with ThreadPoolExecutor(folds) as pool:
        return list(pool.map(fold, range(folds)))


@dataclass
class Trial:
    params: dict
    scores: list[float]
    rung: int = 0

    @property
    def mean(self) -> float:
        return sum(self.scores) / len(self.scores)


@dataclass
class Search:
    """All trials of a search, best first."""

    model: str
    trials: list[Trial] = field(default_factory=list)

    @property
    def best(self) -> Trial:
        return max(self.trials, key=lambda t: (t.rung, t.mean))

    def rows(self) -> list[dict]:
        return [
            {"model": self.model, "trial": i, "fold": f, "params": json.dumps(t.params),
             "metric": "f1_weighted", "value": float(s)}
            for i, t in enumerate(self.trials) for f, s in enumerate(t.scores)
        ]


def _score(build: Callable, params: Mapping, folds: Sequence[Prepared], share: float = 1.0,
           seed: int = 42) -> list[float]:
    scores = []
    for fold in folds:
        train = fold.train
        if share < 1.0:
            train = train.filter(hash_unit("rung", seed, "row_id") < share)
        scored = build(**params).fit(train).transform(fold.test)
        scores.append(classification_scores(scored)["f1_weighted"])
    return scores


def halving_search(model: str, build: Callable, grid: Sequence[Mapping],
                   folds: Sequence[Prepared], factor: int = 3, parallel: int = 4) -> Search:
    """Successive halving: every rung multiplies the rows and keeps the best part.

    The last rung sees all rows. Rows of a rung are chosen by hash, so rungs are nested.
    """
    rungs = max(1, math.ceil(math.log(len(grid), factor)) + 1) if len(grid) > 1 else 1
    alive, search = [dict(g) for g in grid], Search(model)
    with ThreadPoolExecutor(parallel) as pool:
        for rung in range(rungs):
            share = float(factor) ** (rung - rungs + 1)
            tried = list(pool.map(lambda p, s=share: Trial(p, _score(build, p, folds, s)), alive))
            for trial in tried:
                trial.rung = rung
            search.trials += tried
            tried.sort(key=lambda t: -t.mean)
            alive = [t.params for t in tried[: max(1, math.ceil(len(tried) / factor))]]
    return search


def draw(space: Mapping[str, tuple], rng: np.random.Generator) -> dict:
    """One point: ('int', a, b), ('real', a, b), ('log', a, b) or ('pick', [values])."""
    point = {}
    for name, (kind, *args) in space.items():
        if kind == "int":
            point[name] = int(rng.integers(args[0], args[1] + 1))
        elif kind == "real":
            point[name] = float(rng.uniform(*args))
        elif kind == "log":
            point[name] = float(math.exp(rng.uniform(math.log(args[0]), math.log(args[1]))))
        else:
            point[name] = args[0][int(rng.integers(len(args[0])))]
    return point


def random_search(model: str, build: Callable, space: Mapping[str, tuple], trials: int,
                  folds: Sequence[Prepared], seed: int = 42, parallel: int = 4) -> Search:
    """Seeded random search; trials share the prepared folds and run side by side."""
    rng = np.random.default_rng(seed)
    points = [draw(space, rng) for _ in range(trials)]
    with ThreadPoolExecutor(parallel) as pool:
        tried = list(pool.map(lambda p: Trial(p, _score(build, p, folds)), points))
    return Search(model, tried)


def encoded(space: Mapping[str, tuple], point: Mapping) -> np.ndarray:
    """A point in the unit cube: ranges scaled, logarithms where drawn so, a choice as its indicators."""
    out: list[float] = []
    for name, (kind, *args) in space.items():
        if kind == "pick":
            out += [float(point[name] == v) / math.sqrt(2) for v in args[0]]
            continue
        low, high, at = float(args[0]), float(args[1]), float(point[name])
        if kind == "log":
            low, high, at = math.log(low), math.log(high), math.log(at)
        out.append((at - low) / (high - low) if high > low else 0.0)
    return np.array(out)


class GaussianProcess:
    """Matern 5/2 over standardised scores; scale and noise are those of largest likelihood."""

    SCALES = (0.1, 0.2, 0.4, 0.8, 1.6)
    NOISES = (1e-6, 1e-3, 1e-1)

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.centre, self.spread = x, float(y.mean()), float(y.std()) or 1.0
        z, best = (y - self.centre) / self.spread, -np.inf
        for scale in self.SCALES:
            for noise in self.NOISES:
                low = np.linalg.cholesky(self._kernel(x, x, scale) + noise * np.eye(len(x)))
                half = np.linalg.solve(low, z)
                likelihood = -0.5 * half @ half - np.log(np.diag(low)).sum()
                if likelihood > best:
                    best, self.scale, self.low, self.half = likelihood, scale, low, half

    @staticmethod
    def _kernel(a: np.ndarray, b: np.ndarray, scale: float) -> np.ndarray:
        d = math.sqrt(5) * np.sqrt(np.maximum(((a[:, None] - b[None]) ** 2).sum(2), 0.0)) / scale
        return (1 + d + d * d / 3) * np.exp(-d)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and standard deviation of the score at the rows of ``x``."""
        solved = np.linalg.solve(self.low, self._kernel(self.x, x, self.scale))
        variance = np.maximum(1.0 - (solved * solved).sum(0), 1e-12)
        return self.centre + self.spread * (solved.T @ self.half), self.spread * np.sqrt(variance)


def expected_improvement(mean: np.ndarray, deviation: np.ndarray, best: float) -> np.ndarray:
    z = (mean - best) / deviation
    density = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    below = 0.5 * (1 + np.array([math.erf(v / math.sqrt(2)) for v in z]))
    return (mean - best) * below + deviation * density


def next_point(space: Mapping[str, tuple], tried: Sequence[tuple[dict, float]], rng: np.random.Generator,
               start: int, offered: int = 512) -> dict:
    """The drawn point of largest expected improvement; the first ``start`` points are random.

    Half of the offered points are drawn at large, half change one parameter of the best point. A
    point tried before is offered only when the space holds no other.
    """
    if len(tried) < start:
        return draw(space, rng)
    best, value = max(tried, key=lambda t: t[1])
    points = [draw(space, rng) for _ in range(offered)]
    names = list(space)
    for i in range(offered // 2):
        name = names[i % len(names)]
        points[i] = {**best, name: points[i][name]}
    seen = [p for p, _ in tried]
    points = [p for p in points if p not in seen] or points
    model = GaussianProcess(np.stack([encoded(space, p) for p in seen]), np.array([v for _, v in tried]))
    gain = expected_improvement(*model.predict(np.stack([encoded(space, p) for p in points])), value)
    return points[int(np.argmax(gain))]


def bayesian_search(model: str, build: Callable, space: Mapping[str, tuple], trials: int,
                    folds: Sequence[Prepared], seed: int = 42, start: int = 8) -> Search:
    """Sequential search: every trial learns from all before it; its folds run side by side."""
    rng, search = np.random.default_rng(seed), Search(model)
    with ThreadPoolExecutor(len(folds)) as pool:
        for _ in range(trials):
            point = next_point(space, [(t.params, t.mean) for t in search.trials], rng, start)
            scores = pool.map(lambda fold, p=point: _score(build, p, [fold])[0], folds)
            search.trials.append(Trial(point, list(scores)))
    return search


# Search grids, spaces and trial counts.
NB_GRID = [{"smoothing": 10.0 ** -i} for i in range(10)]
PCA_NB_GRID = [
    {"components": c, "smoothing": 10.0 ** -i} for c in range(10, 20, 2) for i in range(10)
]
LOGISTIC_GRID = [
    {"penalty": p, "c": c} for p in ("l1", "l2")
    for c in (0.01, 0.05, 0.1, 0.5, 1, 2, 5, 10, 15, 20, 50, 70, 100)
]
BOOSTING_SPACE = {
    "depth": ("int", 3, 6), "rate": ("log", 0.01, 0.2), "rows": ("real", 0.6, 0.9),
    "cols": ("real", 0.6, 0.9), "gain": ("real", 0.0, 5.0), "child": ("int", 1, 10),
    "l1": ("log", 0.01, 10.0), "l2": ("log", 0.01, 10.0),
}
TREE_SPACE = {
    "criterion": ("pick", ["gini", "entropy"]), "leaf": ("int", 2, 35), "depth": ("int", 3, 20),
}
FOREST_SPACE = {
    "trees": ("int", 50, 300), "criterion": ("pick", ["gini", "entropy"]),
    "cols": ("pick", ["sqrt", "log2", "all"]), "leaf": ("int", 2, 15),
}
STACKING_SPACE = {
    "components": ("int", 10, 20), "c": ("log", 0.01, 10.0), "passthrough": ("pick", [True, False]),
    "trees": ("int", 80, 200), "forest_depth": ("int", 5, 15), "leaf": ("int", 2, 10),
    "rounds": ("int", 80, 200), "depth": ("int", 3, 5), "rate": ("log", 0.01, 0.2),
    "rows": ("real", 0.6, 0.9), "cols": ("real", 0.6, 0.9), "gain": ("real", 0.0, 5.0),
}
NEIGHBOUR_SPACE = {
    "bags": ("int", 10, 50), "share": ("real", 0.6, 1.0), "k": ("int", 3, 15),
    "weights": ("pick", ["uniform", "distance"]), "metric": ("pick", ["euclidean", "manhattan"]),
}
TRIALS = {"boosting": 25, "tree": 50, "forest": 35, "stacking": 5, "neighbours": 5}
