"""Churn classifiers behind one small interface.

A learner has ``fit(train) -> model`` and a model has ``transform(df)``, which adds
``prediction`` (0/1) and ``score`` (probability of class 1). Frames carry ``row_id``,
``label`` and ``features``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.learn.boosting import HistogramBoosting
from tidemart.learn.prep import with_stratified_fold
from tidemart.operators.neighbours import bagged_votes
from tidemart.session import checkpoint_ready, shared_dir, written


def servable(stage):
    """The fitted stage without its training summary, by way of the shared folder.

    Spark sends a summary to the tasks with its model, and with it the session, which cannot be
    sent once any query of the session has observed its rows.
    """
    if not getattr(stage, "hasSummary", False):
        return stage
    path = shared_dir(SparkSession.active(), "model")
    stage.write().save(path)
    return type(stage).load(path)


def _decided(df: DataFrame, score: Column) -> DataFrame:
    scored = df.withColumn("score", score)
    return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))


class SparkModel:
    """A fitted Spark ML stage; ``margin`` turns raw SVC margins into probabilities."""

    def __init__(self, stage, margin=None):
        self.stage, self.margin = stage, margin

    def transform(self, df: DataFrame) -> DataFrame:
        keep = df.columns
        out = self.stage.transform(df)
        if self.margin:
            out = self.margin.transform(
                out.select(*keep, F.slice(vector_to_array("rawPrediction"), 2, 1).alias("m"))
                .withColumn("margin", array_to_vector("m"))
            )
        p = vector_to_array("probability")[1]
        return _decided(out.select(*keep, p.alias("_p")), F.col("_p")).drop("_p")


class SparkLearner:
    def __init__(self, build: Callable):
        self.build = build

    def fit(self, train: DataFrame) -> SparkModel:
        checkpoint_ready(train.sparkSession)
        return SparkModel(servable(self.build(train).fit(train)))


def gradient_boosting(rounds: int = 1000, depth: int = 4, rate: float = 0.1,
                      rows: float = 0.8, cols: float = 0.8, gain: float = 0.0,
                      child: float = 1, l1: float = 0.0, l2: float = 1.0, seed: int = 42) -> HistogramBoosting:
    """Penalised boosted trees, stopped when the held-out tenth no longer improves."""
    return HistogramBoosting(rounds, depth, rate, rows, cols, gain, child, l1, l2, seed=seed)


def logistic(c: float = 1.0, penalty: str = "l2", rounds: int = 1000) -> SparkLearner:
    """Logistic regression; an inverse strength ``c`` on n rows is a penalty of 1 / (c n)."""
    return SparkLearner(lambda train: LogisticRegression(
        labelCol="label", maxIter=rounds, regParam=1.0 / (c * max(train.count(), 1)),
        elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False,
    ))


def decision_tree(depth: int = 5, criterion: str = "gini", leaf: int = 2, seed: int = 42
                  ) -> SparkLearner:
    return SparkLearner(lambda train: DecisionTreeClassifier(
        labelCol="label", maxDepth=depth, impurity=criterion, minInstancesPerNode=leaf, seed=seed,
    ))


def random_trees(trees: int = 100, depth: int = 10, criterion: str = "gini",
                 cols: str = "sqrt", leaf: int = 2, seed: int = 42) -> SparkLearner:
    """Bootstrap forest; stands in for extremely randomised trees."""
    return SparkLearner(lambda train: RandomForestClassifier(
        labelCol="label", numTrees=trees, maxDepth=depth, impurity=criterion,
        featureSubsetStrategy=cols, minInstancesPerNode=leaf, bootstrap=True, seed=seed,
    ))


class GaussianModel:
    def __init__(self, stats: dict[int, tuple[float, list[float], list[float]]]):
        self.stats = stats

    def _likelihood(self, label: int) -> Column:
        prior, means, variances = self.stats[label]
        flat = sum(math.log(2 * math.pi * v) for v in variances)
        centre = F.array(*[F.lit(m) for m in means])
        spread = F.array(*[F.lit(v) for v in variances])
        gaps = F.zip_with(vector_to_array("features"), centre, lambda x, m: (x - m) * (x - m))
        terms = F.zip_with(gaps, spread, lambda g, v: g / v)
        return F.lit(math.log(prior) - 0.5 * flat) - 0.5 * F.aggregate(
            terms, F.lit(0.0), lambda t, x: t + x
        )

    def transform(self, df: DataFrame) -> DataFrame:
        if len(self.stats) == 1:
            return _decided(df, F.lit(float(next(iter(self.stats)))))
        # The logistic of the log-odds, held away from overflow.
        odds = self._likelihood(1) - self._likelihood(0)
        return _decided(df, 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), odds)))))


class GaussianNaiveBayes:
    """Means and variances per class from one aggregate; ``smoothing`` times the largest
    feature variance is added to every variance."""

    def __init__(self, smoothing: float = 1e-9):
        self.smoothing = smoothing

    def fit(self, train: DataFrame) -> GaussianModel:
        dim = len(train.select(vector_to_array("features").alias("v")).first()["v"])
        flat = train.select("label", vector_to_array("features").alias("v")).select(
            "label", *[F.col("v")[i].alias(f"v{i}") for i in range(dim)]
        )
        measures = [F.count(F.lit(1)).alias("n")]
        for i in range(dim):
            measures += [F.avg(f"v{i}").alias(f"m{i}"), F.var_pop(f"v{i}").alias(f"s{i}")]
        rows = flat.groupBy("label").agg(*measures).collect()
        total = sum(r["n"] for r in rows)
        # Variance over all classes = mean of variances + variance of means.
        widest = 0.0
        for i in range(dim):
            centre = sum(r["n"] * r[f"m{i}"] for r in rows) / total
            widest = max(widest, sum(
                r["n"] * (r[f"s{i}"] + (r[f"m{i}"] - centre) ** 2) for r in rows
            ) / total)
        floor = max(self.smoothing * widest, 1e-300)
        return GaussianModel({
            int(r["label"]): (
                r["n"] / total, [r[f"m{i}"] for i in range(dim)],
                [r[f"s{i}"] + floor for i in range(dim)],
            )
            for r in rows
        })


class Projected:
    """A learner on the leading principal components."""

    def __init__(self, inner, components: int = 10):
        self.inner, self.components = inner, components

    def fit(self, train: DataFrame) -> ProjectedModel:
        width = len(train.select(vector_to_array("features").alias("v")).first()["v"])
        pca = PCA(
            k=min(self.components, width), inputCol="features", outputCol="components"
        ).fit(train)
        turned = pca.transform(train).drop("features").withColumnRenamed("components", "features")
        return ProjectedModel(pca, self.inner.fit(turned))


class ProjectedModel:
    def __init__(self, pca, inner):
        self.pca, self.inner = pca, inner

    def transform(self, df: DataFrame) -> DataFrame:
        turned = self.pca.transform(df).withColumnsRenamed(
            {"features": "original", "components": "features"}
        )
        return self.inner.transform(turned).drop("features").withColumnRenamed(
            "original", "features"
        )


def fourier_features(df: DataFrame, weights: np.ndarray, phases: np.ndarray) -> DataFrame:
    """Random cosine features whose dot products approximate an RBF kernel."""
    scale = math.sqrt(2.0 / len(phases))

    @F.pandas_udf("array<double>")
    def lift(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if len(batch):
                lifted = scale * np.cos(np.stack(batch.to_numpy()) @ weights.T + phases)
                yield pd.Series(list(lifted))
            else:
                yield batch

    lifted = array_to_vector(lift(vector_to_array("features")))
    return df.withColumn("original", F.col("features")).withColumn("features", lifted)


class KernelSVC:
    """Linear SVC over random Fourier features, with probabilities by Platt scaling."""

    def __init__(self, width: int = 256, c: float = 1.0, rounds: int = 100, seed: int = 42):
        self.width, self.c, self.rounds, self.seed = width, c, rounds, seed

    def fit(self, train: DataFrame) -> KernelModel:
        values = train.select(F.explode(vector_to_array("features")).alias("x"))
        variance = values.agg(F.var_pop("x").alias("v")).first()["v"] or 1.0
        dim = len(train.select(vector_to_array("features").alias("v")).first()["v"])
        rng = np.random.default_rng(self.seed)
        gamma = 1.0 / (dim * variance)
        weights = rng.normal(0.0, math.sqrt(2 * gamma), (self.width, dim))
        phases = rng.uniform(0.0, 2 * math.pi, self.width)
        lifted = fourier_features(train, weights, phases)
        svc = servable(LinearSVC(
            labelCol="label", maxIter=self.rounds,
            regParam=1.0 / (self.c * max(train.count(), 1)),
        ).fit(lifted))
        margins = svc.transform(lifted).select(
            "label", array_to_vector(F.slice(vector_to_array("rawPrediction"), 2, 1)).alias("margin")
        )
        platt = LogisticRegression(
            labelCol="label", featuresCol="margin", probabilityCol="probability",
            rawPredictionCol="plattRaw", predictionCol="plattPrediction",
        ).fit(margins)
        return KernelModel(SparkModel(svc, servable(platt)), weights, phases)


class KernelModel:
    def __init__(self, inner: SparkModel, weights: np.ndarray, phases: np.ndarray):
        self.inner, self.weights, self.phases = inner, weights, phases

    def transform(self, df: DataFrame) -> DataFrame:
        lifted = fourier_features(df, self.weights, self.phases)
        return self.inner.transform(lifted).drop("features").withColumnRenamed(
            "original", "features"
        )


class BaggedNeighbours:
    """k-nearest votes over bootstrap bags; the training rows are the model."""

    def __init__(self, k: int = 5, bags: int = 10, share: float = 1.0, weights: str = "uniform",
                 metric: str = "euclidean", seed: int = 42):
        self.k, self.bags, self.share, self.weights, self.seed = k, bags, share, weights, seed
        self.metric = metric

    def fit(self, train: DataFrame) -> NeighbourModel:
        rows = train.select(
            F.col("row_id").alias("id"), vector_to_array("features").alias("vec"), "label"
        )
        return NeighbourModel(self, rows)


class NeighbourModel:
    def __init__(self, how: BaggedNeighbours, rows: DataFrame):
        self.how, self.rows = how, rows

    def transform(self, df: DataFrame) -> DataFrame:
        how = self.how
        asked = df.select(F.col("row_id").alias("id"), vector_to_array("features").alias("vec"))
        votes = bagged_votes(
            asked, self.rows, how.k, how.bags, how.share, how.weights == "distance", how.metric, how.seed,
        )
        joined = df.join(votes.withColumnRenamed("id", "row_id"), "row_id", "left")
        return _decided(joined, F.col("votes")).drop("votes")


class Stacking:
    """Base learners scored out of fold feed a logistic regression.

    Fold models score their own fold and add columns in place, so no join is needed. With
    ``passthrough`` the meta learner also sees the original features.
    """

    def __init__(self, base: dict[str, object], c: float = 1.0, folds: int = 5,
                 passthrough: bool = False, seed: int = 42):
        self.base, self.c, self.folds = base, c, folds
        self.passthrough, self.seed = passthrough, seed

    def fit(self, train: DataFrame) -> StackingModel:
        rows = written(with_stratified_fold(train, self.folds, self.seed, "label", "row_id"), "stacking-folds")
        parts = None
        for fold in range(self.folds):
            rest, part = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
            part = _base_scores(part, {n: b.fit(rest) for n, b in self.base.items()})
            parts = part if parts is None else parts.unionByName(part)
        meta_rows = _meta(parts, list(self.base), self.passthrough)
        meta = logistic(self.c).fit(meta_rows)
        return StackingModel(
            {n: b.fit(train) for n, b in self.base.items()}, meta, self.passthrough
        )


def _base_scores(df: DataFrame, models: dict[str, object]) -> DataFrame:
    for name, model in models.items():
        df = model.transform(df).drop("prediction").withColumnRenamed("score", f"s_{name}")
    return df


def _meta(df: DataFrame, names: Sequence[str], passthrough: bool) -> DataFrame:
    inputs = [f"s_{n}" for n in names] + (["features"] if passthrough else [])
    return VectorAssembler(inputCols=inputs, outputCol="meta").transform(df).withColumnsRenamed(
        {"features": "original", "meta": "features"}
    )


class StackingModel:
    def __init__(self, models: dict[str, object], meta, passthrough: bool):
        self.models, self.meta, self.passthrough = models, meta, passthrough

    def transform(self, df: DataFrame) -> DataFrame:
        scored = _meta(_base_scores(df, self.models), list(self.models), self.passthrough)
        out = self.meta.transform(scored)
        return out.drop("features", *[f"s_{n}" for n in self.models]).withColumnRenamed(
            "original", "features"
        )
