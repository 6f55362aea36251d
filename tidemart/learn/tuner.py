"""One object per training run: search or fit, evaluate, inspect, save."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.learn import evaluate, search
from tidemart.learn.prep import LABEL, stratified_split


class ChurnTuner:
    """Trains one kind of churn model.

    ``build`` makes a learner from parameters. With a ``grid`` the parameters come from
    successive halving, with a ``space`` from seeded random search, else they are ``params``.
    """

    def __init__(self, name: str, build: Callable, params: Mapping | None = None,
                 grid: Sequence[Mapping] | None = None, space: Mapping[str, tuple] | None = None,
                 trials: int = 25, folds: int = 5, seed: int = 42):
        self.name, self.build, self.params = name, build, dict(params or {})
        self.grid, self.space, self.trials = grid, space, trials
        self.folds, self.seed = folds, seed
        self.log: list[dict] = []

    def _search(self, train: DataFrame) -> None:
        if not (self.grid or self.space):
            return
        folds = search.prepare_folds(train, self.folds, self.seed, "customer_id")
        if self.grid:
            found = search.halving_search(self.name, self.build, self.grid, folds)
        else:
            found = search.random_search(
                self.name, self.build, self.space, self.trials, folds, self.seed
            )
        self.params = {**self.params, **found.best.params}
        self.log += found.rows()

    def fit(self, train: DataFrame, test: DataFrame) -> ChurnTuner:
        """Search, then fit on all training rows; frames need ``row_identity`` applied."""
        self._search(train)
        self.data = search.prepare(train, test, seed=self.seed)
        self.model = self.build(**self.params).fit(self.data.train)
        return self

    def fit_discrete(self, train: DataFrame, test: DataFrame, share: float = 0.1) -> ChurnTuner:
        """Fit on the main part only, leaving a stratified validation part aside."""
        main, held = stratified_split(train, share, self.seed, LABEL, "row_id")
        self.fit(main, test)
        ready = self.data.prep.transform(
            held.withColumn("label", F.col(LABEL).cast("int")), "row_id", "label"
        )
        self._record("validation", ready)
        return self

    def _record(self, part: str, frame: DataFrame) -> None:
        scores = evaluate.classification_scores(self.model.transform(frame))
        self.log += [
            {"model": self.name, "trial": -1, "fold": -1, "params": part, "metric": m,
             "value": float(v)}
            for m, v in scores.items()
        ]

    def evaluate_train_test(self) -> DataFrame:
        """The run log with accuracy and weighted F1 on train and test rows added."""
        self._record("train", self.data.train)
        self._record("test", self.data.test)
        return evaluate.run_log(self.data.test.sparkSession, self.log)

    def confusion_matrix(self) -> DataFrame:
        return evaluate.confusion(self.model.transform(self.data.test))

    def feature_importance(self) -> DataFrame:
        stage = getattr(self.model, "stage", None)
        if not hasattr(stage, "featureImportances"):
            raise TypeError(f"{self.name} has no feature importances")
        return evaluate.importance(
            self.data.test.sparkSession, self.data.prep.names, stage.featureImportances.toArray()
        )

    def save(self, path: str) -> None:
        """The preparation and, for Spark ML models, the fitted stage."""
        self.data.prep.save(self.data.test.sparkSession, f"{path}/prep")
        stage = getattr(self.model, "stage", None)
        if stage is None:
            raise TypeError(f"{self.name} cannot be saved as a Spark ML stage")
        stage.write().overwrite().save(f"{path}/stage")


class RatingTuner:
    """Tries each grid point of a rating model on held-out pairs and refits the best."""

    def __init__(self, name: str, fit: Callable, grid: Sequence[Mapping]):
        self.name, self.fit_model, self.grid = name, fit, grid

    def run(self, train: DataFrame, test: DataFrame, full: DataFrame) -> RatingTuner:
        self.scores = [
            evaluate.regression_errors(self.fit_model(train, **p).predict(test), "r").first()
            for p in self.grid
        ]
        best = min(range(len(self.grid)), key=lambda i: self.scores[i]["rmse"])
        self.best = dict(self.grid[best])
        self.model = self.fit_model(full, **self.best)
        return self

    def log(self, spark) -> DataFrame:
        return evaluate.run_log(spark, [
            {"model": self.name, "trial": i, "fold": 0, "params": str(p), "metric": m,
             "value": float(self.scores[i][m])}
            for i, p in enumerate(self.grid) for m in ("rmse", "mae")
        ])
