"""Scores from confusion counts, importances, and the table of runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "model string, trial int, fold int, params string, metric string, value double"


def confusion(scored: DataFrame, label: str = "label") -> DataFrame:
    """One row per (label, prediction) with its row count."""
    return scored.groupBy(
        F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_scores(scored: DataFrame, label: str = "label") -> dict[str, float]:
    """Accuracy and class-weighted F1, from one small table of counts."""
    cells = {(r["label"], r["prediction"]): r["n"] for r in confusion(scored, label).collect()}
    total = sum(cells.values())
    if not total:
        return {"accuracy": 0.0, "f1_weighted": 0.0}
    classes = {c for pair in cells for c in pair}
    f1 = 0.0
    for c in classes:
        hit = cells.get((c, c), 0)
        actual = sum(n for (a, _), n in cells.items() if a == c)
        guessed = sum(n for (_, p), n in cells.items() if p == c)
        if actual + guessed:
            f1 += actual / total * 2 * hit / (actual + guessed)
    return {
        "accuracy": sum(n for (a, p), n in cells.items() if a == p) / total, "f1_weighted": f1,
    }


def regression_errors(scored: DataFrame, label: str = "rating") -> DataFrame:
    """Global RMSE and MAE over all scored rows."""
    gap = F.col("prediction") - F.col(label)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
    )


def importance(spark: SparkSession, names: Sequence[str], weights: Sequence[float]) -> DataFrame:
    return spark.createDataFrame(
        sorted(((n, float(w)) for n, w in zip(names, weights)), key=lambda r: (-r[1], r[0])),
        "feature string, importance double",
    )


def run_log(spark: SparkSession, rows: Sequence[Mapping]) -> DataFrame:
    """Search and training results as rows of one table; one row per trial, fold and metric."""
    fields = ("model", "trial", "fold", "params", "metric", "value")
    return spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], RUNS)
