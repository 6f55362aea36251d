"""Fitted models score rows in a session that has observed others."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemart.learn import models


@pytest.fixture(scope="module")
def rows(spark):
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    return spark.createDataFrame(
        [(i, int(i % 10 > 5), Vectors.dense([float(i % 10), float(i % 7)])) for i in range(200)],
        ["row_id", "label", "features"])


@pytest.mark.parametrize("learner", [
    models.logistic(rounds=20), models.random_trees(5, 3), models.KernelSVC(16, rounds=5),
    models.decision_tree(3),
], ids=["logistic", "random_trees", "kernel_svc", "decision_tree"])
def test_scores_after_an_observation(rows, learner):
    found = learner.fit(rows).transform(rows).select("row_id", "label", "prediction", "score").collect()
    assert len(found) == 200 and all(0.0 <= r["score"] <= 1.0 for r in found)
    assert sum(r["label"] == r["prediction"] for r in found) > 150


@pytest.mark.parametrize("learner", [models.logistic(rounds=20), models.random_trees(5, 3)])
def test_the_model_without_its_summary_scores_alike(rows, learner):
    full = models.SparkModel(learner.build(rows).fit(rows)).stage
    lean = models.servable(full)
    assert not lean.hasSummary
    probe = [r["features"] for r in rows.select("features").distinct().collect()]
    assert [full.predictProbability(x) for x in probe] == [lean.predictProbability(x) for x in probe]
