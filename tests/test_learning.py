import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemart.learn import balance, content_model, evaluate, models, prep, recommend, search
from tidemart.operators import relational
from tidemart.operators.numbering import dense_ids
from tidemart.session import written


def test_frequency_encoder(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    test = spark.createDataFrame([("a",), ("c",), (None,)], "v string")
    got = prep.FrequencyEncoder("v").fit(train).transform(test).collect()
    assert sorted(r["v"] for r in got) == [0.0, 0.0, pytest.approx(2 / 3)]


def test_feature_types(spark):
    df = spark.range(200).select(
        F.col("id").cast("string").alias("s"), (F.col("id") % 5).alias("few"),
        (F.col("id") % 40).alias("many"), (F.col("id") % 2).cast("double").alias("flag"),
    )
    assert prep.auto_feature_types(df, []) == {
        "s": "cat", "few": "cat", "many": "num", "flag": "num",
    }


def test_sequence_vocabulary(spark):
    goods = spark.createDataFrame([("b",), ("a",), ("a",)], "category string")
    codes = content_model.vocabulary([goods], "category")
    people = spark.createDataFrame(
        [("u", "a | x | b"), ("v", None)], "customer_unique_id string, h string"
    )
    got = {r[0]: r["tokens"] for r in content_model.sequence_codes(people, codes, "h").collect()}
    assert got == {"u": [1, 0, 2], "v": []}


def test_one_hot_of_an_unknown_value_is_all_zeros(spark):
    df = spark.createDataFrame([("a",), ("zzz",), (None,)], "most_used_payment_type string")
    cols = prep.one_hot("most_used_payment_type", ["a", "unknown"])
    got = [tuple(r) for r in df.select(*cols.values()).collect()]
    assert got == [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_interaction_terms(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    row = prep.interactions(df, ["a", "b"], 3).first().asDict()
    assert row["a_x_b"] == 6 and row["a_x_a"] == 4 and row["a_x_a_x_b"] == 12
    assert row["b_x_b_x_b"] == 27


def _two_classes(spark, n, m, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, 0, rng.normal(0, 1, 3).tolist()) for i in range(n)]
    rows += [(n + i, 1, rng.normal(2.5, 1, 3).tolist()) for i in range(m)]
    return spark.createDataFrame(rows, "row_id long, label int, v array<double>").select(
        "row_id", "label", array_to_vector("v").alias("features")
    )


def test_single_minority_row_is_repeated(spark):
    got = balance.balanced(_two_classes(spark, 6, 1), "label", "row_id")
    assert balance.class_counts(got, "label") == {0: 6, 1: 6}
    assert got.filter("label = 1").select("features").distinct().count() == 1


def test_synthetic_rows_balance_and_stay_inside(spark):
    assert balance.neighbour_count(4) == 3
    df = _two_classes(spark, 30, 4)
    got = written(balance.smote(df, "label", "row_id"), "smote")
    assert balance.class_counts(got, "label") == {0: 30, 1: 30}
    values = got.filter("label = 1").select("synthetic", vector_to_array("features").alias("v"))
    rows = values.collect()
    real = np.array([r["v"] for r in rows if not r["synthetic"]])
    made = np.array([r["v"] for r in rows if r["synthetic"]])
    assert len(made) == 26
    assert (made >= real.min(0) - 1e-9).all() and (made <= real.max(0) + 1e-9).all()
    assert got.select("row_id").distinct().count() == 60


def test_oversampling_is_exact(spark):
    df = _two_classes(spark, 50, 7)
    got = balance.random_oversample(df, "label", "row_id")
    assert balance.class_counts(got, "label") == {0: 50, 1: 50}


@pytest.mark.parametrize("learner", [
    models.GaussianNaiveBayes(), models.Projected(models.GaussianNaiveBayes(), 2),
    models.gradient_boosting(rounds=5), models.logistic(), models.KernelSVC(width=64, rounds=20),
    models.decision_tree(), models.random_trees(10), models.BaggedNeighbours(),
    models.BaggedNeighbours(weights="distance"),
], ids=lambda m: type(m).__name__)
def test_models_beat_the_majority(spark, learner):
    train = written(_two_classes(spark, 80, 60, 1), "train")
    test = written(_two_classes(spark, 40, 30, 2), "test")
    scored = learner.fit(train).transform(test)
    assert {"prediction", "score", "features"} <= set(scored.columns)
    assert scored.count() == 70
    scores = evaluate.classification_scores(scored)
    assert scores["accuracy"] > 0.85 and scores["f1_weighted"] > 0.85


def test_stacking(spark):
    train = written(_two_classes(spark, 80, 60, 1), "train")
    base = {"nb": models.GaussianNaiveBayes(), "tree": models.decision_tree(3)}
    for passthrough in (False, True):
        model = models.Stacking(base, folds=2, passthrough=passthrough).fit(train)
        scored = model.transform(_two_classes(spark, 40, 30, 2))
        assert evaluate.classification_scores(scored)["accuracy"] > 0.85


def test_naive_bayes_against_numpy(spark):
    df = written(_two_classes(spark, 30, 20, 4), "nb")
    rows = df.select("label", vector_to_array("features").alias("v")).collect()
    x, y = np.array([r["v"] for r in rows]), np.array([r["label"] for r in rows])
    stats = models.GaussianNaiveBayes(0.5).fit(df).stats
    for c in (0, 1):
        prior, mean, var = stats[c]
        assert prior == pytest.approx((y == c).mean())
        assert mean == pytest.approx(x[y == c].mean(0))
        assert var == pytest.approx(x[y == c].var(0) + 0.5 * x.var(0).max())


def test_scores_by_hand(spark):
    df = spark.createDataFrame(
        [(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0)], "label int, prediction double"
    )
    got = evaluate.classification_scores(df)
    assert got["accuracy"] == 0.75
    assert got["f1_weighted"] == pytest.approx(0.5 * (2 / 3) + 0.5 * 0.8)


def test_halving_keeps_a_third_and_ends_on_all_rows(spark):
    frame = written(_two_classes(spark, 60, 60, 3), "halving")
    fold = search.Prepared(frame, frame, None)
    grid = [{"smoothing": 10.0 ** -i} for i in range(9)]
    found = search.halving_search("nb", models.GaussianNaiveBayes, grid, [fold])
    rungs = [t.rung for t in found.trials]
    assert [rungs.count(r) for r in sorted(set(rungs))] == [9, 3, 1]
    assert found.best.rung == max(rungs) and found.best.mean > 0.8


def test_random_search_is_seeded():
    rng = [np.random.default_rng(1) for _ in range(2)]
    a, b = (search.draw(search.BOOSTING_SPACE, r) for r in rng)
    assert a == b and 3 <= a["depth"] <= 6 and 0.01 <= a["rate"] <= 0.2


def _rating_rows(spark, seed=1):
    rng = np.random.default_rng(seed)
    p, q = rng.normal(size=(20, 2)), rng.normal(size=(15, 2))
    rows = [
        (f"u{u}", i, float(np.clip(3 + p[u] @ q[i], 1, 5)))
        for u in range(20) for i in range(15) if rng.random() < 0.7
    ]
    return spark.createDataFrame(rows, "user string, item long, r double")


def test_dense_ids_have_no_gaps(spark):
    ids = dense_ids(spark.range(100).repartition(5), "id").collect()
    assert sorted(r["idx"] for r in ids) == list(range(100))


@pytest.mark.parametrize("fit", [recommend.fit_svd, recommend.fit_svdpp, recommend.fit_nmf])
def test_factor_models_beat_the_mean(spark, fit):
    train, test = recommend.rating_split(written(_rating_rows(spark), "ratings"))
    scored = fit(train, rank=4, rounds=10).predict(test)
    assert scored.count() == test.count()
    mean = train.agg(F.avg("r")).first()[0]
    errors = evaluate.regression_errors(scored, "r").first()
    base = evaluate.regression_errors(test.withColumn("prediction", F.lit(mean)), "r").first()
    assert errors["rmse"] < base["rmse"]


def test_top_k_per_user(spark):
    model = recommend.fit_nmf(written(_rating_rows(spark), "r"), rank=4, rounds=5)
    assert model.recommend(3).groupBy("user").count().filter("count <> 3").count() == 0
    two = spark.createDataFrame([("u1",), ("u2",)], "user string")
    assert {r["user"] for r in model.recommend(3, two).collect()} == {"u1", "u2"}


def test_repeated_rows_follow_weights(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, w int")
    got = {r["k"]: r["count"] for r in content_model.repeated(df, "w").groupBy("k").count().collect()}
    assert got == {"a": 1, "b": 3}
    hot = spark.createDataFrame([("a", 1), ("b", 10**5)], "k string, w int")
    assert content_model.repeated(hot, "w").count() == 10**5 + 1  # the weights are the real ones


def test_samples_splits_and_folds_are_independent(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    sample = relational.sample_fraction(df, 0.15, 42, "k")
    train, test = prep.split(sample, 0.8, 42, "k")
    n = sample.count()
    assert abs(train.count() / n - 0.8) < 0.03 and train.count() + test.count() == n
    folds = prep.with_fold(prep.split(df, 0.9, 42, "k")[0], 10, 42, "k").groupBy("fold").count().collect()
    assert len(folds) == 10 and all(1600 < r["count"] < 2000 for r in folds)
    held, rest = prep.stratified_split(train.withColumn("label", F.lit(1)), 0.1, 42, "label", "k")
    assert 0 < rest.count() < held.count()


@pytest.mark.parametrize("n", [0, 1, 7, 4321])
def test_stratified_folds_and_split_are_exact(spark, n):
    rows = [(i, ("a", "b", None)[0 if i % 10 < 6 else 1 if i % 10 < 9 else 2], i % 3) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, kind string, x long")
    sizes = {r["kind"]: r["count"] for r in df.groupBy("kind").count().collect()}
    folds = prep.with_stratified_fold(df.repartition(5), 5, 1, "kind", "k")
    assert sorted(r["k"] for r in folds.collect()) == list(range(n)) and folds.columns == [*df.columns, "fold"]
    for kind, size in sizes.items():
        held = [r["count"] for r in folds.where(F.col("kind").eqNullSafe(F.lit(kind))).groupBy("fold").count().collect()]
        assert sum(held) == size and max(held) - (min(held) if len(held) == 5 else 0) <= 1
    every = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert not every or max(every) - (min(every) if len(every) == 5 else 0) <= 1
    assert {r["k"]: r["fold"] for r in folds.collect()} == {r["k"]: r["fold"] for r in prep.with_stratified_fold(
        df.repartition(2), 5, 1, "kind", "k").collect()}
    main, held = prep.stratified_split(df, 0.1, 1, "kind", "k")
    taken = {r["kind"]: r["count"] for r in held.groupBy("kind").count().collect()}
    assert main.count() + held.count() == n
    assert all(taken.get(kind, 0) == math.floor(size * 0.1 + 0.5) for kind, size in sizes.items())


def test_churn_tuner_end_to_end(spark, small, tmp_path):
    from tidemart.learn.tuner import ChurnTuner
    from tidemart.plans.churn import churn_features

    df = written(search.row_identity(churn_features(small)), "tuner")
    train, test = prep.split(df, 0.8, 42, "customer_id")
    tuner = ChurnTuner(
        "tree", models.decision_tree, space=search.TREE_SPACE, trials=2, folds=2
    ).fit_discrete(train, test)
    log = tuner.evaluate_train_test()
    assert {"validation", "train", "test"} <= {r["params"] for r in log.collect()}
    assert tuner.confusion_matrix().agg(F.sum("n")).first()[0] == test.count()
    assert tuner.feature_importance().count() == len(tuner.data.prep.names)
    tuner.save(str(tmp_path / "model"))
    again = prep.ChurnPrep.load(spark, str(tmp_path / "model" / "prep"))
    assert again.params == tuner.data.prep.params


def test_rating_tuner_keeps_the_best(spark):
    from tidemart.learn.tuner import RatingTuner

    ratings = written(_rating_rows(spark), "rt")
    train, test = recommend.rating_split(ratings)
    grid = [{"rank": 1, "rounds": 1}, {"rank": 4, "rounds": 10}]
    tuner = RatingTuner("nmf", recommend.fit_nmf, grid).run(train, test, ratings)
    rmse = [s["rmse"] for s in tuner.scores]
    assert tuner.best == grid[rmse.index(min(rmse))] and tuner.log(spark).count() == 4


def test_recommender_grid_tries_every_model(spark, monkeypatch):
    from tidemart import registry_learning

    assert [(name, grid) for name, _, grid in registry_learning.RECOMMENDERS] == [
        ("svd", recommend.SVD_GRID), ("svdpp", recommend.SVDPP_GRID), ("nmf", recommend.NMF_GRID)]
    short = [(name, fit, [{"rank": r, "rounds": 1} for r in (2, 3)])
             for name, fit, _ in registry_learning.RECOMMENDERS]
    ratings = written(_rating_rows(spark), "grid")
    monkeypatch.setattr(registry_learning, "RECOMMENDERS", short)
    monkeypatch.setattr(registry_learning, "cf_pairs", lambda t: ratings)
    rows = registry_learning.recommender_grid(None).collect()
    assert sorted((r["model"], r["trial"]) for r in rows) == [
        (name, trial) for name in ("nmf", "svd", "svdpp") for trial in (0, 1)]
    assert all(0 < r["mae"] <= r["rmse"] for r in rows)


def test_content_model_equals_the_regressor_on_repeated_rows(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import FMRegressor

    people = spark.createDataFrame(
        [(f"u{i}", f"city{i % 3}" if i % 4 else None, float(i * i % 11), i, "a,b") for i in range(12)],
        "customer_unique_id string, city string, spent double, seen long, purchase_category_history string")
    goods = spark.createDataFrame(
        [(i, ("x", "y", None)[i % 3], i * 7 % 5 + 0.5) for i in range(9)], "product_key long, kind string, price double")
    labels = spark.createDataFrame(
        [(f"u{i}", j, float((i * j) % 5 + 1), (i + j) % 4) for i in range(11) for j in range(9) if (i + j) % 3],
        "customer_unique_id string, product_key long, avg_review_score_by_user double, purchase_count long")
    counted = content_model.repeated(labels, "purchase_count", "n")
    copied = content_model.repeated(labels, "purchase_count")
    assert counted.count() == labels.count() and counted.agg(F.sum("n")).first()[0] == copied.count()

    model = content_model.fit_content(people, goods, labels, factors=3, rounds=6)
    ready, machine = PipelineModel(model.stages.stages[:-1]), model.stages.stages[-1]
    want = FMRegressor(
        labelCol="avg_review_score_by_user", factorSize=3, maxIter=6, stepSize=0.05, seed=42,
    ).fit(ready.transform(model.rows(copied)))
    np.testing.assert_allclose(machine.factors.toArray(), want.factors.toArray(), rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(machine.linear.toArray(), want.linear.toArray(), rtol=1e-9, atol=1e-12)
    assert machine.intercept == pytest.approx(want.intercept, rel=1e-9)

    # u11 was not in the training rows; u99 is not known at all.
    asked = spark.createDataFrame(
        [("u1", 2, "q"), ("u11", 3, "q"), ("u11", 3, "q"), ("u99", 3, "q"), (None, 1, "q")],
        "customer_unique_id string, product_key long, note string")
    got = model.predict(asked)
    assert got.columns == [*asked.columns, "prediction"]
    plain = model.stages.transform(model.rows(asked)).select(*asked.columns, "prediction")
    order = ("customer_unique_id", "product_key")
    got, plain = ([tuple(r) for r in df.orderBy(*order).collect()] for df in (got, plain))
    assert [r[:-1] for r in got] == [r[:-1] for r in plain] and len(got) == 3
    np.testing.assert_allclose([r[-1] for r in got], [r[-1] for r in plain], rtol=1e-9)


def test_content_model_learns_and_reloads(spark, small, tmp_path):
    from tidemart.plans import content

    labels = written(content.satisfaction_labels(small), "labels")
    model = content_model.fit_content(
        written(content.customer_content_features(small), "people"),
        written(content.product_content_features(small), "goods"), labels, factors=4, rounds=5,
    )
    scored = model.predict(labels).orderBy("customer_unique_id", "product_key").limit(20)
    model.save(str(tmp_path / "content"))
    again = content_model.ContentModel.load(spark, str(tmp_path / "content"))
    same = again.predict(labels).orderBy("customer_unique_id", "product_key").limit(20)
    assert [r["prediction"] for r in scored.collect()] == [r["prediction"] for r in same.collect()]
