import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemart.learn import towers
from tidemart.learn.towers import batch_sums, flat, initial, places, shaped

SIZES = {
    "c": {"codes": 5, "cats": 2, "nums": 3, "tokens": 4},
    "p": {"codes": 4, "cats": 1, "nums": 2, "tokens": 0},
}


def _rows(n=7, seed=1):
    rng = np.random.default_rng(seed)
    tokens = [rng.choice([1, 2, 3], size=k, replace=False).tolist() for k in (0, 1, 2, 3, 2, 1, 0)][:n]
    return pd.DataFrame({
        towers.LABEL: rng.uniform(1, 5, n), towers.WEIGHT: rng.integers(1, 4, n).astype(float),
        "c_cats": rng.integers(0, 5, (n, 2)).tolist(), "c_nums": rng.normal(size=(n, 3)).tolist(),
        "c_tokens": tokens, "c_shares": [[1 / len(t) for _ in t] for t in tokens],
        "p_cats": rng.integers(0, 4, (n, 1)).tolist(), "p_nums": rng.normal(size=(n, 2)).tolist(),
    })


def _params(seed=3):
    params = initial(SIZES, 3, 4, 4.0, seed)
    rng = np.random.default_rng(seed)
    return {k: v + rng.normal(0, 0.3, v.shape) for k, v in params.items()}


def _loss(params, frame):
    return batch_sums(params, frame, {k: np.zeros_like(v) for k, v in params.items()})


def test_gradient_equals_differences():
    frame, params = _rows(), _params()
    sums = {k: np.zeros_like(v) for k, v in params.items()}
    batch_sums(params, frame, sums)
    layout, vector, got = places(params), flat(params), flat(sums)
    for at in range(vector.size):
        up, down = vector.copy(), vector.copy()
        up[at] += 1e-6
        down[at] -= 1e-6
        slope = (_loss(shaped(up, layout), frame) - _loss(shaped(down, layout), frame)) / 2e-6
        assert got[at] == pytest.approx(slope, rel=1e-4, abs=1e-5)


def test_a_weight_counts_like_repeated_rows():
    frame, params = _rows(), _params()
    again = frame.loc[frame.index.repeat(frame[towers.WEIGHT].astype(int))].assign(
        **{towers.WEIGHT: 1.0})
    one = {k: np.zeros_like(v) for k, v in params.items()}
    two = {k: np.zeros_like(v) for k, v in params.items()}
    assert batch_sums(params, frame, one) == pytest.approx(batch_sums(params, again, two))
    np.testing.assert_allclose(flat(one), flat(two))


def test_spark_gradient_equals_one_batch(spark):
    frame, params = _rows(), _params()
    sums = {k: np.zeros_like(v) for k, v in params.items()}
    loss = batch_sums(params, frame, sums)
    rows = spark.createDataFrame(
        frame.values.tolist(), f"{towers.LABEL} double, {towers.WEIGHT} double, "
        "c_cats array<int>, c_nums array<double>, c_tokens array<int>, c_shares array<double>, "
        "p_cats array<int>, p_nums array<double>")
    for parts in (1, 3, 20):  # 20: some tasks have no rows
        got, lost, n = towers.gradient(rows.repartition(parts), params)
        np.testing.assert_allclose(got, flat(sums), atol=1e-9)
        assert lost == pytest.approx(loss) and n == len(frame)


def _world(spark, n=60):
    """Equal features everywhere: only the history tells who gives high scores."""
    people = spark.createDataFrame(
        [(f"u{i}", "x", 1.0, "a | a | b" if i % 2 else "b") for i in range(n)]
        + [("none", "x", 1.0, None), ("odd", "x", None, "never sold")],
        "customer_unique_id string, city string, spent double, purchase_category_history string")
    goods = spark.createDataFrame(
        [(i, "ab"[i % 2], 2.0) for i in range(6)] + [(6, None, None)],
        "product_key long, product_category_name string, price double")
    labels = spark.createDataFrame(
        [(f"u{i}", k, (4.0 if i % 2 else 1.0) + k % 2, 1 + k % 3) for i in range(n) for k in range(6)]
        + [("u0", 0, None, 1), ("ghost", 1, 5.0, 1)],
        "customer_unique_id string, product_key long, avg_review_score_by_user double, "
        "purchase_count long")
    return people, goods, labels


def test_history_decides(spark, tmp_path):
    people, goods, labels = _world(spark)
    model = towers.fit_towers(people, goods, labels, width=4, hidden=8, epochs=12, batches=3,
                              step=0.05, halve_after=6)
    assert model.losses[-1] < 0.2 * model.losses[0]
    asked = labels.select("customer_unique_id", "product_key", F.col("purchase_count").alias("_u0"))
    got = {(r[0], r[1]): r["prediction"] for r in model.predict(asked).collect()}
    assert ("ghost", 1) not in got and len(got) == 360
    assert got["u1", 0] > got["u0", 0] + 2 and got["u1", 1] > got["u0", 1] + 2
    odd = spark.createDataFrame(
        [("none", 0), ("odd", 0), ("none", 6)], "customer_unique_id string, product_key long")
    lost = {(r[0], r[1]): r["prediction"] for r in model.predict(odd).collect()}
    # No history, and one of unknown tokens only, both count as zeros.
    assert len(lost) == 3 and lost["none", 0] == pytest.approx(lost["odd", 0])
    model.save(str(tmp_path / "towers"))
    again = towers.TowerModel.load(spark, str(tmp_path / "towers"))
    same = {(r[0], r[1]): r["prediction"] for r in again.predict(asked).collect()}
    assert same == got
    assert all(np.array_equal(model.params[k], v) for k, v in again.params.items())


def test_no_labels(spark):
    people, goods, labels = _world(spark, 4)
    model = towers.fit_towers(people, goods, labels.limit(0), epochs=1, batches=2)
    assert model.losses == [0.0]
    assert model.predict(labels.select("customer_unique_id", "product_key")).count() == 25


def test_few_slots_share_vectors(spark):
    people, goods, labels = _world(spark, 8)
    model = towers.fit_towers(people, goods, labels, epochs=1, batches=1, slots=1)
    assert len(model.params["c.emb"]) == 1 and len(model.params["c.seq"]) == 2
    assert model.predict(labels).count() == 49


def test_histories_meet_their_vectors_as_one_product():
    """A batch holds each token once, and the rows' shares of it; rows without a history hold zeros."""
    frame = pd.DataFrame({
        "c_cats": [[0], [1], [0]], "c_nums": [[1.0], [2.0], [3.0]],
        "c_tokens": [[7, 2], [], [2]], "c_shares": [[0.25, 0.75], [], [1.0]],
    })
    got = towers._side(frame, "c")
    assert got["token"].tolist() == [2, 7]
    assert got["share"].tolist() == [[0.75, 0.25], [0.0, 0.0], [1.0, 0.0]]
    none = towers._side(frame.iloc[1:2], "c")
    assert none["share"].shape == (1, 0)
    params = towers.initial(
        {s: {"codes": 2, "cats": 1, "nums": 1, "tokens": 8} for s in "cp"}, 4, 5, 3.0, 1)
    assert np.isfinite(towers.forward(params, "c", none)[0]).all()
