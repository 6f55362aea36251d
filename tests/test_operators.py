import datetime
import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tidemart.functions.scalars import hash_unit, whole_hours
from tidemart.operators import cooccurrence, history, neighbours, quality, quantiles, relational
from tidemart.plans import scoring
from tidemart.sources import requests
from tidemart.sources.tables import publish_mart, read_version, run_sql, write_version
from tidemart.session import shared_dir


def test_quantiles_match_numpy_for_many_sizes(spark):
    rng = random.Random(3)
    for n in (1, 2, 3, 10, 101, 5000):
        values = [float(rng.choice([rng.random(), 0.5, rng.randrange(5)])) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
        probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
        got = quantiles.exact_quantiles(df, {"x": probs})["x"]
        for p in probs:
            assert got[p] == pytest.approx(float(np.quantile(values, p))), (n, p)


def test_quantiles_narrow_large_columns(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 20)
    rng = random.Random(4)
    for values in (
        [rng.gauss(0, 1) for _ in range(4000)],
        [float(rng.randrange(3)) for _ in range(3000)],
        [1.0] * 500 + [rng.random() for _ in range(500)],
    ):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        probs = [0.0, 0.01, 0.333, 0.5, 0.75, 0.999, 1.0]
        got = quantiles.exact_quantiles(df, {"x": probs})["x"]
        for p in probs:
            assert got[p] == pytest.approx(float(np.quantile(values, p))), p


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert quantiles.medians(df, ["x"]) == {"x": None}


def test_latest_by(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 1, None)], "k int, s int, v string")
    got = sorted(relational.latest_by(df, ["k"], ["s"]).collect())
    assert [tuple(r) for r in got] == [(1, 3, "b"), (2, 1, None)]


def test_quality_rules(spark):
    child = spark.createDataFrame([(1,), (2,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    rows = {r["rule"]: r["failing_rows"] for r in quality.dq_key(parent, "p", "k").collect()}
    assert rows == {"not_null": 1, "unique": 1}
    row = quality.dq_relationships(child, parent, "c", "k", "k").first()
    assert row["failing_rows"] == 1


def test_gate_modes(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = {"positive": F.col("x") > 0}
    assert quality.quality_gate(df, rules, "warn").passed.count() == 3
    gate = quality.quality_gate(df, rules)
    assert gate.passed.count() == 1 and gate.quarantined.count() == 2
    with pytest.raises(PySparkException, match="quality gate: positive"):
        quality.quality_gate(df, rules, "fail").passed.collect()
    assert quality.quality_gate(df.filter("x = 1"), rules, "fail").passed.count() == 1


def _day(n):
    return datetime.date(2024, 1, n)


def test_scd2_late_change_splits_and_replay_is_a_no_op(spark):
    shape = "id string, city string, on date"
    first = spark.createDataFrame([("a", "x", _day(1)), ("a", "y", _day(10))], shape)
    late = spark.createDataFrame([("a", "z", _day(5))], shape)
    held = history.scd2_history(first, ["id"], ["city"], "on")
    merged = history.scd2_merge(held, late, ["id"], ["city"], "on")
    rows = sorted(tuple(r)[1:] for r in merged.collect())
    assert rows == [
        ("x", _day(1), _day(5), False), ("y", _day(10), None, True),
        ("z", _day(5), _day(10), False),
    ]
    again = history.scd2_merge(merged, late, ["id"], ["city"], "on")
    assert sorted(tuple(r)[1:] for r in again.collect()) == rows


def test_scd2_intervals_do_not_overlap(spark, small):
    from tidemart.registry_medallion import _SCD, _address_log

    rows = history.scd2_history(_address_log(small), *_SCD)
    current = rows.filter("is_current").groupBy("customer_unique_id").count()
    assert current.filter("count <> 1").count() == 0
    assert rows.filter("end_date <= start_date").count() == 0


def test_as_of_join_against_brute_force(spark):
    """Long and short histories, facts before the first version, on edges, in units far apart."""
    rng = np.random.default_rng(3)
    start = datetime.date(2019, 12, 20)
    versions, facts = [], []
    for k in ["hot", "long", "one", None, "none"]:
        days = sorted({int(d) for d in rng.integers(0, 900, {"long": 200, "hot": 12}.get(k, 1))})
        if k != "none":
            for i, (a, b) in enumerate(zip(days, [*days[1:], None])):
                end = None if b is None else start + datetime.timedelta(b)
                if k == "hot" and i == 5:
                    end = start + datetime.timedelta(a + 1)  # a gap after it
                versions.append((k, start + datetime.timedelta(a), end, f"{k}{i}"))
        for i in range(400 if k == "hot" else 60):
            facts.append((k, None if i == 7 else start + datetime.timedelta(int(rng.integers(-40, 1000))), len(facts)))
    got = history.as_of_join(
        spark.createDataFrame(facts, "k string, at date, n int"),
        spark.createDataFrame(versions, "k string, start_date date, end_date date, name string"),
        ["k"], "at", ["name"]).collect()
    want = {n: [v[3] for v in versions if k is not None and v[0] == k and at and v[1] <= at and (
        v[2] is None or at < v[2])] for k, at, n in facts}
    assert len(got) == len(facts)
    for r in got:
        assert [r["name"]] == (want[r["n"]] or [None]), r
    assert sum(bool(v) for v in want.values()) > 300


def test_two_moves_on_one_day_follow_their_sequence(spark):
    log = spark.createDataFrame(
        [("u", "Zell", "2020-01-01", 1), ("u", "Aalen", "2020-01-01", 2), ("u", "Bonn", "2020-02-01", 3)],
        "customer_unique_id string, city string, day string, seq int")
    rows = history.scd2_history(log, ["customer_unique_id"], ["city"], "day", ["seq"]).orderBy("start_date")
    assert [r["city"] for r in rows.collect()] == ["Aalen", "Bonn"]
    rows = history.scd2_history(log, ["customer_unique_id"], ["city"], "day").orderBy("start_date")
    assert [r["city"] for r in rows.collect()] == ["Zell", "Bonn"]


def test_scd1_replay_and_versions(spark):
    root = shared_dir(spark, "t")
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "id string, seq int, v string")
    held = batch.limit(0)
    for version in (1, 2):
        held = write_version(history.scd1_upsert(held, batch, ["id"], "seq"), root, version)
    assert [tuple(r) for r in held.collect()] == [("a", 2, "y")]
    assert read_version(spark, root, 1).count() == 1
    with pytest.raises(AnalysisException):
        write_version(batch, root, 2)


def _brute_slope_one(ratings, asked):
    out = {}
    by_user = {}
    for u, i, r in ratings:
        by_user.setdefault(u, {})[i] = r
    for u, i in asked:
        num = den = 0.0
        for j, rj in by_user.get(u, {}).items():
            if j == i:
                continue
            both = [v for v in by_user.values() if i in v and j in v]
            num += sum(v[i] - v[j] + rj for v in both)
            den += len(both)
        out[u, i] = (num, den)
    return out


def _ratings(seed, users=12, items=15):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        share = 0.9 if u < 3 else 0.3
        rows += [
            (f"u{u}", i, float(rng.randint(1, 5))) for i in range(items) if rng.random() < share
        ]
    return rows


@pytest.mark.parametrize("heavy", [2, 8, 1000])
def test_slope_one_is_the_same_for_busy_and_other_users(spark, heavy):
    rows = _ratings(5)
    asked = [(f"u{u}", i) for u in range(12) for i in range(0, 15, 2)]
    df = spark.createDataFrame(rows, "user string, item long, r double")
    pairs = spark.createDataFrame(asked, "user string, item long")
    got = cooccurrence.slope_one_sums(df, pairs, heavy).collect()
    want = _brute_slope_one(rows, asked)
    assert len(got) == len(asked)
    for r in got:
        num, den = want[r["user"], r["item"]]
        assert (r["den"] or 0) == den
        assert (r["num"] or 0.0) == pytest.approx(num)


def test_slope_one_deviations_by_hand(spark):
    rows = [("a", 1, 5.0), ("a", 2, 3.0), ("a", 3, 2.0), ("b", 1, 3.0), ("b", 2, 4.0),
            ("c", 2, 2.0), ("c", 3, 5.0)]
    df = spark.createDataFrame(rows, "user string, item long, r double")
    got = {(r[0], r[1]): (r[2], r[3]) for r in cooccurrence.item_deviations(df).collect()}
    assert got == {(1, 2): (0.5, 2), (1, 3): (3.0, 1), (2, 3): (-1.0, 2)}
    asked = spark.createDataFrame([("c", 1)], "user string, item long")
    row = cooccurrence.slope_one_sums(df, asked).first()
    assert row["num"] / row["den"] == pytest.approx((2 * 2.5 + 1 * 8.0) / 3)


@pytest.mark.parametrize("heavy,block", [(3, 4), (8, 1024), (1000, 1024)])
def test_nearest_items_is_the_same_for_busy_and_other_users(spark, heavy, block):
    rows = _ratings(9)
    df = spark.createDataFrame(rows, "user string, item long, r double")
    by_item = {}
    for u, i, r in rows:
        by_item.setdefault(i, {})[u] = r
    want = {}
    for i, a in by_item.items():
        cells = []
        for j, b in by_item.items():
            both = a.keys() & b.keys()
            if i != j and len(both) >= 2:
                msd = sum((a[u] - b[u]) ** 2 for u in both) / len(both)
                cells.append((-round(1 / (msd + 1), 9), j))
        want[i] = [(j, -s) for s, j in sorted(cells)[:4]]
    got = {}
    for r in cooccurrence.nearest_items(df, 4, 2, heavy, block).collect():
        got.setdefault(r["i"], []).append((r["j"], r["sim"]))
    for i, cells in want.items():
        assert sorted(got.get(i, []), key=lambda c: (-c[1], c[0])) == cells


def _points(spark, n, seed, dim=3):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).round(3)
    data[: n // 3] = data[0]  # a third of the rows are one and the same point
    return data, spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, vec array<double>"
    )


def _brute(asked, data, k, metric, others):
    gaps = neighbours.distances(asked[1], data, metric)
    if others:
        gaps[np.arange(len(asked[0])), asked[0]] = np.inf
    ids = np.arange(len(data))
    return {int(i): [(float(g[j]), int(j)) for j in np.lexsort((ids, g))[:k] if np.isfinite(g[j])]
            for i, g in zip(asked[0], gaps)}


def _found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["id"], []).append((r["d"], r["j"]))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("metric", neighbours.METRICS)
@pytest.mark.parametrize("n, block", [(3, 1024), (100, 1024), (100, 16), (5000, 256)])
def test_neighbours_equal_brute_force(spark, n, block, metric):
    data, df = _points(spark, n, n)
    want = _brute((np.arange(n), data), data, 4, metric, True)
    assert _found(neighbours.nearest(df, df, 4, metric, others=True, block=block)) == want


def test_neighbours_among_many_rows(spark):
    data, df = _points(spark, 50_000, 5, 4)
    queries = df.filter("id % 250 = 7")
    ids = np.arange(7, 50_000, 250)
    assert _found(neighbours.nearest(queries, df, 5)) == _brute((ids, data[ids]), data, 5, "euclidean", False)


def test_neighbours_prune_where_rows_form_clusters(spark):
    rng = np.random.default_rng(4)
    data = (rng.integers(0, 40, 4000)[:, None] * 100.0 + rng.normal(size=(4000, 3))).round(3)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, vec array<double>")
    want = _brute((np.arange(4000), data), data, 3, "manhattan", True)
    assert _found(neighbours.nearest(df, df, 3, "manhattan", others=True, block=64)) == want


@pytest.mark.parametrize("n, block, weighted, metric", [
    (40, 1024, False, "euclidean"), (700, 64, True, "manhattan"), (700, 1024, False, "euclidean")])
def test_bagged_votes_equal_brute_force(spark, n, block, weighted, metric):
    data, df = _points(spark, n, 9)
    label = (np.arange(n) % 3 == 0).astype(float)
    rows = df.join(spark.createDataFrame([(i, float(v)) for i, v in enumerate(label)], "id long, label double"), "id")
    queries = df.filter("id % 5 = 0")
    k, bags, share = 5, 6, 0.4
    found = {r["id"]: r["votes"] for r in neighbours.bagged_votes(
        queries, rows, k, bags, share, weighted, metric, block=block).collect()}
    gaps, ids = neighbours.distances(data, data, metric), np.arange(n)
    copies = neighbours._copies(ids, bags, share, 42)
    assert abs(copies.mean() - share) < 0.1
    for i in range(0, n, 5):
        votes = []
        for bag in range(bags):
            took, ones, total = 0, 0.0, 0.0
            for j in np.lexsort((ids, gaps[i])):
                use = min(copies[j, bag], k - took)
                weight = use / max(gaps[i, j], 1e-9) if weighted else use
                took, ones, total = took + use, ones + weight * label[j], total + weight
            votes.append(ones / total if total else 0.5)
        assert found[i] == pytest.approx(np.mean(votes), abs=1e-9)
    assert len(found) == len(range(0, n, 5))


def test_candidate_lists(spark):
    shape = "request_id string, customer_unique_id string, candidate_product_ids string"
    asked = spark.createDataFrame(
        [("ok", "u", "[1, 2]"), ("bad", "u", "oops"), ("none", "u", None), ("lost", "u", "[1, 99]"),
         ("who", "nobody", "[1]")], shape,
    )
    people = spark.createDataFrame([("u",)], "customer_unique_id string")
    goods = spark.createDataFrame([(1,), (2,)], "product_key long")
    got = scoring.score_candidates(
        asked, people, goods, lambda df: df.withColumn("prediction", F.col("product_key") * 1.0)
    ).collect()
    rows = sorted((r["request_id"], r["product_key"], r["rank"]) for r in got if r["rank"])
    assert rows == [("ok", 1, 2), ("ok", 2, 1)]
    assert sorted(r["request_id"] for r in got if r["rank"] is None) == ["lost", "who"]


def test_tensor_payload(spark):
    text = (
        '{"inputs":[{"name":"customer_tenure","shape":[1],"datatype":"INT64","data":[12]},'
        '{"name":"monetary_value","shape":[1],"datatype":"FP64","data":[500.5]},'
        '{"name":"most_used_payment_type","shape":[1],"datatype":"BYTES","data":["credit_card"]}]}'
    )
    df = spark.createDataFrame([(1, text), (2, "nonsense")], "id int, body string")
    rows = requests.json_requests(df, "body").orderBy("id").collect()
    assert len(rows[0]) == 26
    assert rows[0]["customer_tenure"] == 12 and rows[0]["monetary_value"] == 500.5
    assert rows[0]["most_used_payment_type"] == "credit_card" and rows[0]["avg_freight"] is None
    assert rows[1]["customer_tenure"] is None


def test_version_bookkeeping(spark):
    cur = spark.createDataFrame([("a", 3), ("b", 1), ("c", 1)], "name string, version int")
    old = spark.createDataFrame([("a", 2), ("b", 1)], "name string, version int")
    got = {r["name"]: r["last_version"] for r in scoring.scd_version_diff(cur, old).collect()}
    assert got == {"a": 2, "c": 0}
    state = scoring.state_upsert(old, cur.filter("name <> 'b'"))
    assert {tuple(r) for r in state.collect()} == {("a", 3), ("b", 1), ("c", 1)}


def test_hours_truncate_toward_zero(spark):
    row = spark.sql(
        "select timestamp '2024-01-01 00:00:00' a, timestamp '2024-01-01 01:59:59' b"
    ).select(whole_hours(F.col("a"), F.col("b")).alias("f"), whole_hours(F.col("b"), F.col("a")).alias("g"))
    assert tuple(row.first()) == (1, -1)


def test_hash_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumn("u", hash_unit("sample", 1, "id"))
    one = {r["id"]: r["u"] for r in df.coalesce(1).collect()}
    many = {r["id"]: r["u"] for r in df.repartition(7).collect()}
    assert one == many and 0.45 < sum(one.values()) / 1000 < 0.55


def test_sql_text_and_publish(spark):
    publish_mart(spark.range(5), "five", f"{shared_dir(spark, 'mart')}/five")
    assert run_sql(spark, "select count(*) as n from five where id >= :low", low=3).first()["n"] == 2


def test_broadcast_only_when_proven_small(spark):
    assert "broadcast" in relational.broadcast_if_small(spark.range(5))._jdf.queryExecution().analyzed().toString().lower()
    big = spark.range(10**9)
    assert "ResolvedHint" not in relational.broadcast_if_small(big)._jdf.queryExecution().analyzed().toString()


def test_neighbours_write_each_question_once(spark, monkeypatch):
    """What is kept between the rounds grows with the rows, not with rows times blocks."""
    rng = np.random.default_rng(3)
    data = rng.normal(size=(1500, 30))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, vec array<double>")
    rows, kept = {}, neighbours.written

    def counted(frame, label):
        out = kept(frame, label)
        rows[label] = out.count()
        return out

    monkeypatch.setattr(neighbours, "written", counted)
    want = _brute((np.arange(1500), data), data, 3, "euclidean", True)
    assert _found(neighbours.nearest(df, df, 3, others=True, block=50)) == want
    assert max(rows.values()) <= 3 * 1500


def test_neighbours_of_far_apart_values(spark):
    """Rough distances never leave out a neighbour, whatever the scale of the columns."""
    rng = np.random.default_rng(4)
    data = rng.integers(0, 3, (400, 12)) * 1e-6 + 1e9
    data[::7] = 1e200 * rng.normal(size=data[::7].shape)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, vec array<double>")
    assert _found(neighbours.nearest(df, df, 4, others=True, block=64)) == _found(
        neighbours.nearest(df, df, 4, others=True))


def test_neighbours_hold_a_tile_of_a_block_at_once():
    import pyarrow as pa
    import tracemalloc

    rng = np.random.default_rng(3)
    data, asked = rng.normal(size=(16384, 29)), rng.normal(size=(128, 29)) * 0.5

    def batch(asks, first, vectors, floor):
        n = len(vectors)
        zero = np.zeros(n, np.int32)
        return pa.RecordBatch.from_pydict({
            "cell": zero, "block": zero, "chunk": zero, "asks": pa.array([asks] * n),
            "id": np.arange(first, first + n), "floor": floor,
            "vec": pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * 29, vectors.ravel())})

    gaps = neighbours.distances(asked, data)
    want = np.sort(gaps, axis=1)[:, :4]
    for floor in (want[:, 3].copy(), np.full(len(asked), np.inf)):
        batches = [batch(False, 0, data, np.zeros(len(data))), batch(True, 10 ** 6, asked, floor)]
        tracemalloc.start()
        got = list(neighbours._answer(4, 29, "euclidean", True)(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        found = pa.Table.from_batches(got)
        assert (found.column("d").to_numpy().reshape(-1, 4) == want).all()
        assert peak < 20e6
