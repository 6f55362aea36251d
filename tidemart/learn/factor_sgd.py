"""SVD and SVD++ by stochastic gradient descent over strata of blocks.

Users and items are dealt to ``blocks`` blocks each. Stratum s of an epoch holds the cells
(user block b, item block b + s): no two of them share a user or an item, so they run side by side
and an epoch equals a sequential one that goes through the cells in any order within a stratum.
A cell lies in one task, its ratings in order of user and item; those that share neither, and wait
for no earlier one, are taken side by side as arrays (``waves``), which changes no result.

The history of a user is the sum of the vectors ``y`` of the items rated, over the root of their
number. Those items lie in many cells, so two sums are one epoch late: an epoch scores with the
history as its cells left it in the epoch before, and moves ``y`` by the user's errors of the
epoch before. ``y`` starts at zero. A model scores with the history of its final vectors.

One user or item may hold a third of all ratings: its ratings spread over all cells of its row or
column, and ``blocks`` grows with the ratings, so that no cell holds more than about ``cell`` of
them. Ratings with a null take no part; of a repeated pair each row counts, in order of the rating.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.learn.recommend import SEED, clipped
from tidemart.operators.numbering import dense_ids
from tidemart.operators.relational import broadcast_if_small
from tidemart.session import few_at_once, shared_dir, written

CELL = 2_000_000
# Step length and penalty of the two models.
SVD_STEP, SVDPP_STEP, PENALTY = 0.005, 0.007, 0.02
# Users carry p, the history in use, the one being summed, this and the last epoch's errors; items
# carry q and y.
_USER, _ITEM = ("p", "z", "z_next", "err", "err_last"), ("q", "y")
_VECTORS = (*_USER, *_ITEM)
_STATE = "kind string, block int, id int, n long, bias double, " + ", ".join(
    f"{v} array<double>" for v in _VECTORS)


def waves(users: np.ndarray, items: np.ndarray) -> list[np.ndarray]:
    """The ratings dealt to waves in which no user and no item occurs twice, each rating after all
    earlier ones of its user and of its item: going wave by wave equals going one by one."""
    last_u, last_i = [-1] * (int(users.max(initial=-1)) + 1), [-1] * (int(items.max(initial=-1)) + 1)
    wave = []
    for u, i in zip(users.tolist(), items.tolist()):
        at = (last_u[u] if last_u[u] > last_i[i] else last_i[i]) + 1
        last_u[u] = last_i[i] = at
        wave.append(at)
    wave = np.array(wave, np.int64)
    order = np.argsort(wave, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(wave[order])) + 1) if len(order) else []


def descend(user: dict, item: dict, rated_by: np.ndarray, rated: np.ndarray, rating: np.ndarray,
            mean: float, step: float, penalty: float, implicit: bool) -> None:
    """The ratings of a cell in order of user and item; ``user`` and ``item`` hold the states as
    arrays, ``rated_by`` and ``rated`` the places in them."""
    root = 1 / np.sqrt(user["n"])
    history = user["z"] * root[:, None]
    # As many steps of the penalty as the user has ratings, and their errors, for every item once.
    shrink = ((1 - step * penalty) ** user["n"])[:, None]
    move = step * root[:, None] * user["err_last"]
    for wave in waves(rated_by, rated):
        u, i = rated_by[wave], rated[wave]
        p, q = user["p"][u], item["q"][i]
        whole = p + history[u]
        bu, bi = user["bias"][u], item["bias"][i]
        gap = rating[wave] - (mean + bu + bi + (q * whole).sum(axis=1))
        user["bias"][u] = bu + step * (gap - penalty * bu)
        item["bias"][i] = bi + step * (gap - penalty * bi)
        gap = gap[:, None]
        user["p"][u] = p + step * (gap * q - penalty * p)
        item["q"][i] = q + step * (gap * whole - penalty * q)
        user["err"][u] += gap * q
        if implicit:
            y = item["y"][i] * shrink[u] + move[u]
            item["y"][i] = y
            user["z_next"][u] += y


def turn(user: dict) -> None:
    """End of an epoch: what was summed comes into use."""
    user["z"], user["err_last"] = user["z_next"], user["err"]
    user["z_next"], user["err"] = np.zeros_like(user["z"]), np.zeros_like(user["err"])


def _uniform(seed: int, kind: str, rank: int) -> Column:
    """Numbers of deviation 0.1 fixed by the id."""
    spread = 0.1 * math.sqrt(12)
    return F.transform(F.sequence(F.lit(1), F.lit(rank)), lambda k: (
        F.pmod(F.xxhash64(F.lit(f"{kind}{seed}"), "id", k), F.lit(1 << 24)) / (1 << 24) - 0.5
    ) * spread)


def _start(counts: DataFrame, kind: str, rank: int, blocks: int, seed: int) -> DataFrame:
    """States of users or items from (id, n)."""
    zero = F.array_repeat(F.lit(0.0), rank)
    mine = _USER if kind == "u" else _ITEM
    vectors = [
        (_uniform(seed, kind, rank) if v in ("p", "q") else zero) if v in mine
        else F.lit(None).cast("array<double>") for v in _VECTORS
    ]
    return counts.select(
        F.lit(kind).alias("kind"), block_of("id", kind, blocks).alias("block"), "id", "n",
        F.lit(0.0).alias("bias"), *[c.alias(v) for v, c in zip(_VECTORS, vectors)],
    )


def block_of(col: str, kind: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(kind), col), F.lit(blocks)).cast("int")


def _rows(kind: str, state: dict) -> pa.Table:
    """States as rows; the vectors that this kind does not have are null."""
    n = len(state["id"])
    columns = {"kind": pa.array([kind] * n, pa.string()), "block": pa.array(state["block"], pa.int32()),
               "id": pa.array(state["id"], pa.int32()), "n": pa.array(state["n"], pa.int64()),
               "bias": pa.array(state["bias"], pa.float64())}
    for v in _VECTORS:
        kind_of = pa.list_(pa.float64())
        if v in state:
            ends = np.arange(n + 1, dtype=np.int32) * np.int32(state[v].shape[1])
            columns[v] = pa.ListArray.from_arrays(ends, state[v].ravel(), type=kind_of)
        else:
            columns[v] = pa.nulls(n, kind_of)
    return pa.table(columns)


def _cell(mean: float, step: float, penalty: float, implicit: bool, last: bool):
    """The task of a cell: states and ratings in, states out."""

    def run(table: pa.Table) -> pa.Table:
        states = {}
        for kind, mine in (("u", _USER), ("i", _ITEM)):
            part = table.filter(pc.equal(table["kind"], kind)).sort_by("id")
            states[kind] = {c: part[c].to_numpy().copy() for c in ("block", "id", "n", "bias")}
            for v in mine:
                numbers = pc.list_flatten(part[v].combine_chunks())
                states[kind][v] = numbers.to_numpy().copy().reshape(len(part), -1 if len(part) else 0)
        user, item = states["u"], states["i"]
        rated = table.filter(pc.equal(table["kind"], "r")).sort_by(
            [(c, "ascending") for c in ("id", "item", "r")])
        descend(user, item, np.searchsorted(user["id"], rated["id"].to_numpy()),
                np.searchsorted(item["id"], rated["item"].to_numpy()), rated["r"].to_numpy(),
                mean, step, penalty, implicit)
        if last:
            turn(user)
        return pa.concat_tables([_rows(kind, state) for kind, state in states.items()])

    return run


class SgdModel:
    """Offsets and vectors of users and items; a user's vector includes the history."""

    def __init__(self, mean: float, users: DataFrame, items: DataFrame):
        self.mean, self.users, self.items = mean, users, items

    def predict(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (user, item, …) with ``prediction``; an unknown end adds nothing."""
        keep = [F.col(c) for c in pairs.columns]
        rows = pairs.join(self.users, "user", "left").join(self.items, "item", "left")
        product = F.aggregate(F.zip_with("_p", "_q", lambda a, b: a * b), F.lit(0.0),
                              lambda t, x: t + x)
        zero = F.lit(0.0)
        return rows.select(*keep, clipped(
            F.lit(self.mean) + F.coalesce("_bu", zero) + F.coalesce("_bi", zero)
            + F.coalesce(product, zero)).alias("prediction"))


def fit_sgd(ratings: DataFrame, rank: int, rounds: int = 20, step: float = SVDPP_STEP,
            reg: float = PENALTY, implicit: bool = True, seed: int = SEED,
            blocks: int | None = None, cell: int = CELL) -> SgdModel:
    """Fit on (user, item, r); ``implicit`` adds the history (SVD++)."""
    spark = ratings.sparkSession
    given = written(ratings.select("user", "item", F.col("r").cast("double")).na.drop(), "ratings")
    size = given.agg(F.avg("r").alias("mean"), F.count(F.lit(1)).alias("n")).first()
    mean = size["mean"] or 0.0
    blocks = blocks or max(2, math.ceil(size["n"] / cell))
    names = {c: written(dense_ids(given, c), f"{c}-ids") for c in ("user", "item")}
    coded = given
    for col, kind in (("user", "u"), ("item", "i")):
        coded = coded.join(
            broadcast_if_small(names[col].withColumnRenamed("idx", kind)), col).drop(col)
    path = shared_dir(spark, "sgd-ratings")
    rated = coded.select(
        F.col("u").alias("id"), F.col("i").alias("item"), "r",
        block_of("u", "u", blocks).alias("block"),
        F.pmod(block_of("i", "i", blocks) - block_of("u", "u", blocks), F.lit(blocks))
        .cast("int").alias("stratum"),
    )
    rated.write.partitionBy("stratum").parquet(path)
    rated = spark.read.schema(rated.schema).parquet(path)
    state = None
    for col, kind in (("id", "u"), ("item", "i")):
        counts = rated.groupBy(F.col(col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        one = _start(counts, kind, rank, blocks, seed)
        state = one if state is None else state.unionByName(one)
    state = written(state, "sgd-state")
    for number in range(rounds):
        for stratum in range(blocks):
            here = rated.filter(F.col("stratum") == stratum).select(
                F.lit("r").alias("kind"), "block", "id", "item", "r")
            # An item's cell is named by the user block it meets.
            meets = F.when(F.col("kind") == "i", F.pmod(F.col("block") - stratum, F.lit(blocks)))
            cells = state.withColumn("cell", F.coalesce(meets, "block")).unionByName(
                here.withColumn("cell", F.col("block")), allowMissingColumns=True)
            state = written(few_at_once(cells).groupBy("cell").applyInArrow(
                _cell(mean, step, reg, implicit, stratum == blocks - 1), _STATE), "sgd-state")
    return _model(rated, state, names, mean, implicit)


def _model(rated: DataFrame, state: DataFrame, names: dict, mean: float, implicit: bool) -> SgdModel:
    items = state.filter("kind = 'i'")
    users = state.filter("kind = 'u'").select("id", "n", "bias", "p")
    vector = F.col("p")
    if implicit:
        rank = (items.select(F.size("y")).first() or [0])[0]
        y = items.select(F.col("id").alias("item"), "y")
        sums = rated.join(broadcast_if_small(y), "item").groupBy("id").agg(
            F.array(*[F.sum(F.col("y")[k]) for k in range(rank)]).alias("z"))
        users = users.join(sums, "id")
        vector = F.zip_with("p", "z", lambda a, b: a + b / F.sqrt("n"))
    told = users.join(names["user"].withColumnRenamed("idx", "id"), "id").select(
        "user", F.col("bias").alias("_bu"), vector.alias("_p"))
    sold = items.join(names["item"].withColumnRenamed("idx", "id"), "id").select(
        "item", F.col("bias").alias("_bi"), F.col("q").alias("_q"))
    return SgdModel(mean, written(told, "sgd-users"), written(sold, "sgd-items"))


def fit_svd_sgd(ratings: DataFrame, rank: int = 50, rounds: int = 20, **given) -> SgdModel:
    return fit_sgd(ratings, rank, rounds, **{"step": SVD_STEP, "implicit": False, **given})


def fit_svdpp_sgd(ratings: DataFrame, rank: int = 20, rounds: int = 20, **given) -> SgdModel:
    return fit_sgd(ratings, rank, rounds, **given)
