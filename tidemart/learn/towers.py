"""Two-tower rating model: a score is the product of a customer's and a product's vector.

A tower joins the vectors of its categories with its numbers (one layer); the customer's tower adds
the masked mean of the vectors of its history's tokens. One hidden layer gives the vector. All
vectors are learned by Adam on the weighted squared error. A step is one Spark job: tasks read
their rows of the batch in Arrow batches and send sums of gradients per parameter, which Spark
adds. The driver holds the parameters alone; ``slots`` bounds them, whatever the data: codes above
it share vectors.

Labels with a null anywhere take no part. A customer without known tokens has a history of
zeros. Training rows whose customer or product is unknown are left out, and so are such pairs of a
prediction. Equal labels count as often as they are given.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import hash_unit
from tidemart.learn.content_model import (
    CUSTOMER_KEY, HISTORY, PRODUCT_KEY, entity_table, sequence_codes, vocabulary,
)
from tidemart.operators.numbering import dense_ids
from tidemart.operators.relational import broadcast_if_small
from tidemart.session import few_at_once, shared_dir, written

LABEL, WEIGHT = "avg_review_score_by_user", "purchase_count"
SLOTS = 1 << 15
LOSS, ROWS = -1, -2  # places of the loss and of the row count among the gradient's sums


def initial(sizes: dict, width: int, hidden: int, mean: float, seed: int) -> dict[str, np.ndarray]:
    """Parameters by name: Xavier for layers, deviation 0.01 for vectors.

    The offsets of both outputs start where their product is the mean label.
    """
    rng = np.random.default_rng(seed)

    def layer(rows, cols):
        bound = np.sqrt(6.0 / (rows + cols)) if rows else 0.0
        return rng.uniform(-bound, bound, (rows, cols))

    out = {}
    for side in ("c", "p"):
        size = sizes[side]
        out[f"{side}.emb"] = rng.normal(0, 0.01, (size["codes"], width))
        if size["tokens"]:
            out[f"{side}.seq"] = rng.normal(0, 0.01, (size["tokens"], width))
        parts = size["cats"] + 1 + bool(size["tokens"])
        out[f"{side}.num_w"], out[f"{side}.num_b"] = layer(size["nums"], width), np.zeros(width)
        out[f"{side}.hid_w"], out[f"{side}.hid_b"] = layer(parts * width, hidden), np.zeros(hidden)
        out[f"{side}.out_w"] = layer(hidden, width)
        out[f"{side}.out_b"] = np.full(width, np.sqrt(max(mean, 0.0) / width))
    return out


def places(params: dict[str, np.ndarray]) -> dict[str, tuple[int, tuple[int, ...]]]:
    """Where each parameter starts in the flat vector, with its shape."""
    found, at = {}, 0
    for name, value in params.items():
        found[name] = (at, value.shape)
        at += value.size
    return found


def flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for v in params.values()])


def shaped(vector: np.ndarray, layout) -> dict[str, np.ndarray]:
    """Views of the flat vector by name."""
    return {
        n: vector[at:at + int(np.prod(shape))].reshape(shape) for n, (at, shape) in layout.items()
    }


def _side(frame: pd.DataFrame, side: str) -> dict[str, np.ndarray]:
    """The arrays of one tower in a batch; histories as shares by row and token of the batch."""
    n = len(frame)
    got = {
        "cats": np.array(frame[f"{side}_cats"].tolist(), dtype=np.int64).reshape(n, -1),
        "nums": np.array(frame[f"{side}_nums"].tolist(), dtype=float).reshape(n, -1),
    }
    if f"{side}_tokens" in frame:
        lists = frame[f"{side}_tokens"]
        owner = np.repeat(np.arange(n), lists.map(len).to_numpy(dtype=np.int64))
        none = np.zeros(0)
        got["token"], place = np.unique(
            np.concatenate([none, *lists]).astype(np.int64), return_inverse=True)
        wide = len(got["token"])
        got["share"] = np.bincount(
            owner * wide + place, np.concatenate([none, *frame[f"{side}_shares"]]), n * wide,
        ).reshape(n, wide)
    return got


def forward(p: dict, side: str, x: dict) -> tuple[np.ndarray, dict]:
    """A tower's vectors, and what its gradient needs."""
    n = len(x["nums"])
    parts = [p[f"{side}.emb"][x["cats"]].reshape(n, -1)]
    if "token" in x:
        parts.append(x["share"] @ p[f"{side}.seq"][x["token"]])
    number = x["nums"] @ p[f"{side}.num_w"] + p[f"{side}.num_b"]
    joined = np.concatenate([*parts, np.maximum(number, 0)], axis=1)
    hidden = joined @ p[f"{side}.hid_w"] + p[f"{side}.hid_b"]
    active = np.maximum(hidden, 0)
    return active @ p[f"{side}.out_w"] + p[f"{side}.out_b"], {
        "number": number, "joined": joined, "hidden": hidden, "active": active,
    }


def backward(p: dict, side: str, x: dict, kept: dict, up: np.ndarray, sums: dict) -> None:
    """Add a tower's gradients to ``sums``, given those of its vectors."""
    width = up.shape[1]
    sums[f"{side}.out_w"] += kept["active"].T @ up
    sums[f"{side}.out_b"] += up.sum(axis=0)
    hidden = (up @ p[f"{side}.out_w"].T) * (kept["hidden"] > 0)
    sums[f"{side}.hid_w"] += kept["joined"].T @ hidden
    sums[f"{side}.hid_b"] += hidden.sum(axis=0)
    joined = hidden @ p[f"{side}.hid_w"].T
    number = joined[:, -width:] * (kept["number"] > 0)
    sums[f"{side}.num_w"] += x["nums"].T @ number
    sums[f"{side}.num_b"] += number.sum(axis=0)
    wide = x["cats"].shape[1] * width
    np.add.at(sums[f"{side}.emb"], x["cats"].ravel(), joined[:, :wide].reshape(-1, width))
    if "token" in x:
        mean = joined[:, wide:wide + width]
        sums[f"{side}.seq"][x["token"]] += x["share"].T @ mean


def batch_sums(p: dict, frame: pd.DataFrame, sums: dict) -> float:
    """Add a batch's gradients of the weighted squared error to ``sums``; returns that error."""
    sides = {s: _side(frame, s) for s in ("c", "p")}
    (u, ku), (v, kv) = forward(p, "c", sides["c"]), forward(p, "p", sides["p"])
    gap = (u * v).sum(axis=1) - frame[LABEL].to_numpy(dtype=float)
    weight = frame[WEIGHT].to_numpy(dtype=float)
    slope = (2 * weight * gap)[:, None]
    backward(p, "c", sides["c"], ku, slope * v, sums)
    backward(p, "p", sides["p"], kv, slope * u, sums)
    return float((weight * gap * gap).sum())


def gradient(rows: DataFrame, params: dict[str, np.ndarray]) -> tuple[np.ndarray, float, int]:
    """(sum of gradients, sum of weighted squared errors, rows) over a frame of encoded rows."""
    layout = places(params)
    shared = rows.sparkSession.sparkContext.broadcast(flat(params))

    def sums_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shaped(shared.value, layout)
        total, loss, n = np.zeros(shared.value.size), 0.0, 0
        for frame in frames:
            loss += batch_sums(p, frame, shaped(total, layout))
            n += len(frame)
        at = np.flatnonzero(total)
        yield pd.DataFrame({
            "at": np.concatenate([[LOSS, ROWS], at]).astype(np.int32),
            "g": np.concatenate([[loss, n], total[at]]),
        })

    got = few_at_once(rows).mapInPandas(sums_of, "at int, g double").groupBy("at").agg(
        F.sum("g").alias("g")).toPandas()
    shared.destroy()
    total = np.zeros(sum(v.size for v in params.values()))
    inner = got[got["at"] >= 0]
    total[inner["at"]] = inner["g"]
    extra = dict(zip(got["at"], got["g"]))
    return total, extra.get(LOSS, 0.0), int(extra.get(ROWS, 0))


def _coded(table: DataFrame, cols: Sequence[str], slots: int) -> tuple[DataFrame, int]:
    """``table`` with ``cats``, the codes of its categorical columns, and how many codes there are."""
    named = {c: F.concat(F.lit(f"{c}="), F.col(c)) for c in cols}
    if not cols:
        return table.withColumn("cats", F.array().cast("array<int>")), 0
    values = table.select(F.explode(F.array(*named.values())).alias("value"))
    codes = written(dense_ids(values, "value"), "codes")
    coded = table
    for number, value in enumerate(named.values()):
        one = codes.select(F.col("value").alias(f"_v{number}"), F.col("idx").alias(f"_c{number}"))
        coded = coded.withColumn(f"_v{number}", value).join(
            broadcast_if_small(one), f"_v{number}", "left")
    cats = F.array(*[F.pmod(f"_c{n}", F.lit(slots)).cast("int") for n in range(len(cols))])
    return coded.withColumn("cats", cats), min(codes.count(), slots)


def _shares(tokens: Column) -> Column:
    """(token, share) of the known tokens: the mean needs how often each occurs, not where."""
    known = F.filter(tokens, lambda t: t != 0)
    return F.transform(F.array_distinct(known), lambda t: F.struct(
        t.alias("token"),
        (F.size(F.filter(known, lambda x: x == t)) / F.size(known)).alias("share"),
    ))


def encoded(features: DataFrame, key: str, side: str, slots: int = SLOTS,
            history: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """Features of one side as arrays, one row per key, and the sizes of its parameters.

    Keys are not repeated. ``history`` holds the names of the tokens that count.
    """
    skip = [HISTORY] if history is not None else []
    table, kinds = entity_table(features, key, skip)
    cats = [c for c, k in kinds.items() if k == "cat"]
    nums = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c, k in kinds.items() if k == "num"]
    table, codes = _coded(table, cats, slots)
    cols = [
        F.col("cats").alias(f"{side}_cats"),
        (F.array(*nums) if nums else F.array().cast("array<double>")).alias(f"{side}_nums"),
    ]
    tokens = 0
    if history is not None:
        names = vocabulary([history], history.columns[0])
        lists = sequence_codes(table.select(key, HISTORY), names, key=key).select(
            key, _shares(F.transform("tokens", lambda t: F.when(
                t > 0, F.pmod(t - 1, F.lit(slots)) + 1).otherwise(0))).alias("_seen"))
        table = table.join(lists, key)
        cols += [F.col("_seen.token").alias(f"{side}_tokens"),
                 F.col("_seen.share").alias(f"{side}_shares")]
        tokens = min(names.count() + 1, slots) + 1  # the missing mark's code follows the last
    sizes = {"codes": codes, "cats": len(cats), "nums": len(nums), "tokens": tokens}
    return written(table.select(key, *cols), f"{side}-encoded"), sizes


def _vectors(table: DataFrame, key: str, side: str, params: dict[str, np.ndarray]) -> DataFrame:
    layout = places(params)
    shared = table.sparkSession.sparkContext.broadcast(flat(params))

    def out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shaped(shared.value, layout)
        for frame in frames:
            yield pd.DataFrame({
                key: frame[key], "vector": list(forward(p, side, _side(frame, side))[0]),
            })

    return few_at_once(table).mapInPandas(out, f"{key} {dict(table.dtypes)[key]}, vector array<double>")


class TowerModel:
    """Vectors of all customers and products, the parameters they come from, errors by epoch."""

    def __init__(self, customers: DataFrame, products: DataFrame,
                 params: dict[str, np.ndarray], losses: list[float]):
        self.customers, self.products = customers, products
        self.params, self.losses = params, losses

    def predict(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``prediction``; pairs with an unknown end drop out."""
        keep = [F.col(c) for c in pairs.columns]
        rows = pairs.join(self.customers.withColumnRenamed("vector", "_u"), CUSTOMER_KEY).join(
            self.products.withColumnRenamed("vector", "_v"), PRODUCT_KEY)
        product = F.aggregate(F.zip_with("_u", "_v", lambda a, b: a * b), F.lit(0.0),
                              lambda t, x: t + x)
        return rows.select(*keep, product.alias("prediction"))

    def save(self, path: str) -> None:
        self.customers.write.mode("overwrite").parquet(f"{path}/customers")
        self.products.write.mode("overwrite").parquet(f"{path}/products")
        rows = [(n, list(v.shape), v.ravel().tolist()) for n, v in self.params.items()]
        self.customers.sparkSession.createDataFrame(
            rows, "name string, shape array<int>, numbers array<double>"
        ).write.mode("overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, spark, path: str) -> TowerModel:
        """The saved model; its parameters are no larger than the slots allow."""
        rows = spark.read.parquet(f"{path}/params").collect()
        params = {r["name"]: np.array(r["numbers"]).reshape(r["shape"]) for r in rows}
        return cls(spark.read.parquet(f"{path}/customers"), spark.read.parquet(f"{path}/products"),
                   params, [])


def fit_towers(customers: DataFrame, products: DataFrame, labels: DataFrame, width: int = 16,
               hidden: int = 32, epochs: int = 10, batches: int = 8, step: float = 0.01,
               halve_after: int = 3, slots: int = SLOTS, seed: int = 42,
               tokens: str = "product_category_name") -> TowerModel:
    """Fit on labels (customer, product, avg_review_score_by_user, purchase_count).

    ``batches`` splits the rows by a hash of their keys; an epoch takes one step on each. The step
    length is halved after every ``halve_after`` epochs.
    """
    spark = labels.sparkSession
    known = products.select(tokens).filter(F.col(tokens).isNotNull())
    people, size_c = encoded(customers, CUSTOMER_KEY, "c", slots, known)
    goods, size_p = encoded(products, PRODUCT_KEY, "p", slots)
    given = labels.select(CUSTOMER_KEY, PRODUCT_KEY, LABEL, WEIGHT).na.drop()
    batch = F.floor(hash_unit("tower batch", seed, CUSTOMER_KEY, PRODUCT_KEY) * batches).cast("int")
    path = shared_dir(spark, "tower-rows")
    joined = given.join(people, CUSTOMER_KEY).join(goods, PRODUCT_KEY).select(
        F.col(LABEL).cast("double"), F.col(WEIGHT).cast("double"),
        *people.columns[1:], *goods.columns[1:], batch.alias("batch"),
    )
    joined.write.partitionBy("batch").parquet(path)
    rows = spark.read.schema(joined.schema).parquet(path)
    mean = rows.agg((F.sum(F.col(LABEL) * F.col(WEIGHT)) / F.sum(WEIGHT)).alias("m")).first()["m"]
    params = initial({"c": size_c, "p": size_p}, width, hidden, mean or 0.0, seed)
    layout, vector = places(params), flat(params)
    first, second, losses, count = np.zeros_like(vector), np.zeros_like(vector), [], 0
    for epoch in range(epochs):
        lost, seen, length = 0.0, 0, step * 0.5 ** (epoch // halve_after)
        for number in range(batches):
            total, loss, n = gradient(rows.filter(F.col("batch") == number), shaped(vector, layout))
            if not n:
                continue
            lost, seen, count = lost + loss, seen + n, count + 1
            slope = total / n
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope * slope
            vector = vector - length * (first / (1 - 0.9 ** count)) / (
                np.sqrt(second / (1 - 0.999 ** count)) + 1e-8)
        losses.append(lost / seen if seen else 0.0)
    params = shaped(vector, layout)
    return TowerModel(
        written(_vectors(people, CUSTOMER_KEY, "c", params), "tower-customers"),
        written(_vectors(goods, PRODUCT_KEY, "p", params), "tower-products"), params, losses,
    )
