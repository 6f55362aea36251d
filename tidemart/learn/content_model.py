"""Content recommender: preparation of customer and product features and factor scoring.

The factorisation machine is that of `FMRegressor`: same start, mean squared error, AdamW, same end.
A step is one job: a task takes its rows as arrays and adds up gradients, each row as often as its
weight says; Spark adds the tasks' sums per parameter. A vector of features is never built: numbers
meet their factors in one product, categories look theirs up.

A score splits into a part of the customer, a part of the product and the product of two vectors,
so pairs meet those instead of all features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.regression import FMRegressionModel, FMRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.learn.prep import (
    MISSING, auto_feature_types, fill_by_type, scale_values, scaled,
)
from tidemart.operators.numbering import dense_ids
from tidemart.operators.relational import broadcast_if_small, union_vocabulary
from tidemart.session import checkpoint_ready, written

CUSTOMER_KEY, PRODUCT_KEY = "customer_unique_id", "product_key"
HISTORY = "purchase_category_history"


def vocabulary(frames: Sequence[DataFrame], col: str) -> DataFrame:
    """(value, code): distinct values of a column shared by the frames, numbered in order."""
    values = union_vocabulary([f for f in frames if col in f.columns], col)
    return dense_ids(values.na.drop(), col, ordered=True).toDF("value", "code")


def label_encoded(df: DataFrame, col: str, codes: DataFrame) -> DataFrame:
    """Replace a column by its code."""
    named = codes.select(F.col("value").alias(col), F.col("code").alias("_code"))
    return df.withColumn(col, F.col(col).cast("string")).join(
        broadcast_if_small(named), col, "left"
    ).withColumn(col, F.col("_code")).drop("_code")


def sequence_codes(customers: DataFrame, codes: DataFrame, col: str = HISTORY,
                   key: str = CUSTOMER_KEY) -> DataFrame:
    """(key, tokens): the history as codes from 1 in order, 0 for an unknown token.

    The missing mark takes the code after the last; a customer without history gets an empty
    list.
    """
    last = codes.agg(F.max("code") + 2).scalar()
    known = codes.select(F.col("value").alias("token"), (F.col("code") + 1).alias("number"))
    text = F.when(F.col(col) != MISSING, F.col(col))
    tokens = customers.select(key, F.posexplode(F.split(text, r" \| ")).alias("pos", "token"))
    # A token's code depends on the token alone: look up distinct tokens, not every position.
    runs = tokens.groupBy(key, "token").agg(F.collect_list("pos").alias("at"))
    coded = runs.join(broadcast_if_small(known), "token", "left").select(
        key,
        F.coalesce("number", F.when(F.col("token") == MISSING, last), F.lit(0)).alias("number"),
        F.explode("at").alias("pos"),
    )
    lists = coded.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "number"))), lambda s: s["number"])
        .alias("tokens")
    )
    return customers.select(key).join(lists, key, "left").select(
        key, F.coalesce("tokens", F.array().cast("array<int>")).alias("tokens")
    )


def padded(tokens: Column, width: Column) -> Column:
    """Tokens filled up on the right with 0."""
    return F.concat(tokens, F.array_repeat(F.lit(0), F.greatest(width - F.size(tokens), F.lit(0))))


def masked_mean(tokens: Column, weights: Column) -> Column:
    """Mean weight of the tokens that are not 0; ``weights`` is indexed by token."""
    real = F.filter(tokens, lambda t: t != 0)
    total = F.aggregate(
        F.transform(real, lambda t: F.get(weights, t)), F.lit(0.0), lambda s, x: s + x
    )
    return F.try_divide(total, F.size(real))




def entity_table(features: DataFrame, key: str, skip: Sequence[str] = ()
                 ) -> tuple[DataFrame, dict[str, str]]:
    """Filled and scaled entity features, categorical columns as text, with their kinds."""
    kinds = auto_feature_types(features, [key, *skip])
    table = fill_by_type(features, kinds)
    numeric = [c for c, k in kinds.items() if k == "num"]
    table = scaled(table, scale_values(table, numeric))
    return table.select(key, *kinds, *skip), kinds


def repeated(labels: DataFrame, weight: str, count: str | None = None) -> DataFrame:
    """Rows repeated by their weight, for learners without weights; each at least once.

    The weights are purchase counts, so the result is no longer than the facts they were counted
    from. With ``count`` a row stays one row and that column says how often it counts.
    """
    copies = F.greatest(F.round(F.col(weight)), F.lit(1)).cast("int")
    if count:
        return labels.withColumn(count, copies)
    return labels.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


class Layout:
    """Where the columns of an assembled vector lie: numbers first, then a range per category."""

    def __init__(self, stages: PipelineModel):
        encoder, assembler = stages.stages[-3], stages.stages[-2]
        self.cats = [c.removesuffix("_v") for c in encoder.getOutputCols()]
        self.nums = assembler.getInputCols()[:len(assembler.getInputCols()) - len(self.cats)]
        sizes = [int(n) for n in encoder.categorySizes]
        self.starts = dict(zip(self.cats, len(self.nums) + np.cumsum([0, *sizes])[:-1]))
        self.width = len(self.nums) + sum(sizes)

    def columns(self, prefix: str = "") -> tuple[list[str], list[str]]:
        return ([c for c in self.nums if c.startswith(prefix)], [c for c in self.cats if c.startswith(prefix)])

    def places(self, batch: pa.RecordBatch, cats: Sequence[str]) -> list[np.ndarray]:
        """Per category the place of every row's value."""
        return [batch.column(f"{c}_i").to_numpy().astype(np.int64) + self.starts[c] for c in cats]


def _numbers(batch: pa.RecordBatch, nums: Sequence[str]) -> np.ndarray:
    made = [batch.column(c).to_numpy(zero_copy_only=False) for c in nums]
    x = np.stack(made, axis=1).astype(float) if made else np.zeros((batch.num_rows, 0))
    if np.isnan(x).any():
        raise ValueError("features must not be null")
    return x


class ContentModel:
    """Factorisation machine over customer and product features."""

    def __init__(self, customers: DataFrame, products: DataFrame, stages: PipelineModel):
        self.customers, self.products, self.stages = customers, products, stages

    def rows(self, pairs: DataFrame) -> DataFrame:
        return pairs.join(self.customers, CUSTOMER_KEY).join(self.products, PRODUCT_KEY)

    def _half(self, entities: DataFrame, key: str, prefix: str) -> DataFrame:
        """(key, sum, vector): what an entity's own features give, and what meets the other side."""
        layout, machine = Layout(self.stages), self.stages.stages[-1]
        nums, cats = layout.columns(prefix)
        factors, linear = machine.factors.toArray(), machine.linear.toArray()
        squares = (factors ** 2).sum(axis=1)
        at = {c: layout.nums.index(c) for c in nums}
        for stage in self.stages.stages:
            if isinstance(stage, StringIndexerModel) and stage.getInputCol() in cats:
                entities = stage.transform(entities)
        kind = entities.schema[key].dataType.simpleString()

        def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, places = _numbers(batch, nums), layout.places(batch, cats)
                own, vector = np.zeros(len(x)), np.zeros((len(x), factors.shape[1]))
                # Column by column, so that a row's result does not depend on its batch.
                for j, c in enumerate(nums):
                    vector += x[:, j, None] * factors[at[c]]
                    own += x[:, j] * linear[at[c]] - 0.5 * x[:, j] ** 2 * squares[at[c]]
                for place in places:
                    vector += factors[place]
                    own += linear[place] - 0.5 * squares[place]
                own += 0.5 * (vector ** 2).sum(axis=1)
                ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(vector.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(own), pa.ListArray.from_arrays(ends, vector.ravel())],
                    [key, f"_{prefix}sum", f"_{prefix}vector"])

        return written(entities.select(key, *nums, *[f"{c}_i" for c in cats]).mapInArrow(
            halves, f"{key} {kind}, _{prefix}sum double, _{prefix}vector array<double>"), "content-halves")

    def predict(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``prediction``; pairs with an unknown end drop out."""
        keep = [F.col(c) for c in pairs.columns]
        people = self._half(self.customers, CUSTOMER_KEY, "c_")
        goods = self._half(self.products, PRODUCT_KEY, "p_")
        product = F.aggregate(
            F.zip_with("_c_vector", "_p_vector", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
        return pairs.join(people, CUSTOMER_KEY).join(goods, PRODUCT_KEY).select(
            *keep, (F.lit(self.stages.stages[-1].intercept) + F.col("_c_sum") + F.col("_p_sum") + product)
            .alias("prediction"))

    def save(self, path: str) -> None:
        self.customers.write.mode("overwrite").parquet(f"{path}/customers")
        self.products.write.mode("overwrite").parquet(f"{path}/products")
        self.stages.write().overwrite().save(f"{path}/stages")

    @classmethod
    def load(cls, spark, path: str) -> ContentModel:
        return cls(
            spark.read.parquet(f"{path}/customers"), spark.read.parquet(f"{path}/products"),
            PipelineModel.load(f"{path}/stages"),
        )


def fit_content(customers: DataFrame, products: DataFrame, labels: DataFrame, factors: int = 32,
                rounds: int = 20, step: float = 0.05, seed: int = 42) -> ContentModel:
    """Fit on labels (customer, product, avg_review_score_by_user, purchase_count)."""
    checkpoint_ready(labels.sparkSession)
    people, people_kinds = entity_table(customers, CUSTOMER_KEY, [HISTORY])
    goods, goods_kinds = entity_table(products, PRODUCT_KEY)
    people = _prefixed(people.drop(HISTORY), CUSTOMER_KEY, "c_")
    goods = _prefixed(goods, PRODUCT_KEY, "p_")
    kinds = {
        **{f"c_{c}": k for c, k in people_kinds.items()},
        **{f"p_{c}": k for c, k in goods_kinds.items()},
    }
    people, goods = written(people, "people"), written(goods, "goods")
    cats = [c for c, k in kinds.items() if k == "cat"]
    nums = [c for c, k in kinds.items() if k == "num"]
    stages = [
        *[
            StringIndexer(
                inputCol=c, outputCol=f"{c}_i", handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
            for c in cats
        ],
        OneHotEncoder(
            inputCols=[f"{c}_i" for c in cats], outputCols=[f"{c}_v" for c in cats],
            handleInvalid="keep",
        ),
        VectorAssembler(inputCols=[*nums, *[f"{c}_v" for c in cats]], outputCol="features"),
    ]
    model = ContentModel(people, goods, None)
    train = written(model.rows(repeated(labels, "purchase_count", "_copies")), "content-train")
    # The indexers learn from the entity tables' values as seen in training rows.
    ready = Pipeline(stages=stages).fit(train)
    start = FMRegressor(
        labelCol="avg_review_score_by_user", factorSize=factors, maxIter=0, stepSize=step, seed=seed,
    ).fit(ready.transform(train.limit(1)))
    model.stages = PipelineModel([*ready.stages, start])
    coded = written(ready.transform(train).select(
        F.col("avg_review_score_by_user").cast("double").alias("label"), "_copies", *nums,
        *[F.col(f"{c}_i").cast("int").alias(f"{c}_i") for c in cats]), "content-coded")
    model.stages.stages[-1] = _descended(coded, Layout(model.stages), start, rounds, step)
    return model


def _descended(rows: DataFrame, layout: Layout, start: FMRegressionModel, rounds: int, step: float,
               near: float = 1e-6) -> FMRegressionModel:
    """``start`` after AdamW over the rows; stops early where a step moves the weights by less than ``near``."""
    width, size = start.factors.toArray().shape
    weights = np.concatenate([start.factors.toArray().ravel(), start.linear.toArray(), [start.intercept]])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for round_ in range(1, rounds + 1):
        slope = _slopes(rows, layout, weights, width, size)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope ** 2
        moved = weights - step * (mean / (1 - 0.9 ** round_)) / (
            np.sqrt(square / (1 - 0.999 ** round_)) + 1e-8)
        gap, weights = np.linalg.norm(moved - weights), moved
        if round_ > 1 and gap < near * max(np.linalg.norm(weights), 1.0):
            break
    sc = rows.sparkSession.sparkContext
    java = sc._jvm.org.apache.spark.ml.regression.FMRegressionModel(
        start.uid, float(weights[-1]), _py2java(sc, Vectors.dense(weights[width * size:-1])),
        _py2java(sc, DenseMatrix(width, size, weights[:width * size], True)))
    return FMRegressionModel(start._java_obj.copyValues(java, sc._jvm.org.apache.spark.ml.param.ParamMap.empty()))


def _slopes(rows: DataFrame, layout: Layout, weights: np.ndarray, width: int, size: int) -> np.ndarray:
    """Mean slope of the squared error in every weight: factors by feature, linear weights, intercept."""
    nums, cats = layout.columns()
    factors, linear = weights[:width * size].reshape(width, size), weights[width * size:-1]
    squares, many = (factors ** 2).sum(axis=1), len(nums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per feature: slope of its factors, of its linear weight; at the end the intercept's and the rows.
        met, plain, ends = np.zeros((width, size)), np.zeros(width), np.zeros(2)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, places = _numbers(batch, nums), layout.places(batch, cats)
            copies = batch.column("_copies").to_numpy().astype(float)
            vector = x @ factors[:many] + sum(factors[p] for p in places)
            said = weights[-1] + x @ linear[:many] + sum(linear[p] for p in places) + 0.5 * (
                (vector ** 2).sum(axis=1) - x ** 2 @ squares[:many] - sum(squares[p] for p in places))
            gap = 2 * (said - batch.column("label").to_numpy()) * copies
            pull = gap[:, None] * vector
            met[:many] += x.T @ pull - factors[:many] * (gap @ x ** 2)[:, None]
            plain[:many] += gap @ x
            for place in places:
                order = np.argsort(place, kind="stable")
                at = place[order]
                first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                sums = np.add.reduceat(gap[order], first)
                met[at[first]] += np.add.reduceat(pull[order], first) - factors[at[first]] * sums[:, None]
                plain[at[first]] += sums
            ends += gap.sum(), copies.sum()
        every = np.concatenate([met.ravel(), plain, ends])
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_pydict({"place": some, "slope": every[some]})

    sums = rows.mapInArrow(add, "place long, slope double").groupBy("place").agg(F.sum("slope").alias("slope")).toArrow()
    every = np.zeros(len(weights) + 1)
    every[sums.column("place").to_numpy()] = sums.column("slope").to_numpy()
    return every[:-1] / max(every[-1], 1.0)


def _prefixed(df: DataFrame, key: str, prefix: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(prefix + c) for c in df.columns if c != key])


