"""Rating models: biased factorisation, SVD++, non-negative factors, Slope One, k-NN."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import ratio
from tidemart.learn.prep import split
from tidemart.operators import cooccurrence
from tidemart.operators.numbering import dense_ids
from tidemart.plans.collaborative import RATING_RANGE
from tidemart.session import checkpoint_ready, written

SEED = 42


def as_ratings(table: DataFrame) -> DataFrame:
    """(user, item, r), one row per pair, from (userID, itemID, rating)."""
    return table.select(
        F.col("userID").alias("user"), F.col("itemID").alias("item"), F.col("rating").alias("r")
    ).groupBy("user", "item").agg(F.max("r").alias("r"))


def rating_split(ratings: DataFrame, fraction: float = 0.8, seed: int = SEED):
    return split(ratings, fraction, seed, "user", "item")


def clipped(value: Column) -> Column:
    low, high = RATING_RANGE
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


@dataclass
class Biases:
    """Global mean and shrunken user and item offsets."""

    mean: float
    users: DataFrame
    items: DataFrame

    def add(self, pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(self.users, "user", "left").join(self.items, "item", "left")
            .withColumn(
                "bias",
                F.lit(self.mean) + F.coalesce("bu", F.lit(0.0)) + F.coalesce("bi", F.lit(0.0)),
            )
            .drop("bu", "bi")
        )


def fit_biases(ratings: DataFrame, shrink: float = 5.0) -> Biases:
    mean = ratings.agg(F.avg("r").alias("m")).first()["m"] or 0.0
    items = ratings.groupBy("item").agg(
        (F.sum(F.col("r") - mean) / (F.count(F.lit(1)) + shrink)).alias("bi")
    )
    users = ratings.join(items, "item").groupBy("user").agg(
        (F.sum(F.col("r") - mean - F.col("bi")) / (F.count(F.lit(1)) + shrink)).alias("bu")
    )
    return Biases(mean, written(users, "user-bias"), written(items, "item-bias"))


class FactorModel:
    """ALS factors over numbered users and items, optionally on top of biases."""

    def __init__(self, als: ALSModel, users: DataFrame, items: DataFrame, biases: Biases | None):
        self.als, self.users, self.items, self.biases = als, users, items, biases

    def _numbered(self, pairs: DataFrame) -> DataFrame:
        return pairs.join(
            self.users.withColumnRenamed("idx", "u"), "user", "left"
        ).join(self.items.withColumnRenamed("idx", "i"), "item", "left")

    def predict(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (user, item, …) with ``prediction``; unknown ends fall back to the bias."""
        users = self.als.userFactors.select(F.col("id").alias("u"), F.col("features").alias("pu"))
        items = self.als.itemFactors.select(F.col("id").alias("i"), F.col("features").alias("qi"))
        rows = self._numbered(pairs).join(users, "u", "left").join(items, "i", "left")
        dot = F.aggregate(
            F.zip_with("pu", "qi", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x
        )
        rows = rows.withColumn("dot", F.coalesce(dot, F.lit(0.0))).drop("pu", "qi", "u", "i")
        if self.biases:
            rows = self.biases.add(rows)
        else:
            rows = rows.withColumn("bias", F.lit(0.0))
        return rows.withColumn("prediction", clipped(F.col("bias") + F.col("dot"))).drop(
            "bias", "dot"
        )

    def recommend(self, k: int, users: DataFrame | None = None) -> DataFrame:
        """(user, item, score, rank): the ``k`` best items of every user, or of ``users``.

        Every asked user is scored against every item, block by block; on large catalogues
        ask for the users that need a list.
        """
        if users is None:
            lists = self.als.recommendForAllUsers(k)
        else:
            asked = users.select("user").distinct().join(self.users, "user")
            lists = self.als.recommendForUserSubset(asked.select(F.col("idx").alias("u")), k)
        rows = lists.select(
            F.col("u"), F.posexplode("recommendations").alias("place", "rec")
        ).select("u", (F.col("place") + 1).alias("rank"), "rec.i", F.col("rec.rating").alias("score"))
        return rows.join(self.users.withColumnRenamed("idx", "u"), "u").join(
            self.items.withColumnRenamed("idx", "i"), "i"
        ).select("user", "item", "score", "rank")


def _fit_als(ratings: DataFrame, value: str, rank: int, rounds: int, reg: float,
             nonnegative: bool, seed: int):
    checkpoint_ready(ratings.sparkSession)
    users, items = dense_ids(ratings, "user"), dense_ids(ratings, "item")
    rows = ratings.join(users.withColumnRenamed("idx", "u"), "user").join(
        items.withColumnRenamed("idx", "i"), "item"
    ).select("u", "i", F.col(value).cast("float").alias("value"))
    als = ALS(
        userCol="u", itemCol="i", ratingCol="value", rank=rank, maxIter=rounds, regParam=reg,
        nonnegative=nonnegative, seed=seed, checkpointInterval=10,
    )
    return als.fit(rows), users, items


def fit_svd(ratings: DataFrame, rank: int = 50, rounds: int = 20, reg: float = 0.1,
            seed: int = SEED) -> FactorModel:
    """Biases by aggregation, then ALS on what they leave."""
    biases = fit_biases(ratings)
    rest = biases.add(ratings).withColumn("rest", F.col("r") - F.col("bias"))
    als, users, items = _fit_als(rest, "rest", rank, rounds, reg, False, seed)
    return FactorModel(als, users, items, biases)


def fit_nmf(ratings: DataFrame, rank: int = 15, rounds: int = 50, reg: float = 0.06,
            seed: int = SEED) -> FactorModel:
    als, users, items = _fit_als(ratings, "r", rank, rounds, reg, True, seed)
    return FactorModel(als, users, items, None)


class HistoryModel:
    """SVD with a term for the items a user has rated."""

    def __init__(self, base: FactorModel, histories: DataFrame, weight: float):
        self.base, self.histories, self.weight = base, histories, weight

    def _term(self, pairs: DataFrame) -> DataFrame:
        items = self.base.als.itemFactors.select(
            F.col("id").alias("i"), F.col("features").alias("qi")
        )
        numbered = self.base.items.withColumnRenamed("idx", "i").join(items, "i").drop("i")
        rows = pairs.join(numbered, "item", "left").join(self.histories, "user", "left")
        dot = F.aggregate(
            F.zip_with("qi", "hu", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x
        )
        return rows.withColumn("term", F.coalesce(dot, F.lit(0.0))).drop("qi", "hu")

    def predict(self, pairs: DataFrame) -> DataFrame:
        rows = self._term(self.base.predict(pairs))
        return rows.withColumn(
            "prediction", clipped(F.col("prediction") + F.lit(self.weight) * F.col("term"))
        ).drop("term")


def fit_svdpp(ratings: DataFrame, rank: int = 20, rounds: int = 20, reg: float = 0.1,
              ridge: float = 1.0, seed: int = SEED) -> HistoryModel:
    """SVD plus the user's scaled sum of item factors, weighted by one ridge step."""
    base = fit_svd(ratings, rank, rounds, reg, seed)
    factors = base.als.itemFactors.select(F.col("id").alias("i"), F.col("features").alias("q"))
    known = base.items.withColumnRenamed("idx", "i").join(factors, "i").drop("i")
    total = [F.sum(F.col("q")[x].cast("double")).alias(f"q{x}") for x in range(rank)]
    sums = ratings.join(known, "item").groupBy("user").agg(F.count(F.lit(1)).alias("n"), *total)
    histories = written(
        sums.select("user", F.array(*[F.col(f"q{x}") / F.sqrt("n") for x in range(rank)]).alias("hu")),
        "histories",
    )
    model = HistoryModel(base, histories, 0.0)
    rows = model._term(base.predict(ratings))
    gap = F.col("r") - F.col("prediction")
    step = rows.agg(
        F.sum(gap * F.col("term")).alias("top"), F.sum(F.col("term") ** 2).alias("bottom")
    ).first()
    model.weight = (step["top"] or 0.0) / ((step["bottom"] or 0.0) + ridge)
    return model


def _estimated(ratings: DataFrame, sums: DataFrame) -> DataFrame:
    """num / den, else the user's mean, else the global mean; clipped to the scale."""
    users = ratings.groupBy("user").agg(F.avg("r").alias("user_mean"))
    mean = ratings.agg(F.avg("r")).scalar()
    return sums.join(users, "user", "left").select(
        "user", "item",
        clipped(F.coalesce(ratio(F.col("num"), F.col("den")), F.col("user_mean"), mean)).alias(
            "prediction"
        ),
    )


def slope_one(ratings: DataFrame, pairs: DataFrame, heavy: int = cooccurrence.HEAVY) -> DataFrame:
    """Weighted Slope One predictions (user, item, prediction) for the pairs."""
    return _estimated(ratings, cooccurrence.slope_one_sums(ratings, pairs, heavy))


def knn_items(ratings: DataFrame, pairs: DataFrame, k: int = 40, min_common: int = 1,
              heavy: int = cooccurrence.HEAVY) -> DataFrame:
    """Item-based k-NN predictions (user, item, prediction) for the pairs."""
    near = cooccurrence.nearest_items(ratings, k, min_common, heavy)
    return _estimated(ratings, cooccurrence.neighbour_sums(ratings, near, pairs, heavy))


# Factor counts, epochs and penalties of the grids.
SVD_GRID = [{"rank": 50, "rounds": 20}, {"rank": 100, "rounds": 20}]
SVDPP_GRID = [{"rank": 20, "rounds": 20}, {"rank": 50, "rounds": 20}]
NMF_GRID = [{"rank": 15, "rounds": 50}, {"rank": 30, "rounds": 50}]


def grid_search(fit, grid, train: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE and MAE of every grid point on the held-out ratings, as rows."""
    rows = None
    for number, params in enumerate(grid):
        scored = fit(train, **params).predict(test)
        gap = F.col("prediction") - F.col("r")
        one = scored.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))
        one = one.select(
            F.lit(number).alias("trial"), F.lit(str(params)).alias("params"), "rmse", "mae"
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows
