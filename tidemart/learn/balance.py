"""Class balancing: random oversampling and synthetic minority rows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import hash_unit, surrogate_key
from tidemart.operators.neighbours import nearest
from tidemart.operators.quantiles import exact_quantiles
from tidemart.session import written


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    return {
        r[label]: r["n"]
        for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    }


def _copies(rows: DataFrame, ids: DataFrame, wanted: int, n: int, seed: int, row_id: str
            ) -> DataFrame:
    """Each row once per new row it must give, as column ``copy``; ``wanted`` rows in all.

    Every row gives the whole part; the rest falls on the rows with the lowest hash, found by
    an exact quantile over ``ids``, the same rows without what is costly to compute.
    """
    whole, rest = divmod(wanted, n)
    place = surrogate_key(F.lit(str(seed)), row_id).cast("double")
    extra = F.lit(0)
    if rest:
        p = 0.0 if n == 1 else (rest - 1) / (n - 1)
        # A hair above the rank, so that rounding cannot fall below it.
        edge = exact_quantiles(ids.select(place.alias("p")), {"p": [p]})["p"][p]
        extra = F.when(place <= edge * (1 + 1e-12), 1).otherwise(0)
    given = rows.withColumn("_times", F.lit(whole) + extra).filter("_times > 0")
    return given.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def random_oversample(df: DataFrame, label: str, row_id: str, seed: int = 42) -> DataFrame:
    """Repeat minority rows until both classes are equal."""
    counts = class_counts(df, label)
    small, large = min(counts, key=counts.get), max(counts, key=counts.get)
    minority = df.filter(F.col(label) == small)
    more = _copies(minority, minority, counts[large] - counts[small], counts[small], seed, row_id)
    fresh = more.withColumn(row_id, F.xxhash64(row_id, "copy")).drop("copy")
    return df.withColumn("synthetic", F.lit(False)).unionByName(
        fresh.withColumn("synthetic", F.lit(True))
    )


def neighbour_count(minority: int, k: int = 5) -> int:
    return min(k, max(1, minority - 1))


def smote(df: DataFrame, label: str, row_id: str, k: int = 5, seed: int = 42,
          metric: str = "euclidean") -> DataFrame:
    """Add minority rows between a row and one of its nearest minority neighbours.

    ``df`` has a unique long ``row_id`` and a ``features`` vector. New rows get an identifier
    of their own and are marked ``synthetic``.
    """
    counts = class_counts(df, label)
    small, large = min(counts, key=counts.get), max(counts, key=counts.get)
    n, wanted = counts[small], counts[large] - counts[small]
    base = df.select(row_id, label, "features").withColumn("synthetic", F.lit(False))
    if wanted == 0:
        return base
    minority = df.filter(F.col(label) == small).select(
        F.col(row_id).alias("id"), vector_to_array("features").alias("vec")
    )
    minority = written(minority, "minority")
    near = nearest(minority, minority, neighbour_count(n, k), metric, others=True)
    # At most k ids a row; the chosen neighbour's vector is looked up once per new row.
    near = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("d", "j"))).alias("neighbours"))
    starts = _copies(minority.join(near, "id", "left"), minority, wanted, n, seed, "id")
    pick = F.floor(hash_unit("neighbour", seed, "id", "copy") * F.size("neighbours")).cast("int")
    starts = starts.withColumn("_j", F.get("neighbours", pick)["j"]).join(
        minority.select(F.col("id").alias("_j"), F.col("vec").alias("_other")), "_j", "left")
    gap = hash_unit("gap", seed, "id", "copy")
    mixed = F.zip_with(
        F.col("vec"), F.coalesce("_other", F.col("vec")), lambda a, b: a + gap * (b - a)
    )
    fresh = starts.select(
        F.xxhash64("id", "copy").alias(row_id), F.lit(small).cast(df.schema[label].dataType).alias(label),
        array_to_vector(mixed).alias("features"), F.lit(True).alias("synthetic"),
    )
    return base.unionByName(fresh)


def balanced(df: DataFrame, label: str, row_id: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Oversampling when the minority is a single row, synthetic rows otherwise."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df.select(row_id, label, "features").withColumn("synthetic", F.lit(False))
    if min(counts.values()) <= 1:
        return random_oversample(df.select(row_id, label, "features"), label, row_id, seed)
    return smote(df, label, row_id, k, seed)
