"""Feature preparation: imputing, scaling, encoding, typing, splitting."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions.scalars import hash_unit
from tidemart.operators.quantiles import medians
from tidemart.operators.relational import broadcast_if_small, value_frequency
from tidemart.session import written

# Column groups of the churn model.
ZERO_FILLED = [
    "avg_overdue_days_on_holidays", "review_with_comment", "avg_review_response_time",
]
MEDIAN_FILLED = [
    "avg_delivery_delay", "avg_delivery_overdue_days", "avg_internal_processing_days",
    "avg_overdue_days_on_non_holidays", "avg_review_score", "distinct_payment_methods",
    "avg_installments", "distinct_categories", "distinct_products", "distinct_sellers",
    "category_concentration",
]
PLAIN = [
    "customer_tenure", "frequency_orders", "monetary_value", "avg_order_price", "sum_freight",
    "avg_freight", "late_delivery_rate", "avg_promised_window_days", "holiday_purchase_rate",
]
ONE_HOT = "most_used_payment_type"
FREQUENCY = "most_purchased_product"
UNKNOWN = "unknown"
LABEL = "churn_label"
MISSING = "<MISSING>"
MAX_CATEGORIES = 1000


def _set(col: str) -> Column:
    """The column as double, NaN taken as missing."""
    value = F.col(col).cast("double")
    return F.when(~F.isnan(value), value)


def fill_values(df: DataFrame, zero: Sequence[str], median: Sequence[str]) -> dict[str, float]:
    found = medians(df, median) if median else {}
    return {**dict.fromkeys(zero, 0.0), **{c: v for c, v in found.items() if v is not None}}


def filled(df: DataFrame, fill: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(_set(c), F.lit(v)) for c, v in fill.items()})


def scale_values(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column from one aggregate; a constant column gets 1."""
    row = df.agg(*[
        F.struct(F.avg(_set(c)).alias("mean"), F.stddev_pop(_set(c)).alias("std")).alias(c)
        for c in cols
    ]).first()
    return {c: (row[c]["mean"] or 0.0, row[c]["std"] or 1.0) for c in cols}


def scaled(df: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({
        c: (_set(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in scale.items()
    })


def categories(df: DataFrame, col: str) -> list[str]:
    """The sorted values of a one-hot column. One-hot columns must stay few."""
    rows = (
        df.select(F.coalesce(F.col(col).cast("string"), F.lit(UNKNOWN)).alias("v"))
        .distinct().limit(MAX_CATEGORIES + 1).collect()
    )
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"{col} has more than {MAX_CATEGORIES} values; use frequency encoding")
    return sorted(r["v"] for r in rows)


def one_hot(col: str, values: Sequence[str]) -> dict[str, Column]:
    """0/1 columns, one per known value; any other value gives all zeros."""
    text = F.coalesce(F.col(col).cast("string"), F.lit(UNKNOWN))
    return {f"{col}={v}": F.when(text == v, 1.0).otherwise(0.0) for v in values}


class FrequencyEncoder:
    """Replace a value by its share among the training rows; unseen values give 0."""

    def __init__(self, col: str, frequencies: DataFrame | None = None):
        self.col, self.frequencies = col, frequencies

    def fit(self, df: DataFrame) -> FrequencyEncoder:
        return FrequencyEncoder(
            self.col, written(value_frequency(df, self.col), "frequencies")
        )

    def transform(self, df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c != self.col]
        found = df.join(broadcast_if_small(self.frequencies), self.col, "left")
        return found.select(*rest, F.coalesce("frequency", F.lit(0.0)).alias(self.col))


@dataclass
class PrepParams:
    fill: dict[str, float] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    values: list[str] = field(default_factory=list)


class ChurnPrep:
    """The churn model's column transformer: fit once, apply anywhere, save and load."""

    groups = (ZERO_FILLED, MEDIAN_FILLED, PLAIN)

    def __init__(self, params: PrepParams | None = None, encoder: FrequencyEncoder | None = None):
        self.params, self.encoder = params, encoder

    @property
    def names(self) -> list[str]:
        flags = [f"{ONE_HOT}={v}" for v in self.params.values]
        return [*ZERO_FILLED, *MEDIAN_FILLED, *PLAIN, *flags, FREQUENCY]

    def fit(self, df: DataFrame) -> ChurnPrep:
        fill = fill_values(df, ZERO_FILLED, MEDIAN_FILLED)
        encoder = FrequencyEncoder(FREQUENCY).fit(df)
        ready = encoder.transform(filled(df, fill))
        scale = scale_values(ready, [*ZERO_FILLED, *MEDIAN_FILLED, *PLAIN, FREQUENCY])
        return ChurnPrep(PrepParams(fill, scale, categories(df, ONE_HOT)), encoder)

    def columns(self, df: DataFrame) -> DataFrame:
        """The prepared columns side by side, before assembly."""
        ready = scaled(self.encoder.transform(filled(df, self.params.fill)), self.params.scale)
        return ready.withColumns(one_hot(ONE_HOT, self.params.values))

    def transform(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep`` columns plus the feature vector."""
        cols = self.columns(df)
        # Assemble from plain aliases: the assembler reads dots in names as struct fields.
        aliases = [f"f{i}" for i in range(len(self.names))]
        flat = cols.select(
            *keep,
            *[F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)).alias(a)
              for n, a in zip(self.names, aliases)],
        )
        return VectorAssembler(inputCols=aliases, outputCol="features").transform(flat).select(
            *keep, "features"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        spark.range(1).select(F.lit(json.dumps(asdict(self.params))).alias("params")).coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/params")
        self.encoder.frequencies.write.mode("overwrite").parquet(f"{path}/frequencies")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ChurnPrep:
        raw = json.loads(spark.read.parquet(f"{path}/params").first()["params"])
        raw["scale"] = {c: tuple(v) for c, v in raw["scale"].items()}
        return cls(
            PrepParams(**raw),
            FrequencyEncoder(FREQUENCY, spark.read.parquet(f"{path}/frequencies")),
        )


def auto_feature_types(df: DataFrame, skip: Sequence[str], few: int = 30) -> dict[str, str]:
    """``cat`` for strings and for whole-number columns with fewer than ``few`` values.

    Distinct counts come from one sketch pass; only columns near the limit are counted
    exactly.
    """
    kinds, whole = {}, []
    for name, kind in df.dtypes:
        if name in skip:
            continue
        if kind in ("string", "boolean"):
            kinds[name] = "cat"
        elif kind in ("double", "float") or kind.startswith("decimal"):
            kinds[name] = "num"
        elif kind in ("int", "bigint", "smallint", "tinyint"):
            kinds[name] = "num"
            whole.append(name)
    if whole:
        rough = df.agg(*[F.approx_count_distinct(c).alias(c) for c in whole]).first()
        near = [c for c in whole if rough[c] < 2 * few]
        if near:
            exact = df.agg(*[F.countDistinct(c).alias(c) for c in near]).first()
            kinds.update({c: "cat" for c in near if exact[c] < few})
    return {c: kinds[c] for c in df.columns if c in kinds}


def fill_by_type(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Medians into numeric columns, the missing mark into categorical ones."""
    numeric = [c for c, k in kinds.items() if k == "num"]
    df = filled(df, fill_values(df, [], numeric))
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
        for c, k in kinds.items() if k == "cat"
    })


def temporal_columns(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns({
        f"{date}_year": F.year(date), f"{date}_month": F.month(date),
        f"{date}_day": F.dayofmonth(date), f"{date}_weekday": F.weekday(date) + 1,
    })


def interactions(df: DataFrame, cols: Sequence[str], degree: int = 2) -> DataFrame:
    """Products of every column combination up to the degree, squares included."""
    terms: dict[str, Column] = {}
    level = [((i,), F.col(c).cast("double")) for i, c in enumerate(cols)]
    for _ in range(1, degree):
        level = [
            ((*at, j), value * F.col(cols[j]).cast("double"))
            for at, value in level for j in range(at[-1], len(cols))
        ]
        terms.update({"_x_".join(cols[i] for i in at): value for at, value in level})
    return df.withColumns(terms)


def split(df: DataFrame, fraction: float, seed: int, *keys: str, purpose: str = "split"
          ) -> tuple[DataFrame, DataFrame]:
    """Train and test by a hash of the entity, so rows of one entity stay together."""
    place = hash_unit(purpose, seed, *keys)
    return df.filter(place < fraction), df.filter(place >= fraction)


#: Ranges of the hash within which rows of a class are ranked.
RANK_RANGES = 4096


def class_ranks(df: DataFrame, label: str, purpose: str, seed: int, *keys: str) -> DataFrame:
    """Adds ``rank`` (from 0) of the row among its class in the order of a hash of its keys, ``size``
    of the class, and ``before``, the rows of smaller classes.

    Rows are ranked within ranges of the hash; only counts per class and range are ordered as a
    whole, so no class meets in one task. A null label is a class of its own.
    """
    rows = written(df.withColumn("_place", hash_unit(purpose, seed, label, *keys)).withColumn(
        "_range", F.floor(F.col("_place") * RANK_RANGES).cast("int")), "places")
    counts = rows.groupBy(F.col(label).alias("_class"), F.col("_range").alias("_r")).agg(
        F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_class").orderBy("_r")
    counts = counts.withColumn("_offset", F.sum("_n").over(upto) - F.col("_n"))
    sizes = counts.groupBy(F.col("_class").alias("_of")).agg(F.sum("_n").alias("size"))
    sizes = sizes.withColumn(  # a row per class
        "before", F.sum("size").over(Window.orderBy(F.col("_of").asc_nulls_first())) - F.col("size"))
    counts = counts.join(F.broadcast(sizes), F.col("_class").eqNullSafe(F.col("_of"))).drop("_of", "_n")
    # Rows with equal keys differ in the rest, or are one and the same.
    within = Window.partitionBy(label, "_range").orderBy("_place", *keys, F.xxhash64(*df.columns))
    return rows.withColumn("_row", F.row_number().over(within) - 1).join(
        broadcast_if_small(counts), F.col(label).eqNullSafe(F.col("_class")) & (F.col("_range") == F.col("_r"))
    ).select(*df.columns, (F.col("_offset") + F.col("_row")).alias("rank"), "size", "before")


def stratified_split(df: DataFrame, fraction: float, seed: int, label: str, *keys: str
                     ) -> tuple[DataFrame, DataFrame]:
    """Train and validation; of every class of n rows round(n * fraction) are held out."""
    ranked = written(class_ranks(df, label, "validation", seed, *keys), "stratified")
    held = F.col("rank") < F.floor(F.col("size") * fraction + 0.5)
    return ranked.filter(~held).select(*df.columns), ranked.filter(held).select(*df.columns)


def with_stratified_fold(df: DataFrame, k: int, seed: int, label: str, *keys: str) -> DataFrame:
    """Adds ``fold``; folds differ by one row at most, in each class and in all."""
    ranked = class_ranks(df, label, "stratified fold", seed, *keys)
    return ranked.select(*df.columns, ((F.col("before") + F.col("rank")) % k).cast("int").alias("fold"))


def with_fold(df: DataFrame, k: int, seed: int, *keys: str) -> DataFrame:
    return df.withColumn("fold", F.floor(hash_unit("fold", seed, *keys) * k).cast("int"))
