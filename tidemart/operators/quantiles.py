"""Exact interpolated quantiles without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 2000
FEW = 200_000


@dataclass
class _Target:
    """One wanted rank (from 0, may be fractional) and the value range known to hold it."""

    col: str
    p: float
    rank: float
    low: float
    high: float
    below: int
    inside: int
    before: float | None = None
    after: float | None = None

    def held(self) -> Column:
        c = F.col(self.col)
        return F.when(c.between(self.low, self.high), c)

    @property
    def wide(self) -> bool:
        return self.inside > FEW and self.low < self.high


def _narrow(clean: DataFrame, targets: list[_Target]) -> None:
    """Shrink each range around its rank: one pass for a sketch, one to count exactly."""
    margin = 2.0 / ACCURACY
    edges = clean.agg(*[
        F.percentile_approx(
            t.held(),
            [
                max((t.rank - t.below) / t.inside - margin, 0.0),
                min((t.rank - t.below + 1) / t.inside + margin, 1.0),
            ],
            F.lit(ACCURACY),
        ).alias(f"t{i}")
        for i, t in enumerate(targets)
    ]).first()
    for i, t in enumerate(targets):
        t.low, t.high = edges[f"t{i}"]
    counts = clean.agg(*[
        F.struct(
            F.count(F.when(F.col(t.col) < t.low, 1)).alias("below"),
            F.count(t.held()).alias("inside"),
            F.max(F.when(F.col(t.col) < t.low, F.col(t.col))).alias("before"),
            F.min(F.when(F.col(t.col) > t.high, F.col(t.col))).alias("after"),
        ).alias(f"t{i}")
        for i, t in enumerate(targets)
    ]).first()
    for i, t in enumerate(targets):
        row = counts[f"t{i}"]
        t.below, t.inside, t.before, t.after = (
            row["below"], row["inside"], row["before"], row["after"],
        )


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]
                    ) -> dict[str, dict[float, float | None]]:
    """``{column: {p: value}}`` with linear interpolation between neighbours.

    A range of values known to hold the quantile is narrowed by sketches until few rows are
    left in it; only their distinct values are ordered. Nulls and NaN are left out.
    """
    cols = list(wanted)
    clean = df.select(*[
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols
    ])
    sizes = clean.agg(*[
        F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c)
        for c in cols
    ]).first()
    result: dict[str, dict[float, float | None]] = {c: dict.fromkeys(wanted[c]) for c in cols}
    targets = [
        _Target(c, p, (sizes[c]["n"] - 1) * p, sizes[c]["low"], sizes[c]["high"], 0, sizes[c]["n"])
        for c in cols if sizes[c]["n"] for p in wanted[c]
    ]
    if not targets:
        return result
    for _ in range(4):
        wide = [t for t in targets if t.wide]
        if not wide:
            break
        _narrow(clean, wide)
    for t, (low, high) in zip(targets, _neighbours(clean, targets)):
        low = t.before if math.floor(t.rank) < t.below else low
        high = high if high is not None else t.after
        part = t.rank - math.floor(t.rank)
        result[t.col][t.p] = low if part == 0 or high is None else low + part * (high - low)
    return result


def _neighbours(clean: DataFrame, targets: list[_Target]) -> list[tuple]:
    """Per target the values at the whole ranks on either side, as far as its range holds them."""
    cells = F.filter(
        F.array(*[F.struct(F.lit(i).alias("t"), t.held().alias("v")) for i, t in enumerate(targets)]),
        lambda e: e["v"].isNotNull(),
    )
    counted = (
        clean.select(F.explode(cells).alias("e"))
        .groupBy("e.t", "e.v").agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("t").orderBy("v"))
    ranks = F.create_map(*[
        x for i, t in enumerate(targets) for x in (F.lit(i), F.lit(float(t.rank - t.below)))
    ])
    rows = (
        counted.withColumn("upto", upto).withColumn("rank", ranks[F.col("t")])
        .groupBy("t")
        .agg(
            F.min(F.when(F.col("upto") > F.floor("rank"), F.col("v"))).alias("low"),
            F.min(F.when(F.col("upto") > F.ceil("rank"), F.col("v"))).alias("high"),
        )
        .collect()
    )
    found = {r["t"]: (r["low"], r["high"]) for r in rows}
    return [found.get(i, (None, None)) for i in range(len(targets))]


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    found = exact_quantiles(df, {c: [0.5] for c in cols})
    return {c: found[c][0.5] for c in cols}


def outlier_counts(df: DataFrame, cols: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, fences and rows outside them per column."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in cols})
    fences = {}
    for c in cols:
        q1, q3 = quartiles[c][0.25], quartiles[c][0.75]
        if q1 is not None:
            fences[c] = (q1, q3, q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
    value = {c: F.col(c).cast("double") for c in fences}
    row = df.agg(*[
        F.count(F.when((value[c] < low) | (value[c] > high), 1)).alias(c)
        for c, (_, _, low, high) in fences.items()
    ])
    return row.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q3).alias("q3"),
            F.col(c).alias("n_outliers"),
        )
        for c, (q1, q3, _, _) in fences.items()
    ])))
