"""Row, join, sampling and profiling operators used across the plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.scalars import hash_unit

BROADCAST_BYTES = 64 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """The optimiser's size estimate; joins and unknown sources come out large."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the plan proves the frame small; else leave it to AQE."""
    return F.broadcast(df) if planned_bytes(df) <= limit else df


def spread_if_small(df: DataFrame, limit: int = 1 << 30) -> DataFrame:
    """Spread a small input over all cores before heavy per-row work.

    Small files often come as one row group, hence one task. Large inputs already have many
    and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if planned_bytes(df) <= limit else df


def lookup(df: DataFrame, dim: DataFrame, key: str | list[str]) -> DataFrame:
    """Left join with a lookup table; unmatched rows keep nulls."""
    return df.join(broadcast_if_small(dim), key, "left")


def latest_by(df: DataFrame, keys: Sequence[str], sequence: Sequence[str | Column]) -> DataFrame:
    """The row with the highest sequence per key, ties to the largest remaining columns.

    A struct maximum combines on the map side, so a key with very many versions never
    gathers in one window partition.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(s) if isinstance(s, str) else s for s in sequence]
    entry = F.struct(
        F.struct(*[o.alias(f"s{i}") for i, o in enumerate(order)]).alias("at"),
        F.struct(*rest).alias("row"),
    )
    best = df.groupBy(*keys).agg(F.max(entry).alias("best"))
    return best.select(*keys, "best.row.*").select(*df.columns)


def with_firsts(df: DataFrame, key: str | list[str], *cols: str) -> DataFrame:
    """``df`` dealt by ``key``, with ``first_<col>`` 1 on one row of each value of ``col`` within ``key``.

    Sums of these are the distinct counts. Several distinct counts in one grouping copy every row
    for each of them, with all partial aggregates; here a row crosses the network once, as it is.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.repartition(*keys)
    for c in cols:
        same = Window.partitionBy(*keys, c).orderBy(c)
        rows = rows.withColumn(f"first_{c}", F.when(
            F.col(c).isNotNull() & (F.row_number().over(same) == 1), F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return rows


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
            ) -> DataFrame:
    """Child keys with no parent and the number of rows that carry them; nulls excluded."""
    counts = (
        child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_key or key).alias(key))
    return counts.join(known, key, "left_anti")


def value_frequency(df: DataFrame, col: str) -> DataFrame:
    """Each non-null value with its share of the non-null rows."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(col, (F.col("n") / total).alias("frequency"))


def union_vocabulary(frames: Sequence[DataFrame], col: str) -> DataFrame:
    """Distinct values, as strings, of a column that several frames share."""
    parts = [f.select(F.col(col).cast("string").alias(col)).distinct() for f in frames]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.distinct()


def sample_fraction(df: DataFrame, fraction: float, seed: int, *keys: str) -> DataFrame:
    """A fixed share of the rows chosen by a hash of their key."""
    return df.filter(hash_unit("sample", seed, *keys) < fraction)


def sample_n(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """``n`` rows in a seeded random order of their key."""
    return df.orderBy(hash_unit("sample", seed, *keys), *keys).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """Per numeric column: rows, nulls, mean, deviation, minimum, maximum.

    All columns are measured in one aggregate over the frame and unpivoted afterwards.
    """
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in
               ("byte", "short", "integer", "long", "float", "double", "decimal")]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.struct(
                F.count(c).alias("n_set"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(c).cast("double").alias("low"),
                F.max(c).cast("double").alias("high"),
            ).alias(c)
            for c in numeric
        ],
    )
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"{c}.n_set")).alias("n_null"),
            *[F.col(f"{c}.{m}").alias(m) for m in ("mean", "std", "low", "high")],
        )
        for c in numeric
    ])
    return row.select(F.inline(entries))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
        for i, (a, b) in enumerate(pairs)
    ])
    entries = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ])
    return row.select(F.inline(entries))
