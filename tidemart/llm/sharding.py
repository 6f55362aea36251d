"""Sharding by sampled splitters.

The sort key of a row is (hash of its text, id), so equal texts lie side by side. A sample drawn
with chances in proportion to size gives quantile boundaries, which cut the key line into many
short ranges. Each range's exact size is then summed; one that came out too large is sampled again
and cut further, by id where a single text fills it, until all hold. Consecutive ranges make up a
shard, so shards are themselves key ranges of near equal bytes.

Rows are numbered within their short range only, whatever the size of the table: ranges hold at
most about a gigabyte of text. The driver gets a few sampled keys and one row per range, 1,024
ranges up to a terabyte and one per gigabyte beyond.

Defined cases: null text has size 1 and the hash and checksum of an empty text; ids are whole
numbers and null ids sort first; rows equal in text and id cannot be told apart and stay in one
range; a text larger than two ranges fills a range with at most one range's worth of others; an
empty table gives no rows. Columns other than the two named are not read, so their names cannot
clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import table
from tidemart.session import written

SHARDS = 8
#: Ranges a shard is made of, and sampled keys per range.
RANGES, PER_RANGE = 128, 4
#: Most bytes of a range.
RANGE_BYTES = 1 << 30
LEAST = -(1 << 63)


def _range_of(splitters: list[tuple[int, int]]):
    """Number of splitters at or below a key."""
    hashes = np.array([s[0] for s in splitters], np.int64)
    ids = np.array([s[1] for s in splitters], np.int64)

    @F.pandas_udf("int")
    def place(key: pd.Series, row: pd.Series) -> pd.Series:
        key, row = key.to_numpy(), row.to_numpy()
        low = np.searchsorted(hashes, key, "left")
        out = np.searchsorted(hashes, key, "right")
        for i in np.flatnonzero(low < out):  # a boundary inside a group of equal texts
            out[i] = low[i] + np.searchsorted(ids[low[i]:out[i]], row[i], "right")
        return pd.Series(out.astype(np.int32))

    return place


def _sample(keys: DataFrame, total: int, count: int, seed: int) -> list[tuple]:
    """About `count` rows, each taken with a chance in proportion to its size."""
    step = max(1.0, total / count)
    drawn = F.pmod(F.xxhash64("_key", "_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    rows = keys.where(drawn * step < F.col("size")).select("_key", "_id", "size").collect()
    return sorted((r[0], r[1], max(r[2], step)) for r in rows)


def _quantiles(sample: list[tuple], width: float) -> list[tuple[int, int]]:
    """Sampled keys where a multiple of `width` of the estimated size is passed."""
    if not sample:
        return []
    passed = np.floor(np.cumsum([s[2] for s in sample]) / width)
    return [sample[i][:2] for i in range(1, len(sample)) if passed[i] > passed[i - 1]]


def splitters(keys: DataFrame, total: int, shards: int) -> tuple[list[tuple[int, int]], list]:
    """Splitters, and (range, bytes, rows) of each range that has rows."""
    ranges = max(shards * RANGES, total // RANGE_BYTES)
    width = max(1.0, total / ranges)
    found = sorted(set(_quantiles(_sample(keys, total, ranges * PER_RANGE, 0), width)))
    seed = 0
    while True:
        seed += 1
        placed = keys.withColumn("_range", _range_of(found)("_key", "_id"))
        sums = placed.groupBy("_range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"),
            F.max("size").alias("largest"),
            (F.min(F.struct("_key", "_id")) == F.max(F.struct("_key", "_id"))).alias("one")).collect()
        # One row beyond the width cannot be cut; what lies beside it may stay if it is less than a width.
        over = [r["_range"] for r in sums
                if r["bytes"] > 2 * width and r["bytes"] - r["largest"] > width and not r["one"]]
        if not over:
            return found, sorted((r["_range"], r["bytes"], r["rows"]) for r in sums)
        inside = placed.where(F.col("_range").isin(over))
        held = sum(r["bytes"] for r in sums if r["_range"] in set(over))
        sample = _sample(inside, held, max(64, int(held / width) * PER_RANGE * 4), seed)
        more = set(_quantiles(sample, width / 2)) | {s[:2] for s in sample if s[2] > width}
        if seed > 4:  # sampling keeps missing: halve the span of each range's keys, or of its ids
            for r in inside.groupBy("_range").agg(
                    F.min("_key").alias("low"), F.max("_key").alias("high"),
                    F.min("_id").alias("low_id"), F.max("_id").alias("high_id")).collect():
                more.add(_middle((r["low"], r["low_id"]), (r["high"], r["high_id"])))
            assert not more <= set(found), "every round cuts a range"
        found = sorted(set(found) | more)


def _middle(low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """A splitter above the lowest key and not above the highest; among ids where keys are equal."""
    if low[0] < high[0]:
        return (low[0] + high[0]) // 2 + 1, LEAST
    return low[0], (low[1] + high[1]) // 2 + 1


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = written(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("_id"),
    ), "shard-keys")
    total = keys.agg(F.sum("size")).collect()[0][0] or 0
    found, sums = splitters(keys, total, shards)
    plan, before, counts = [], 0, {}
    for number, held, rows in sums:
        at = min(shards - 1, int(shards * (before + held / 2) / total))
        plan.append((number, at, counts.get(at, 0)))
        before, counts[at] = before + held, counts.get(at, 0) + rows
    ranges = keys.sparkSession.createDataFrame(plan, "_r int, shard int, _base long")
    within = Window.partitionBy("_range").orderBy("_key", "_id")
    return (
        keys.withColumn("_range", _range_of(found)("_key", "_id"))
        .withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(ranges), F.col("_range") == F.col("_r"))  # one row per range: bounded
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("_base") + F.col("_row") - 1).alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of each shard to its own folder; ids must be unique here."""
    docs.join(placed.select(F.col("doc_id").alias(id_col), "shard"), id_col).write.partitionBy(
        "shard").parquet(path)


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
