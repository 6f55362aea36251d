"""Latest-value and historised dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.relational import latest_by


def scd1_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The newest row per key over target and batch; a replayed batch changes nothing."""
    return latest_by(target.unionByName(batch.select(*target.columns)), keys, [seq])


def scd2_history(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective: str,
                 sequence: Sequence[str] = ()) -> DataFrame:
    """Validity intervals from a log of dated observations.

    A version opens when a tracked column differs from the day before it in the log and ends
    where the next one opens. Several observations of a key on one day fold into the last by
    ``sequence`` (the largest without one) before the window, so a key's group holds at most one
    row per day.
    """
    daily = log.groupBy(*keys, effective).agg(
        F.max_by(F.struct(*tracked), F.struct(*sequence, *tracked)).alias("seen")
    )
    return _intervals(daily, keys, tracked, effective)


def _intervals(daily: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective: str
               ) -> DataFrame:
    in_time = Window.partitionBy(*keys).orderBy(effective)
    before = F.lag("seen").over(in_time)
    changed = daily.withColumn("changed", ~before.eqNullSafe(F.col("seen"))).filter("changed")
    return changed.select(
        *keys,
        *[F.col(f"seen.{c}").alias(c) for c in tracked],
        F.col(effective).alias("start_date"),
        F.lead(effective).over(in_time).alias("end_date"),
        F.lead(effective).over(in_time).isNull().alias("is_current"),
    )


def scd2_merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               effective: str) -> DataFrame:
    """Merge dated observations into intervals.

    The target is read back as observations at its start dates, so a late observation splits
    the interval it falls into, and replaying a batch gives the same intervals. On one day the
    batch wins over the target.
    """
    held = target.select(
        *keys, F.col("start_date").alias(effective), F.struct(*tracked).alias("seen"),
        F.lit(0).alias("from_batch"),
    )
    fresh = batch.select(
        *keys, effective, F.struct(*tracked).alias("seen"), F.lit(1).alias("from_batch")
    )
    daily = (
        held.unionByName(fresh)
        .groupBy(*keys, effective)
        .agg(F.max(F.struct("from_batch", "seen")).alias("best"))
        .select(*keys, effective, F.col("best.seen").alias("seen"))
    )
    return _intervals(daily, keys, tracked, effective)


def as_of_join(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str,
               carried: Sequence[str], unit: str = "month") -> DataFrame:
    """Facts with the columns ``carried`` of the version of their key that held on day ``at``.

    Facts and versions meet per key and ``unit`` of the calendar. A version is placed where it
    starts, and every (key, unit) that holds facts also gets the version that was open when it
    began, so a long history is not repeated for the units it spans, and a fact is compared with
    the versions of its own unit and one more. The join is on equal keys, so a key with many facts
    can be split. ``versions`` has start_date and end_date, null for the open one, without overlap.
    A fact with a null key or day, or before the first version, keeps nulls.
    """
    version = F.struct("start_date", "end_date", *carried)
    opened = versions.select(
        *keys, F.trunc("start_date", unit).alias("_unit"), version.alias("_version"))
    placed = facts.withColumn("_unit", F.trunc(at, unit))
    newest = opened.groupBy(*keys, "_unit").agg(
        F.max_by("_version", "_version.start_date").alias("_newest"), F.lit(False).alias("_asked"))
    asked = placed.select(*keys, "_unit").distinct().withColumn("_asked", F.lit(True))
    before = Window.partitionBy(*keys).orderBy("_unit").rowsBetween(
        Window.unboundedPreceding, -1)  # a row per unit of the calendar
    carry = newest.unionByName(asked, allowMissingColumns=True).groupBy(*keys, "_unit").agg(
        F.max_by("_newest", "_newest.start_date").alias("_newest"), F.max("_asked").alias("_asked")
    ).select(
        *keys, "_unit", "_asked", F.last("_newest", ignorenulls=True).over(before).alias("_version")
    ).filter("_asked and _version is not null").drop("_asked")
    held = opened.unionByName(carry)
    day, kept = F.col(at), facts.columns
    within = [placed[k] == held[k] for k in (*keys, "_unit")] + [
        day >= F.col("_version.start_date"),
        F.col("_version.end_date").isNull() | (day < F.col("_version.end_date"))]
    return placed.join(held, within, "left").select(
        *[placed[c] for c in kept], *[F.col(f"_version.{c}").alias(c) for c in carried])
