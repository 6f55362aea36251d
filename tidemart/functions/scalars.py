"""Column expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6


def as_double(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, null where the divisor is zero or null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean_of(total: Column, count: Column) -> Column:
    """A mean from an exact total and a count, so partial sums give the same bits."""
    return ratio(total, count)


def mean(col: Column | str) -> Column:
    """Aggregate mean computed as exact sum over non-null count."""
    col = F.col(col) if isinstance(col, str) else col
    return ratio(F.sum(col), F.count(col))


def sixth(col: Column) -> Column:
    return F.round(col.cast("double"), DIGITS)


def whole_hours(start: Column, end: Column) -> Column:
    """Full hours between two timestamps, truncated toward zero."""
    return F.timestamp_diff("HOUR", start, end)


def at_time(day: Column, clock: Column) -> Column:
    """The timestamp on ``day`` at the time of day of ``clock``."""
    return F.try_make_timestamp(
        F.year(day), F.month(day), F.dayofmonth(day), F.hour(clock), F.minute(clock),
        F.second(clock))


def chosen_by(rank: Column, value: Column) -> Column:
    """Aggregate: the value with the highest rank, ties to the smallest value."""
    return F.min(F.struct((-rank).alias("rank"), value.alias("value")))["value"]


def _digest_number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash_unit(purpose: str, seed: int | str, *cols: str | Column) -> Column:
    """A number in [0, 1) fixed by the columns and the seed, whatever the partitioning.

    Samples, splits, folds and rungs of one seed must not depend on each other, so each names its
    purpose.
    """
    return _digest_number(
        F.concat_ws("|", F.lit(f"{purpose}{seed}"), *cols), 8) / F.lit(4294967296.0)


def surrogate_key(*cols: str | Column) -> Column:
    """A 60-bit key that depends on the business columns alone, so re-runs agree."""
    return _digest_number(F.concat_ws("|", *cols), 15)
