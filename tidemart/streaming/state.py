"""Running totals per user on a stream: native aggregation and custom keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemart.streaming.windows import EXACT

STATE = "cells binary"
OUTPUT = "user_id long, part int, n_events long, cents long, last_us long, lapsed boolean"
KEY = ["nobody", "user_id", "part"]
CELL = [*KEY, "n_events", "cents", "last_us", "wake"]
NEVER = -(1 << 62)
GROUPS = 4096


def running_totals(events: DataFrame) -> DataFrame:
    """Events, value and last event per user; partial sums are made before the shuffle."""
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("value").cast(EXACT)).cast("double").alias("total"),
        F.max("ts").alias("last_event"),
    )


def _folded(cells: np.ndarray) -> np.ndarray:
    """One row per key: counts and cents added, times and marks at their largest."""
    if not len(cells):
        return cells
    cells = cells[np.lexsort((cells[:, 2], cells[:, 1], cells[:, 0]))]
    starts = np.flatnonzero(np.r_[True, (cells[1:, :3] != cells[:-1, :3]).any(axis=1)])
    return np.column_stack([
        cells[starts, :3], np.add.reduceat(cells[:, 3:5], starts),
        np.maximum.reduceat(cells[:, 5:], starts),
    ])


def _advance(quiet_ms: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
             ) -> Iterator[pd.DataFrame]:
        kept = np.frombuffer(state.get[0] if state.exists else b"", "int64").reshape(-1, len(CELL))
        parts = [np.column_stack([kept, np.zeros(len(kept), "int64")])]
        for frame in frames:
            one, none = np.ones(len(frame), "int64"), np.zeros(len(frame), "int64")
            own = [frame[c].to_numpy("int64") for c in (*KEY, "cents", "us")]
            parts.append(_folded(np.column_stack([*own[:3], one, *own[3:], none, one])))
        cells = _folded(np.vstack(parts))
        last, wake, fresh = cells[:, 5], cells[:, 6], cells[:, 7] == 1
        now = state.getCurrentWatermarkMs()
        lapsed = ~fresh & (wake > 0) & (wake < now)
        again = last // 1000 + quiet_ms
        wake[fresh] = np.where(again > now, again, 0)[fresh].clip(0)
        wake[lapsed] = 0
        state.update((cells[:, :len(CELL)].tobytes(),))
        if (wake > 0).any():
            state.setTimeoutTimestamp(max(int(wake[wake > 0].min()), now))
        out = cells[fresh | lapsed]
        yield pd.DataFrame({
            "user_id": pd.arrays.IntegerArray(out[:, 1].copy(), out[:, 0] == 1),
            "part": out[:, 2], "n_events": out[:, 3], "cents": out[:, 4],
            "last_us": pd.arrays.IntegerArray(out[:, 5].copy(), out[:, 5] <= NEVER),
            "lapsed": lapsed[fresh | lapsed],
        })

    return step


def stateful_totals(events: DataFrame, parts: int = 16, quiet_hours: int = 24,
                    delay: str = "1 hour", groups: int = GROUPS) -> DataFrame:
    """Running totals in keyed state with an event-time timer.

    A user's events are spread over ``parts`` sub-keys by event id, so one busy user is not
    one task; ``fold_parts`` adds the parts up. A sub-key that stays quiet for
    ``quiet_hours`` gives a row marked ``lapsed``; its totals go on when events return.

    Python is entered once per group of sub-keys, of which there are ``groups`` by hash, not once
    per sub-key. A group's state is one cell per sub-key, its timer the earliest of theirs.
    """
    rows = events.withWatermark("ts", delay).select(
        "user_id", F.pmod(F.hash("event_id"), F.lit(parts)).alias("part"), "ts",
        F.coalesce((F.col("value").cast(EXACT) * 100).cast("long"), F.lit(0)).alias("cents"),
        F.coalesce(F.unix_micros("ts"), F.lit(NEVER)).alias("us"),
    ).select(
        F.pmod(F.xxhash64("user_id", "part"), F.lit(groups)).alias("group"),
        F.col("user_id").isNull().cast("long").alias("nobody"),
        F.coalesce("user_id", F.lit(0)).cast("long").alias("user_id"), "part", "ts", "cents", "us",
    )
    return rows.groupBy("group").applyInPandasWithState(
        _advance(quiet_hours * 3_600_000), OUTPUT, STATE, "update",
        GroupStateTimeout.EventTimeTimeout,
    )


def fold_parts(updates: DataFrame) -> DataFrame:
    """Per user totals from the updates of the sub-keys.

    The totals of a sub-key only grow, so its newest update is the largest one.
    """
    newest = updates.groupBy("user_id", "part").agg(
        F.max(F.struct("n_events", "cents", "last_us")).alias("newest")
    )
    return newest.groupBy("user_id").agg(
        F.sum("newest.n_events").alias("n_events"),
        (F.sum("newest.cents") / 100).alias("total"),
        F.timestamp_micros(F.max("newest.last_us")).alias("last_event"),
    )
