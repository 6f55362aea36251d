"""Keyed state that enters Python once per group of keys, with the timers of every key."""

import pandas as pd

from tidemart.streaming import state


class _State:
    """What a step sees of Spark's group state."""

    def __init__(self):
        self.value, self.timer, self.mark = None, None, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value, self.timer = value, None

    def getCurrentWatermarkMs(self):
        return self.mark

    def setTimeoutTimestamp(self, ms):
        assert ms >= self.mark
        self.timer = ms


def _run(held, rows):
    frames = [pd.DataFrame(rows, columns=[*state.KEY, "cents", "us"])] if rows else []
    out = pd.concat(state._advance(1000)((0,), iter(frames), held))
    return sorted((r.user_id if r.user_id is not pd.NA else None, r.n_events, r.cents, r.lapsed)
                  for r in out.itertuples())


def test_every_key_of_a_group_has_its_own_totals_and_timer():
    held = _State()
    assert _run(held, [(0, 7, 1, 10, 2_000_000), (0, 8, 1, 5, 4_000_000), (0, 7, 1, 1, 1_000_000)]) == [
        (7, 2, 11, False), (8, 1, 5, False)]
    assert held.timer == 3000
    held.mark = 3500  # 7 is due, 8 goes on with another event
    assert _run(held, [(0, 8, 1, 5, 4_500_000)]) == [(7, 2, 11, True), (8, 2, 10, False)]
    assert held.timer == 5500
    held.mark = 6000
    assert _run(held, []) == [(8, 2, 10, True)]
    assert held.timer is None
    assert _run(held, [(0, 7, 1, 1, 9_000_000)]) == [(7, 3, 12, False)]
    assert held.timer == 10_000


def test_no_user_is_a_key_of_its_own_and_no_time_sets_no_timer():
    held = _State()
    assert _run(held, [(1, 0, 1, 3, state.NEVER)]) == [(None, 1, 3, False)]
    assert held.timer is None
    assert _run(held, [(0, 0, 1, 4, 1_000_000)]) == [(0, 1, 4, False)]


def test_one_call_per_group_not_per_key(spark):
    rows = spark.range(2000).selectExpr(
        "id as event_id", "timestamp_seconds(id) as ts", "id as user_id", "cast(1.5 as double) as value")
    plan = state.stateful_totals(rows, groups=8)._jdf.queryExecution().analyzed().toString()
    assert "group#" in plan and plan.count("FlatMapGroupsInPandasWithState") == 1
