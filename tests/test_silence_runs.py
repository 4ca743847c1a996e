"""The watch for silent services keeps runs of samples, not samples, and a watermark inside a run is no silence."""

from types import SimpleNamespace

import numpy as np
import pandas as pd

from halyard.streaming import stateful as S
from tests.test_silence_memory import Held, Value

GAP = 5_000


def watch():
    held, timers, value, w = Held(), [], Value(), S.SilenceWatch(GAP)
    w.init(SimpleNamespace(getListState=lambda *a: held, getValueState=lambda *a: value, registerTimer=timers.append))
    return w, held, timers


def feed(w, times, frames=3):
    list(w.handleInputRows(("a",), iter([pd.DataFrame({"t_us": t, "status": ["healthy"] * len(t)}) for t in np.array_split(times, frames)]), None))


def expire(w, ms):
    at = SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    return [tuple(r) for df in w.handleExpiredTimer(("a",), at, None) for r in df.astype(object).itertuples(index=False)]


def test_a_run_of_any_length_is_two_times_in_the_state():
    w, held, _ = watch()
    times = np.arange(0, 30_000_000, 1_000)
    feed(w, np.random.default_rng(1).permutation(np.concatenate([times, times + 40_000_000])))
    assert sum(len(value) for value, in held.rows) == 2 * 16
    assert expire(w, 80_000) == [("a", 29_999_000 + GAP, 40_000_000), ("a", 69_999_000 + GAP, pd.NA)] and not held.rows


def test_runs_beyond_the_bound_go_to_the_state_and_are_joined_there(monkeypatch):
    monkeypatch.setattr(S, "RUNS", 8)
    w, held, _ = watch()
    feed(w, np.arange(0, 200_000, 10_000), frames=10)          # 20 runs
    assert len(held.rows) > 1
    feed(w, np.arange(5_000, 200_000, 10_000), frames=1)       # what joins them
    assert expire(w, 400) == [("a", 195_000 + GAP, pd.NA)]


def test_the_watermark_may_stand_inside_a_run():
    w, held, timers = watch()
    feed(w, np.arange(0, 100_000, 4_000))
    assert expire(w, 50) == [] and timers[-2] == 96            # wakes when the run has ended
    feed(w, np.array([99_000, 120_000]))
    assert expire(w, 110) == [("a", 99_000 + GAP, pd.NA)]
    assert expire(w, 200) == [("a", 99_000 + GAP, 120_000), ("a", 120_000 + GAP, pd.NA)] and not held.rows
