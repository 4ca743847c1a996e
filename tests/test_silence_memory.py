"""The watch for silent services holds few times as Python objects and gives what a plain walk gives."""

from types import SimpleNamespace

import numpy as np
import pandas as pd

from halyard.streaming import stateful as S


class Held:
    def __init__(self):
        self.rows, self.most = [], 0

    def appendList(self, rows):
        self.rows, self.most = self.rows + rows, max(self.most, len(rows))

    def put(self, rows):
        self.rows, self.most = list(rows), max(self.most, len(rows))

    def get(self):
        return iter(self.rows)

    def clear(self):
        self.rows = []


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_many_times_of_one_service_go_in_parts():
    watch, held, timers = S.SilenceWatch(5_000), Held(), []
    watch.init(SimpleNamespace(getListState=lambda *a: held, getValueState=lambda *a: Value(), registerTimer=timers.append))
    t = np.random.default_rng(3).integers(0, 10**8, 45_000)
    frames = [pd.DataFrame({"t_us": t[:44_000], "status": ["healthy"] * 44_000}), pd.DataFrame({"t_us": t[44_000:], "status": ["down"] * 1000})]
    list(watch.handleInputRows(("a",), iter(frames), None))
    assert held.most <= 10_000 and timers == [-(-int(t[:44_000].min()) // 1000)]
    out = []
    for ms in (30_000, 60_000, 200_000):
        at = SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
        out += [tuple(r) for df in watch.handleExpiredTimer(("a",), at, None) for r in df.astype(object).itertuples(index=False)]
    s = sorted(t[:44_000].tolist())
    plain = [("a", a + 5_000, b) for a, b in zip(s, s[1:]) if b - a > 5_000]
    assert [r for r in out if r[2] is not pd.NA] == plain
    assert out[-1][:2] == ("a", s[-1] + 5_000) and out[-1][2] is pd.NA and held.most <= 10_000 and not held.rows
