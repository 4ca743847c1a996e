"""Stateful stream operators with event-time timers: the rate limiter and the watch for silent services.

Both wait until the watermark has passed a row before they decide it, so rows may come in any order within the
delay; a row that comes later than that is dropped by the stream and counted in its progress.  State is kept per
client or service: the rows that still wait, and what decisions need (``limit`` accepted times, or one time).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DECIDED = "request_id long, client_id long, t_us long, rejected boolean"
SILENT = "service string, from_us long, until_us long"
BATCH = 10_000  # runs in one value of the state
RUNS = 1 << 18  # runs of a service held before they go to the state


def _after(t_us: int) -> int:
    """The first whole millisecond at or after a time."""
    return -(-t_us // 1000)


class RateLimiter(StatefulProcessor):
    """Rejects a request when ``limit`` accepted ones of its client lie less than ``window_us`` before it."""

    def __init__(self, limit: int, window_us: int):
        self.limit, self.window_us = limit, window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, request long")
        self.accepted = handle.getListState("accepted", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(t, r) for df in rows for t, r in zip(df["t_us"].tolist(), df["request_id"].tolist())]
        self.waiting.appendList(new)
        self.handle.registerTimer(_after(min(new)[0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self.waiting.get())
        due = [r for r in rows if r[0] <= upto]
        if not due:
            return
        if len(due) < len(rows):
            self.waiting.put(rows[len(due):])
            self.handle.registerTimer(_after(rows[len(due)][0]))
        else:
            self.waiting.clear()
        held, rejected = sorted(t for t, in self.accepted.get()), []
        for t, _ in due:
            while held and t - held[0] >= self.window_us:
                held.pop(0)  # at most ``limit`` of them
            rejected.append(len(held) >= self.limit)
            if not rejected[-1]:
                held.append(t)
        self.accepted.put([(t,) for t in held])
        yield pd.DataFrame({"request_id": [r for _, r in due], "client_id": [key[0]] * len(due), "t_us": [t for t, _ in due], "rejected": rejected})

    def close(self) -> None:
        pass


def joined(runs: np.ndarray, gap_us: int) -> np.ndarray:
    """(first, last) of runs, those at most ``gap_us`` apart made one; in order.  Inside a run no two neighbours lie further apart."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    last = np.maximum.accumulate(runs[:, 1])
    apart = runs[1:, 0] - last[:-1] > gap_us
    some = np.full(min(len(runs), 1), True)
    return np.column_stack([runs[np.concatenate([some, apart]), 0], last[np.concatenate([apart, some])]])


class SilenceWatch(StatefulProcessor):
    """Reports a service (from, null) once no healthy sample came for ``gap_us``, and (from, until) when one comes again.

    Only where a run of samples begins and ends can matter, so runs wait, up to BATCH of them in one value of the state.
    """

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "runs binary")
        self.last = handle.getValueState("last", "t long, reported boolean")

    def _values(self, runs: np.ndarray) -> list[tuple[bytearray]]:
        return [(bytearray(runs[at:at + BATCH].tobytes()),) for at in range(0, len(runs), BATCH)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, runs, held = None, [], 0
        for df in rows:  # a service may have very many rows in a batch: what is held is joined, and stored beyond RUNS
            new = df.loc[df["status"] == "healthy", "t_us"].dropna().to_numpy(np.int64)
            if not len(new):
                continue
            first = int(new.min()) if first is None else min(first, int(new.min()))
            runs.append(joined(np.column_stack([new, new]), self.gap_us))
            held += len(runs[-1])
            if held > RUNS:
                runs = [joined(np.concatenate(runs), self.gap_us)]
                held = len(runs[0])
                if held > RUNS // 2:
                    self.waiting.appendList(self._values(runs[0]))
                    runs, held = [], 0
        if runs:
            self.waiting.appendList(self._values(joined(np.concatenate(runs), self.gap_us)))
        if first is not None:
            self.handle.registerTimer(_after(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        stored = [np.frombuffer(value, np.int64).reshape(-1, 2) for value, in self.waiting.get()]  # 16 bytes a run
        runs = joined(np.concatenate(stored), self.gap_us) if stored else np.empty((0, 2), np.int64)
        begun = int(np.searchsorted(runs[:, 0], now, "right"))
        due, later = runs[:begun].copy(), runs[begun:]
        timers = [int(t) for t in later[:1, 0]]
        if begun and due[-1, 1] > now:  # the watermark is inside a run: no silence before its end
            timers = [int(due[-1, 1])]
            later = np.concatenate([[[now, due[-1, 1]]], later])
            due[-1, 1] = now
        if len(later):
            self.waiting.put(self._values(later))
            self.handle.registerTimer(_after(timers[0]))
        elif len(runs):
            self.waiting.clear()
        last, reported = self.last.get() if self.last.exists() else (None, False)
        out, ended = [], None
        if len(due):
            until, start = due[:, 0], due[:, 1]
            start, until = (start[:-1], until[1:]) if last is None else (np.concatenate([[last], start[:-1]]), until)
            silent = until - start > self.gap_us
            ended = start[silent] + self.gap_us, until[silent]
            last, reported = int(due[-1, 1]), False
        if last is not None and not reported:
            if now > last + self.gap_us:
                out.append((key[0], last + self.gap_us, None))
                reported = True
            else:
                self.handle.registerTimer(_after(last + self.gap_us + 1))
        if last is not None:
            self.last.update((last, reported))
        for at in range(0, len(ended[0]) if ended else 0, BATCH):
            starts, ends = (t[at:at + BATCH] for t in ended)
            yield pd.DataFrame({"service": [key[0]] * len(starts), "from_us": starts, "until_us": pd.array(ends, "Int64")})
        if out:
            yield pd.DataFrame(out, columns=["service", "from_us", "until_us"]).astype({"until_us": "Int64"})

    def close(self) -> None:
        pass
