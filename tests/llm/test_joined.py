"""Joining the ids of parts: right, and with little memory for each id."""

import tracemalloc

import numpy as np

from halyard.llm.pieces import Parts


def test_joined_ids_and_memory():
    texts = [" ".join(str((i * j) % 50) for j in range(5000)) for i in range(20)] + [""]
    parts = Parts(texts, blank=False)
    ids = {p: (np.arange(20) + (1000 * int(p) if p else 7)).astype("<u4") for p in parts.distinct}
    values = [ids[p].tobytes() for p in parts.distinct]
    tracemalloc.start()
    got = parts.joined(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [g == b"".join(ids[w].tobytes() for w in t.split()) for t, g in zip(texts[:-1], got)] == [True] * 20
    assert sum(map(len, got)) // 4 >= 2_000_000 and peak < 15 * 2_000_000
