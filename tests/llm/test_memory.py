"""What a Python worker holds between batches."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from halyard.llm import decontaminate, language_id, order_minhash, pieces
from halyard.llm.common import by_batch

HELD = """
import re
import numpy as np, pandas as pd, pyarrow as pa
from halyard.llm.common import by_batch
from halyard.llm.pieces import Parts

def held():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def work(texts):
    Parts(texts, blank=True)
    return pd.DataFrame({"n": [len(texts)]})

rng = np.random.default_rng(1)
batches = [pd.Series([" ".join(map(str, rng.integers(0, 1 << 40, 300))) for _ in range(600)]) for _ in range(4)]
assert [len(x) for x in by_batch(work, iter(batches))] == [1] * 4
now = held()
pa.default_memory_pool().release_unused()
print(now - held())
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory is read from /proc")
def test_a_worker_keeps_no_freed_arrow_memory():
    root = str(Path(__file__).parents[2])
    said = subprocess.run([sys.executable, "-c", HELD], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, check=True, timeout=120)
    assert float(said.stdout) < 8  # MB


def test_by_batch_gives_each_batch_its_rows():
    frames = list(by_batch(lambda texts: pd.DataFrame({"t": texts}), iter([pd.Series(["a", None]), pd.Series([], dtype=object), pd.Series(["b"])])))
    assert [f["t"].tolist() for f in frames] == [["a", None], [], ["b"]]


def test_stages_that_encode_nothing_give_up_memories(spark, monkeypatch):
    monkeypatch.setattr(language_id, "map_text", lambda text, fn, schema: fn)
    monkeypatch.setattr(decontaminate.F, "pandas_udf", lambda schema: lambda fn: lambda text: fn)
    block = next(decontaminate.blocks(spark.createDataFrame([(1, "a passage of the benchmark")], "item_id long, text string")))
    model = language_id.BitSlicedFilters({"en": np.arange(9, dtype=np.uint64)})
    texts = ["some words of a text", None]
    for stage in (language_id.predict(spark, None, model), order_minhash._sketch_texts, lambda t: decontaminate.hits(spark, None, block)(pd.Series(t))):
        assert pieces.revive(str, "memories") == "memories" and pieces._held
        assert len(stage(texts)) == 2
        assert not pieces._held
