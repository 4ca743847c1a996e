import math
import random

import numpy as np

import __spark_entry__ as E
from halyard.llm import toxicity as X


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))


def test_held_out_ranking(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = E.queries()["op4_toxicity"](spark, sf).collect()
    held = [(r["score"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert auc(held) >= 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_features():
    f = X.Features({"idiot": 3.0}, {"idio": 1.5})
    row = dict(zip(X.FEATURES, f.row("You idiot! An 1d1ot, they said.")))
    assert row["word_hits"] == 1 and row["word_top"] == 3.0 and row["near_you"] == 1.0
    assert row["hidden_hits"] == 1 and row["obfuscated"] > 0 and row["stem_hits"] == 1
    assert f.row(None) == f.row("") == [0.0] * len(X.FEATURES)


def test_edges(spark, make_docs, edge_rows, empty_docs):
    docs = make_docs(edge_rows)
    labels = spark.createDataFrame([(1, 1, 1), (7, 0, 0), (7, 0, 0), (8, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0), labels.where("toxic = 1")):
        out = X.learn(spark, docs, marks).score(spark, docs).collect()
        assert len(out) == len(edge_rows) and all(0 <= r["_score"] <= 1 for r in out)
    assert X.learn(spark, empty_docs, labels).score(spark, empty_docs).count() == 0


def plain_row(text, words, stems):
    """The features one part at a time, straight from their descriptions."""
    parts = text.lower().split()
    if not parts:
        return [0.0] * len(X.FEATURES)
    hits, beginnings, you, obfuscated, hidden = [], [], [], 0, 0
    for i, part in enumerate(parts):
        core, reading = X.core_of(part)
        known = [core[:n] for n in X.STEMS if core[:n] in stems]
        if core in words:
            hits.append((i, core))
        if known:
            beginnings.append(max(known, key=stems.get))
        if core in X.SECOND_PERSON:
            you.append(i)
        obfuscated += bool(reading)
        hidden += bool(reading) and reading in words and core not in words
    n, size = len(parts), len(text.encode())
    ww, sw = [words[c] for _, c in hits], [stems[c] for c in beginnings]
    near = sum(any(abs(i - y) <= X.NEAR for y in you) for i, _ in hits)
    share = lambda chars: sum(b in chars.encode() for b in text.encode()) / size
    return [math.log1p(n), len(hits), 100 * len(hits) / n, len({c for _, c in hits}), 100 * sum(ww) / n, max(ww, default=0),
            len(sw), 100 * len(sw) / n, len(set(beginnings)), 100 * sum(sw) / n, max(sw, default=0), sum(sw) / len(sw) if sw else 0,
            near / len(hits) if hits else 0, share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("!?"), share("#*$%&|<>@_~^"), 100 * obfuscated / n, hidden]


def test_features_equal_a_plain_count(spark, sf):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(150).collect()]
    rng = random.Random(3)
    cores = sorted({X.core_of(p)[0] for t in texts for p in t.lower().split()} - {""})
    words = {w: rng.uniform(1, 4) for w in rng.sample(cores, 400)}
    stems = {w[:n]: rng.uniform(1, 4) for w in rng.sample(cores, 400) for n in X.STEMS if len(w) >= n}
    f = X.Features(words, stems)
    for t in [*texts, "You 1d1ot!! U*u @#", "é " * 50]:
        assert np.allclose(f.row(t), plain_row(t, words, stems), atol=1e-9)
