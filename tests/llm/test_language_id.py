import random

import numpy as np

import __spark_entry__ as E
from halyard.llm import language_id as L


def test_held_out_accuracy(spark, sf):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = E.queries()["op8_language_id"](spark, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(langs) and held
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_slices_answer_like_one_filter_a_language():
    rng = np.random.default_rng(2)
    grams = {f"l{i:02}": rng.integers(0, 1 << 60, 500, dtype=np.uint64) for i in range(70)}  # two words of bits
    filters = L.BitSlicedFilters(grams)
    for i in (0, 1, 63, 64, 69):
        assert filters.counts(grams[f"l{i:02}"])[i] == 500  # no false negatives
    fresh = rng.integers(0, 1 << 60, 200_000, dtype=np.uint64)
    rate = filters.counts(fresh) / len(fresh)
    assert np.all(np.abs(rate - filters.false_rate) < 1e-3)


def test_chunks_change_nothing(monkeypatch):
    text = "Der Weg, den wir gehen -- ist lang! " * 50
    whole = np.concatenate(list(L.trigrams(text)))
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(L, "CHUNK", size)
        assert np.array_equal(np.concatenate(list(L.trigrams(text))), whole)


def test_edges(spark, make_docs, edge_rows, empty_docs):
    out = {r["doc_id"]: r["_language"] for r in L.identify(spark, make_docs(edge_rows)).select("_row.doc_id", "_language").collect()}
    assert len(L.identify(spark, make_docs(edge_rows)).collect()) == len(edge_rows)
    for i in (3, 4, 5, 6, 8):
        assert (out[i]["lang_pred"], out[i]["score"]) == ("und", 0.0)
    assert L.identify(spark, empty_docs).count() == 0
    untaught = L.identify(spark, make_docs([(1, "some words", None)])).first()["_language"]
    assert untaught["lang_pred"] == "und"


def test_counts_equal_plain_sets():
    """Per-language counts of texts' trigrams against sets, and the decision against the largest plain count."""
    rng = random.Random(4)
    letters = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "mnopqrst"}
    word = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 8)))
    grams = {lang: np.unique(np.concatenate(list(L.trigrams(" ".join(word(lang) for _ in range(400)))))) for lang in letters}
    sets, filters = {lang: set(g.tolist()) for lang, g in grams.items()}, L.BitSlicedFilters(grams)
    for _ in range(200):
        lang = rng.choice(sorted(letters))
        text = " ".join(word(lang) for _ in range(30)) + " " + " ".join(word(rng.choice(sorted(letters))) for _ in range(5))
        keys = np.concatenate(list(L.trigrams(text)))
        plain = [sum(k in sets[x] for k in keys.tolist()) for x in sorted(sets)]
        got = filters.counts(keys)
        assert all(p <= g <= p + 2 for p, g in zip(plain, got))  # a filter only ever lets more through
        assert filters.decide(text)[0] == sorted(sets)[int(np.argmax(plain))]
