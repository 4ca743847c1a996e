import random
import re

import __spark_entry__ as E
from halyard.llm import license_scan as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for label, phrase in S.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(texts, rows):
    assert sorted(map(repr, ((t, *plain(t)) for t in texts))) == sorted(map(repr, rows))


def test_base_places_against_plain_search(spark, make_docs, edge_rows):
    odd = ["Under the MIT License. under the mit license", "under the MIT\nLICENSE, Apache-License;Version 2", "CC BY-NC", "cc by nc cc by nc by nc",
           "K under the mit lİcense", "under the mit licenseé", "under the mit", "apache license version 2.0 or version 20"]
    rows = edge_rows + [(100 + i, t, "en") for i, t in enumerate(odd)]
    ids = {i: t for i, t, _ in rows}
    out = S.scan(spark, make_docs(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] is not None:
            assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain(ids[r["doc_id"]])
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_registered_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = E.queries()["op3_license_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain(texts[r["doc_id"]])


def test_neighbouring_diagonals_merge(spark, make_docs):
    whole = dict(S.MORE)["bsd"].split()
    added = whole[:6] + ["any"] + whole[6:]
    cut = whole[:3] + ["and"] + whole[9:]
    out = {r["doc_id"]: r for r in S.scan(spark, make_docs([(1, " ".join(added), "en"), (2, " ".join(cut), "en"),
                                                            (3, "gnu general public license version 3", "en")])).collect()}
    assert out[1]["labels"] == "bsd" and 0.6 <= out[1]["score"] < 1
    assert out[2]["labels"] == "" and out[3]["labels"] == "gpl-3"


def test_whole_license_texts_with_changed_words(spark, make_docs):
    """Every license text alone, and inside prose with one word in twenty changed; its beginning alone is not enough."""
    rng = random.Random(5)
    rows, want = [], {}
    for i, (label, text) in enumerate(S.TEXTS):
        words = text.split()
        for at in rng.sample(range(len(words)), len(words) // 20):
            words[at] = "changed" + str(at)
        rows += [(2 * i, text, "en"), (2 * i + 1, "Some words before. " * 9 + " ".join(words) + " and after it. " * 9, "en")]
        want |= {2 * i: label, 2 * i + 1: label}
    rows.append((100, " ".join(dict(S.TEXTS)["zlib"].split()[:40]), "en"))
    out = {r["doc_id"]: r for r in S.scan(spark, make_docs(rows)).collect()}
    for i, label in want.items():
        assert label in out[i]["labels"].split(",") and out[i]["score"] >= 0.6, (i, out[i])
        assert set(out[i]["labels"].split(",")) <= {label, "apache-2", "gpl-3"}
    assert out[100]["labels"] == ""


def test_further_templates_and_no_list(spark, make_docs, monkeypatch):
    more = spark.createDataFrame([("own", "these words are the whole of our own license and nothing else is"), ("short", "too short"), ("none", None)], "label string, text string")
    docs = make_docs([(1, "So: these words are the whole of our own license and nothing else is.", "en"), (2, "under the MIT license", "en"), (3, None, "en")])
    want = sorted(map(tuple, S.scan(spark, docs, more=more).collect()), key=str)
    assert [r[6] for r in sorted(want)] == ["own", "mit", ""]
    monkeypatch.setattr(S, "LISTED", 10)  # every k-gram goes to the join
    assert sorted(map(tuple, S.scan(spark, docs, more=more).collect()), key=str) == want


def test_empty_table(spark, empty_docs):
    assert S.scan(spark, empty_docs).count() == 0
