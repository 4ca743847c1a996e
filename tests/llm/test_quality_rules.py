"""Base figures against a plain count, the distances, references, edges."""

import math
import random
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from halyard.llm import quality_rules as Q


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i:i + 3]), []).append(i)
    again = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(3)}
    base = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), base)


def rows_of(docs):
    out = Q.apply_rules(docs).select("_row.doc_id", "_row.text", "_q.*", "_verdict.*").collect()
    return [(r["text"], tuple(r[c] for c in Q.MEASURES) + (r["base_failed"],), r) for r in out]


def test_base_figures_and_edges(make_docs, edge_rows):
    odd = [(20 + i, t, "en") for i, t in enumerate([
        "a b c a b c", "a b c d a b c", "x x x x", "a\nb\na\n\n \n a", "one two\tthree\x0bfour\x0cfive\rsix\x1cseven", "é#ü %% <b>|&$", "a b a b a b a b"])]
    got = rows_of(make_docs(edge_rows + odd))
    assert len(got) == len(edge_rows + odd)
    for text, figures, _ in got:
        assert figures == plain(text), (text or "")[:60]


def test_registered_query_counts_whole_texts(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in E.queries()["op1_quality_rules"](spark, sf).collect():
        assert (*[r[c] for c in Q.MEASURES], r["base_failed"]) == plain(texts[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])


def test_distance_is_jensen_shannon(spark):
    def js(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
        return math.sqrt((kl(p) + kl(q)) / 2)
    for p, q in [([.5, .5, 0.], [.5, .5, 0.]), ([1., 0., 0.], [0., 0., 1.]), ([.2, .3, .5], [.6, .1, .3])]:
        df = spark.createDataFrame([(p, q)], "p array<double>, q array<double>")
        got = df.select(Q.js_distance(F.col("p"), F.col("q"), Q._entropy_terms(F.col("p")), Q._entropy_terms(F.col("q")))).first()[0]
        assert abs(got - js(p, q)) < 1e-7


def test_junk_goes_and_prose_stays(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = E.queries()["op1_quality_rules"](spark, sf).where("not base_failed").join(labels, "doc_id")
    by = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) == 0 and by.get((0, True), 0) <= 1


def prose(rng, n):
    """English-like prose: a third common words, invented other ones, capitals and marks."""
    common, words = "the of and to in is that for it with as on by at are was this".split(), []
    for i in range(n):
        words.append(rng.choice(common) if rng.random() < .4 else "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9))))
    return ". ".join(" ".join(words[i:i + 12]).capitalize() for i in range(0, n, 12)) + "."


def test_salad_goes_and_rare_labels_make_no_reference(make_docs):
    rng = random.Random(21)
    salad = ". ".join(" ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9))) for _ in range(12)).capitalize() for _ in range(100)) + "."
    junk = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOP0123456789!?") for _ in range(8)) for _ in range(200))
    rows = [(i, prose(rng, 400), "en") for i in range(30)] + [(100, salad, "en"), (101, junk, "zz"), (102, junk + " X", "en"), (103, prose(rng, 900), None)]
    kept = {r["doc_id"]: r["kept"] for *_, r in rows_of(make_docs(rows))}
    assert all(kept[i] for i in range(30)) and kept[103]
    assert not kept[100] and not kept[101] and not kept[102]


def test_empty_table_and_no_reference(empty_docs, make_docs):
    assert Q.apply_rules(empty_docs).count() == 0
    only = rows_of(make_docs([(1, "word other third " * 20, None)]))
    assert [r["kept"] for *_, r in only] == [False]  # repeats itself
    fresh = " ".join(f"w{i}" for i in range(60))
    assert [r["kept"] for *_, r in rows_of(make_docs([(1, fresh, None)]))] == [True]  # nothing to compare with


def test_main_path_has_no_python(make_docs, edge_rows):
    m = Q.measure(make_docs(edge_rows))
    plan = Q.judge(m, Q.references(m))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
