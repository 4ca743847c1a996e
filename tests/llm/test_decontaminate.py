import random

import __spark_entry__ as E
from halyard.llm import decontaminate as D


def text_of(rng, n):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edit(rng, s, n):
    s = list(s)
    for _ in range(n):
        i, o = rng.randrange(len(s)), rng.random()
        if o < .4:
            s[i] = "z"
        elif o < .7:
            s.insert(i, "q")
        else:
            s.pop(i)
    return "".join(s)


def test_no_occurrence_within_the_budget_is_missed():
    rng = random.Random(3)
    items = [text_of(rng, rng.randint(4, 60)) for _ in range(40)]
    block = D.Block([p for i, t in enumerate(items) for p in D.patterns(i, t)])
    for _ in range(300):
        i = rng.randrange(len(items))
        pattern = D._string(rng.choice(list(D.patterns(i, items[i])))[1])
        doc = text_of(rng, 100) + " " + edit(rng, pattern, rng.randint(0, D.budget(len(pattern)))) + " " + text_of(rng, 30)
        assert i in {h[0] for h in D.scan(doc, block)}


def test_excerpts_of_long_items_are_found_at_any_offset():
    rng = random.Random(5)
    item = text_of(rng, 110)
    plain = D._string(D.normal(item)[0])
    block = D.Block(list(D.patterns(9, item)))
    for at in range(0, len(plain) - 200 + 1, 3):  # before, offsets of about 25 to 75 after a hundred were missed
        for edits in (0, 20)[:1 if at % 5 else 2]:
            part = list(plain[at:at + 200])
            for i in rng.sample(range(200), edits):
                part[i] = "z"
            doc = text_of(rng, 40) + "".join(part) + text_of(rng, 40)
            assert [h[0] for h in D.scan(doc, block)] == [9], (at, edits)
    doc = text_of(rng, 40) + " " + item + " " + text_of(rng, 40)
    (_, edits, first, last), = D.scan(doc, block)
    assert edits == 0 and doc[first:last + 1] == item


def test_strangers_stay():
    rng = random.Random(4)
    block = D.Block([p for i in range(40) for p in D.patterns(i, text_of(rng, 40))])
    assert not any(D.scan(text_of(rng, 300), block) for _ in range(200))


def test_alignment_is_the_semi_global_distance():
    rng = random.Random(6)

    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)
    for _ in range(2000):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 10)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 20)))
        assert D.best_end(p, t)[0] == min(plain(p, t), len(p))


def test_pieces_of_long_texts(monkeypatch):
    rng = random.Random(7)
    item = text_of(rng, 30)
    block = D.Block(list(D.patterns(5, item)))
    doc = text_of(rng, 3000) + " " + item + " " + text_of(rng, 500)
    want = D.scan(doc, block)
    monkeypatch.setattr(D, "PIECE", 700)
    assert D.scan(doc, block) == want and doc[want[0][2]:want[0][3] + 1].strip() == item


def test_short_items_match_as_whole_words():
    block = D.Block([p for i, t in enumerate(["Hello", "a b", "日本", "x"]) for p in D.patterns(i, t)])
    assert D.scan("Say: HELLO, world", block) == [(0, 0, 5, 9)]
    assert D.scan("hello a, B. hello!", block) == [(0, 0, 0, 16), (1, 0, 6, 9)]
    assert D.scan("othello hellos ab 日本語", block) == []
    assert [h[0] for h in D.scan("日本 x", block)] == [2, 3]


def test_runs_of_one_character_take_little_memory():
    import tracemalloc
    block = D.Block(list(D.patterns(1, "a" * 200)) + list(D.patterns(2, "b" * 500)))
    doc = "a" * 60_000
    tracemalloc.start()
    got = D.scan(doc, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [h[:3] for h in got] == [(1, 0, 0)] and got[0][3] >= len(doc) - 200 and peak < 200 << 20


def test_halving_changes_nothing(monkeypatch):
    rng = random.Random(11)
    items = [text_of(rng, 50) for _ in range(10)]
    block = D.Block([p for i, t in enumerate(items) for p in D.patterns(i, t)])
    doc = " ".join(text_of(rng, 200) + " " + edit(rng, rng.choice(items), 8) for _ in range(12))
    want = D.scan(doc, block)
    monkeypatch.setattr(D, "SHARED", 50)
    got = D.scan(doc, block)
    assert want and [h[0] for h in got] == [h[0] for h in want]  # the fewest edits may be met in other windows


def test_registered_query_finds_every_exact_passage(spark, sf):
    normal = lambda t: " " + D._string(D.normal(t or "")[0]).strip() + " "
    docs = {r["doc_id"]: normal(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: normal(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in E.queries()["op7_decontaminate"](spark, sf).collect()}
    assert {(d, i) for d, t in docs.items() for i, p in items.items() if p in t} <= found


def test_edges(spark, make_docs, edge_rows, empty_docs, monkeypatch):
    docs = make_docs(edge_rows)
    bench = spark.createDataFrame([(1, edge_rows[0][1]), (1, edge_rows[0][1]), (2, None), (3, ""), (4, "short"), (None, "no id here at all, but a text")], "item_id long, text string")
    kept = D.clean(spark, docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, *range(3, 12)]
    assert D.clean(spark, docs, bench.limit(0)).count() == len(edge_rows)
    assert D.find(spark, docs, bench.limit(0)).count() == 0 and D.find(spark, empty_docs, bench).count() == 0
    monkeypatch.setattr(D, "BLOCK", 1)  # a pass for each pattern
    assert D.clean(spark, docs, bench).count() == kept.count()
