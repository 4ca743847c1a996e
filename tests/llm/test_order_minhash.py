import random

from halyard.llm import order_minhash as O


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_is_the_edit_distance():
    rng = random.Random(4)
    for _ in range(4000):
        a = [rng.randint(0, 4) for _ in range(rng.randint(0, 15))]
        b = [x for x in a if rng.random() < .8] if rng.random() < .6 else [rng.randint(0, 4) for _ in range(rng.randint(0, 15))]
        if rng.random() < .5:
            b.insert(rng.randint(0, len(b)), 9)
        budget, d = rng.randint(0, 9), distance(a, b)
        got = O.banded_distance(a, b, budget)
        assert got == d if d <= budget else got > budget


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def edited(rng, w, share):
    w = list(w)
    for _ in range(int(share * len(w))):
        w[rng.randrange(len(w))] = "new" + str(rng.random())[2:6]
    return w


def test_classes_equal_brute_force(spark, make_docs):
    """Families of edited copies, a passage that half of the texts share, exact copies: against all pairs."""
    rng = random.Random(8)
    passage, texts = words(rng, 40), []
    for _ in range(30):
        base = words(rng, rng.randint(30, 300))
        if rng.random() < .5:
            base = passage + base
        texts.append(base)
        texts += [edited(rng, base, rng.choice([.02, .05, .1])) for _ in range(rng.randint(0, 4))]
        texts += [list(base)] * rng.randint(0, 2)
    docs = make_docs([(i, " ".join(t), "en") for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["class_key"] for r in O.near_duplicate_classes(spark, docs).collect()}
    links = [(i, j) for i in range(len(texts)) for j in range(i)
             if distance(texts[i], texts[j]) <= int(.2 * max(len(texts[i]), len(texts[j])) + 1e-9)]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in links:
        parent[top(i)] = top(j)
    lost = sum(found[i] != found[j] for i, j in links)
    wrong = sum(found[i] == found[j] and top(i) != top(j) for i in range(len(texts)) for j in range(i))
    assert links and wrong == 0 and lost == 0


def test_links_up_to_the_bound_on_edits(spark, make_docs):
    """Pairs with 10 to 20 % of the words replaced, half of them with a passage that fills 60 % of the text."""
    rng = random.Random(9)
    passage, texts = words(rng, 180), []
    for i in range(200):
        base = passage + words(rng, 120) if i % 2 else words(rng, 300)
        texts += [base, edited(rng, base, rng.uniform(.1, .2))]
    docs = make_docs([(i, " ".join(t), "en") for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["class_key"] for r in O.near_duplicate_classes(spark, docs).collect()}
    assert sum(found[i] != found[i + 1] for i in range(0, len(texts), 2)) <= 2  # before: 7 to 30 % of these
    assert len(set(found.values())) >= 200                                      # the passage links nothing


def test_members_that_a_leader_failed_meet_again(spark):
    """Three texts in one bucket, the smallest key unrelated to the other two but for a passage."""
    rng = random.Random(10)
    passage, own = words(rng, 50), words(rng, 50)
    texts = [passage + words(rng, 50), passage + own, passage + edited(rng, own, .1)]
    rows = [(k, O.word_hashes(" ".join(t)), [5]) for k, t in enumerate(texts)]  # one shared entry
    df = spark.createDataFrame([(k, (w >> O.np.uint64(48)).astype("<u2").tobytes(), s) for k, w, s in rows], "key long, tokens binary, sketch array<long>")
    assert {tuple(r) for r in O.classes(df).collect()} == {(0, 0), (1, 1), (2, 1)}


def test_members_that_a_leader_failed_in_different_rounds_meet_again(spark):
    """Text 3 is verified against 0 first and against 1 in the next round, text 2 against 1 at once; only 1 has both."""
    rng = random.Random(15)
    passage, own = words(rng, 50), words(rng, 50)
    texts = [(words(rng, 100), [6]), (passage + words(rng, 50), [5]), (passage + own, [5]), (passage + edited(rng, own, .1), [5, 6])]
    rows = [(k, (O.word_hashes(" ".join(t)) >> O.np.uint64(48)).astype("<u2").tobytes(), s) for k, (t, s) in enumerate(texts)]
    df = spark.createDataFrame(rows, "key long, tokens binary, sketch array<long>")
    assert {tuple(r) for r in O.classes(df).collect()} == {(0, 0), (1, 1), (2, 2), (3, 2)}


def test_a_value_is_shown_once_however_many_leaders_failed_the_text(spark, monkeypatch):
    """Ten leaders of one passage leave the same 16 values of each of 200 texts; two of them have two values in common."""
    left = {k: [k * 100 + i for i in range(16)] for k in range(100, 300)}
    left[299] = left[100][:2] + left[299][2:]
    failed = spark.createDataFrame([(b, k, v) for k, v in left.items() for b in range(10)], "leader long, key long, left array<long>")
    stars, given = O.stars, []
    monkeypatch.setattr(O, "stars", lambda rows, *within: given.append(rows) or stars(rows, *within))
    assert {tuple(r) for r in O.meet_again(failed).collect()} == {(100, 299)}
    assert given[0].count() == 2 * 2 * 10  # two values of two texts with ten leaders; before: 200 * 16 * 10 rows


def test_short_texts_within_the_bound_always_meet(spark, make_docs):
    """Texts of 5 to 14 words with up to a fifth of edits: every pair within the bound is linked, as by all pairs."""
    rng = random.Random(12)
    texts = []
    for n in range(5, 15):
        for _ in range(12):
            base = words(rng, n)
            other = list(base)
            for _ in range(n // 5):
                at = rng.randrange(len(other))
                kind = rng.randrange(3)
                other[at:at + 1] = [other[at], "ins" + str(rng.random())[2:5]] if kind == 0 and len(other) <= n - 1 else [] if kind == 1 else ["sub" + str(rng.random())[2:5]]
            texts += [base, other]
    docs = make_docs([(i, " ".join(t), "en") for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["class_key"] for r in O.near_duplicate_classes(spark, docs).collect()}
    for i in range(0, len(texts), 2):
        a, b = texts[i], texts[i + 1]
        if distance(a, b) <= int(.2 * max(len(a), len(b)) + 1e-9):
            assert found[i] == found[i + 1], (a, b)


def test_recall_by_length():
    """Entries in common at the bound, by length: pairs of a text and one with a fifth of its words replaced."""
    rng = random.Random(13)
    for n in (5, 8, 11, 14, 15, 20, 30, 60, 200):
        met = 0
        for _ in range(200):
            base = words(rng, n)
            other = list(base)
            for at in rng.sample(range(n), n // 5):
                other[at] = "new" + str(rng.random())[2:6]
            met += bool(set(O.entries(O.word_hashes(" ".join(base)))) & set(O.entries(O.word_hashes(" ".join(other)))))
        assert met >= (200 if n <= O.SHORT else 180), n


def test_masks_are_bounded(monkeypatch):
    rng = random.Random(14)
    a = [rng.randint(0, 300) for _ in range(2000)]
    b = [x for x in a if rng.random() < .95]
    want = O.banded_distance(a, b, 400)
    monkeypatch.setattr(O, "MASKS", 4000)
    assert O.banded_distance(a, b, 400) == want == len(a) - len(b)


def test_edges(spark, make_docs, edge_rows, empty_docs):
    docs = make_docs(edge_rows)
    rows = O.near_duplicate_classes(spark, docs).collect()
    assert len(rows) == len(edge_rows)
    kept = O.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids           # repeated rows and copies: one stays, the smallest id
    assert {3, 4, 5, 6} <= set(ids)                     # texts without a word stand alone
    assert O.near_duplicate_classes(spark, empty_docs).count() == 0 and O.one_of_each(spark, empty_docs).count() == 0


def test_long_texts_are_sketched_in_chunks(monkeypatch):
    w = O.word_hashes(" ".join(words(random.Random(1), 900)))
    whole = O.sketch(w)
    monkeypatch.setattr(O, "CHUNK", 100)
    assert O.sketch(w) == whole


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    out = {r["node"]: r["label"] for r in O.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {out[i] for i in range(41)} == {0} and {out[100 + i] for i in range(60)} == {100}
