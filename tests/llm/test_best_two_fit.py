"""Packing against the tokenizers library and a one-sequence-at-a-time filling."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from halyard.llm import best_two_fit as B


@pytest.fixture(scope="module")
def spec():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def one_by_one(lengths, capacity):
    """Best-two-fit on single documents: every sequence filled by itself."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        held, gap, rest = [], capacity, []
        for x in left:
            if x <= gap:
                held.append(x)
                gap -= x
            else:
                rest.append(x)
        if gap and len(held) > 1:
            small, pairs = held[-1], []
            for i, x in enumerate(rest):
                for y in rest[i + 1:]:
                    if small < x + y <= gap + small:
                        pairs.append((x + y, x, y))
            if pairs:
                _, x, y = max(pairs)
                held[-1:] = [x, y]
                rest.remove(x)
                rest.remove(y)
                rest = sorted([*rest, small], reverse=True)
        left = rest
        out.append(sorted(held, reverse=True))
    return out


def expanded(lengths, capacity):
    return [sorted((s for s, n in p.items() for _ in range(n)), reverse=True) for p, times in B.patterns(Counter(lengths), capacity) for _ in range(times)]


def test_patterns_equal_the_filling_one_by_one():
    rng = random.Random(2)
    for _ in range(300):
        capacity = rng.choice((10, 16, 31, 100))
        lengths = [rng.randint(1, capacity) if rng.random() < 0.5 else rng.randint(1, 1 + capacity // 3) for _ in range(rng.randint(0, 60))]
        assert expanded(lengths, capacity) == one_by_one(lengths, capacity)


def test_replacement_saves_sequences():
    # greedy gives 6 + 3 and a gap of 1; 2 + 2 in place of the 3 leave none
    assert expanded([6, 3, 2, 2], 10) == [[6, 2, 2], [3]]
    assert expanded([7, 4, 2, 2, 2], 11) == one_by_one([7, 4, 2, 2, 2], 11)
    lengths = random.Random(8).choices(range(1, 1025), k=20_000)
    used = sum(times for _, times in B.patterns(Counter(lengths), 1024))
    assert used <= -(-sum(lengths) // 1024) * 1.002


def test_plan_stays_small():
    counts = {s: 1_000_000_007 + s for s in range(1, 1025)}
    plan = B.plan(counts, 1024)
    assert len(plan) < 20_000


def ids_of(spec, text):
    return Tokenizer.from_str(spec).encode(text or "", add_special_tokens=False).ids + [2]


def test_encoder_equals_the_library(spec):
    encoder, library = B.ByteEncoder(spec, public_tokenizers.PATTERN), Tokenizer.from_str(spec)
    rng = random.Random(6)
    odd = ["", " ", "  a   b \n\n  c ", "a\t \u3000x  ", "<|endoftext|> x", "\x1c \x85 \xa0 a  b", "Straße ΣΑΣ İ", "日本語 12345", " " * 1_500_000 + "x", "'s 'LL"]
    odd += ["".join(rng.choice("ab \n\t'sTÉÀ12.,  日") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    for text in odd:
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.merger and B.merge_ranks(spec)


def check(rows, texts, library, capacity=1024):
    """Pieces of every document, in order and whole, and sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for doc_id, wanted in texts.items():
        want = Counter()
        for text in wanted:
            ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
            head = len(ids) % capacity
            cuts = ([0] if head else []) + list(range(head, len(ids), capacity)) + [len(ids)]
            total += len(ids)
            want.update((i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
        assert want == Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc_id])
    assert by_doc.keys() == texts.keys()
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), total


def test_op12(spark, sf, spec):
    texts = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        texts[r["doc_id"]].append(r["text"])
    sequences, total = check(E.queries()["op12_best_two_fit"](spark, sf).collect(), texts, Tokenizer.from_str(spec))
    assert sequences <= -(-total // 1024) * 1.02 + 1


def test_edges(spark, make_docs, edge_rows, empty_docs, spec, tmp_path):
    rows = [*edge_rows, (12, "​<|endoftext|> tail  \n\n", "en"), (12, "same id", "en")]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    texts = defaultdict(list)
    for doc_id, text, _ in rows:
        texts[doc_id].append(text)
    check(E.queries()["op12_best_two_fit"](spark, str(tmp_path)).collect(), texts, Tokenizer.from_str(spec))
    none = B.encoded_pieces(spark, empty_docs, spec, public_tokenizers.PATTERN, 2, 1024)
    assert B.placed(spark, none, 1024).count() == 0


def test_sequences_hold_the_ids(spark, make_docs, spec):
    docs = make_docs([(i, "some words here " * i, "en") for i in range(30)])
    pieces = B.encoded_pieces(spark, docs, spec, public_tokenizers.PATTERN, 2, 64)
    got = B.sequences(spark, pieces, 64).collect()
    want = Counter()
    for i in range(30):
        want.update(ids_of(spec, "some words here " * i))
    held = Counter()
    for s in got:
        ids = np.frombuffer(bytes(s["ids"]), "<u2").tolist()
        assert len(ids) <= 64
        held.update(ids)
    assert held == want
    assert spark.range(1).select(F.lit(sum(held.values()))).first()[0] == sum(want.values())
