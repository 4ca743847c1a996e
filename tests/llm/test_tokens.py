"""Token counts, the token store and tree BPE against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from halyard.llm import pieces, token_count, token_store, tree_bpe


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    out = ["", " ", "  a   b \n\n  c ", "a\t 　 x  ", "x" * 5000 + "étè" * 3000, "\n \n a", "it's we'LL 'tis  'S", "ß" * 999, "日本語テキスト 12345",
           " " * 50, "a" + " " * 9 + "b", "<|endoftext|> x <|startoftext|>", "\x1c \x85 \xa0 a  b", "İstanbul ΣΑΣ Ǆ", "é Å ﬁ", "foo,bar. baz., q."]
    out += ["".join(rng.choice("ab \n\t'sTÉÀ12.,  　日") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    out += ["".join(rng.choice("abcdeorthnéinga") for _ in range(rng.randint(100, 900))) for _ in range(30)]
    return out


@pytest.fixture(scope="module")
def bpe():
    return tree_bpe.TreeBpe(tree_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def oracle(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def test_tree_bpe_equals_tiktoken(bpe, oracle, odd, texts):
    every = [*odd, *texts.values(), None]
    for text, ids in zip(every, bpe.encode(every)):
        assert np.frombuffer(ids, "<u4").tolist() == oracle.encode_ordinary(text or "")
        assert bpe.decode(ids) == (text or "").encode()


def test_tree_joins_anywhere(bpe):
    rng = random.Random(9)
    for _ in range(300):
        piece = "".join(rng.choice("abcdeorthnéinga") for _ in range(rng.randint(2, 120))).encode()
        cut = rng.randint(1, len(piece) - 1)
        assert bpe.join(bpe.merge(piece[:cut]), bpe.merge(piece[cut:])) == bpe.merge(piece) == bpe.tree(piece)


def test_stretches_and_memories_change_nothing(bpe, monkeypatch, odd):
    want = bpe.encode(odd)
    monkeypatch.setattr(pieces, "STRETCH", 20)
    monkeypatch.setattr(pieces, "GROUP", 50)
    monkeypatch.setattr(pieces, "MEMORY", 3)
    assert tree_bpe.TreeBpe(bpe.ranks, bpe.pattern).encode(odd) == want


def test_op10(spark, sf, oracle, texts):
    rows = E.queries()["op10_tree_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = oracle.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_op6_equals_the_library(spark, sf, odd, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    whole = token_count.whole_tokens(spec, public_tokenizers.PATTERN)
    assert len(whole) > 40_000
    counter = token_count.TokenCounter(spec, public_tokenizers.PATTERN, whole)
    assert counter.count([*odd, None]) == [len(library.encode(t, add_special_tokens=False).ids) for t in [*odd, ""]]
    for r in E.queries()["op6_token_count"](spark, sf).collect():
        text = texts[r["doc_id"]]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)


@pytest.fixture(scope="module")
def word_spec():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def test_word_encoder_equals_the_library(word_spec, odd):
    encoder = token_store.WordEncoder(word_spec)
    for text, ids in zip(odd, encoder.encode(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 140_003).astype("<u4")
    payload = token_store.pack(ids, bits)
    assert len(payload) == -(-len(ids) * bits // 8)
    assert np.array_equal(token_store.unpack(payload, bits, 0, len(ids)), ids)
    for first, count in ((0, 0), (1, 1), (70_001, 70_000), (140_002, 1)):
        assert np.array_equal(token_store.unpack(payload, bits, first, count), ids[first:first + count])


def test_op9(spark, sf, word_spec, texts):
    library, at = Tokenizer.from_str(word_spec), 0
    rows = {r["doc_id"]: r for r in E.queries()["op9_token_store"](spark, sf).collect()}
    assert len(rows) == len(texts)
    for doc_id, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        want = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert tuple(rows[doc_id][c] for c in ("start", "n_tokens", "ids_crc32")) == want
        at += len(ids)


def test_store_edges_and_ranges(spark, make_docs, edge_rows, empty_docs, word_spec, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK", 100)
    token_store.write_store(spark, make_docs(edge_rows), str(tmp_path / "s"), word_spec, end_id=1, shards=3)
    store = token_store.open_store(spark, str(tmp_path / "s"))
    rows = sorted(token_store.read_documents(store).collect(), key=lambda r: r["start"])
    assert len(rows) == len(edge_rows)
    ids = [r["doc_id"] for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    stream = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
    got = sorted(token_store.read_range(store, 37, 500).collect(), key=lambda r: r["start"])
    assert np.array_equal(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in got]), stream[37:537])
    token_store.write_store(spark, empty_docs, str(tmp_path / "e"), word_spec, end_id=1)
    assert token_store.read_documents(token_store.open_store(spark, str(tmp_path / "e"))).count() == 0


def test_encode_edges(spark, make_docs, edge_rows, empty_docs, bpe):
    for docs, n in ((make_docs(edge_rows), len(edge_rows)), (empty_docs, 0)):
        out = docs.select("text", tree_bpe.encode(spark, F.col("text"), bpe.ranks, bpe.pattern).alias("c")).collect()
        assert len(out) == n and all(bytes(r["c"]["decoded"]) == (r["text"] or "").encode() for r in out)
        counts = docs.select(token_count.count_tokens(spark, F.col("text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN).alias("n"))
        assert counts.count() == n
