"""The Merkle manifest against trees built row by row."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from halyard.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, group string, leaf string, position long, chunk long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(nodes):
    """All levels of a tree of hex digests."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    """(before, after) of the node's run, level by level."""
    for nodes in tree[:-1]:
        lo = i - i % 16
        yield nodes[lo:i], nodes[i + 1:lo + 16]
        i //= 16


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    """One (doc_id, leaf, subroot, root, proof, folded, verified) for each row."""
    groups = defaultdict(list)
    for doc_id, source, lang, n, text in rows:
        leaf = h(*map(field, (doc_id, source, lang, n, text)))
        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        other = h(*map(field, (doc_id, source, lang, n, lower(text)))) if changed else leaf
        groups[source].append((doc_id is not None, doc_id or 0, leaf, other, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grow([r[2] for r in sorted(groups[s])]) for s in order}
    top = grow([trees[s][-1][0] for s in order])
    for at, s in enumerate(order):
        for i, (_, _, leaf, other, doc_id) in enumerate(sorted(groups[s])):
            steps = [*path(trees[s], i), *path(top, at)]
            node = other
            for before, after in steps:
                node = h(*before, node, *after)
            root = top[-1][0]
            yield doc_id, leaf, trees[s][-1][0], root, h(*[x for b, a in steps for x in b + a]), node, node == root


def check(got, rows):
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, expected(rows)))


def test_op13(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = E.queries()["op13_merkle_manifest"](spark, sf).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    check(got.collect(), rows)


@pytest.mark.parametrize("depth", [1, 3])
def test_edges_and_several_levels(spark, tmp_path, monkeypatch, depth):
    real = M.proved  # 16 leaves a partition: many partitions and fetched levels
    monkeypatch.setattr(M, "proved", lambda leaves: real(leaves, depth))
    rng = random.Random(7)
    rows = [(i, "hot", "en", 3, f"Text {i} ABC") for i in rng.sample(range(100_000), 4400)]
    rows += [(i, rng.choice((None, "", "a", "b", "Z", "é", "hot")), rng.choice((None, "fr")), rng.choice((None, i)), rng.choice((None, "", "XÉy\n")))
             for i in range(200_000, 200_300)]
    rows += [(None, "a", None, None, None), (None, "a", None, None, None), (7, "a", "en", 1, "Same"), (7, "a", "en", 1, "Same"), (7, "a", "en", 1, "other"),
             (-3, "one", "en", 1, "L" * 300_000)]
    rows += [(300_000 + i, f"s{i}", "de", 1, "A") for i in range(300)]  # many sources: a top tree of several levels
    spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    check(E.queries()["op13_merkle_manifest"](spark, str(tmp_path)).collect(), rows)


def test_small_and_empty(spark, tmp_path):
    for n in (0, 1, 16, 17):
        rows = [(i, "s", "en", 1, "A") for i in range(n)]
        spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/{n}/documents.parquet")
        check(E.queries()["op13_merkle_manifest"](spark, f"{tmp_path}/{n}").collect(), rows)


def test_union_is_minimal():
    """What a partition asks for: nothing that its own leaves give, and every sibling above its top once."""
    size = 16 ** 4 * 2 + 5
    for chunk in (0, 7, 17, size // 4096):
        need = M.missing(chunk, size)
        assert len(need) == len(set(need)) and all(level >= M.DEPTH for level, _ in need)
        leaf = chunk * 4096
        assert need == [(level, i) for level, i in M.coordinates(leaf, size) if level >= M.DEPTH]
    assert M.missing(0, 4096) == []


def test_fold_rejects_other_siblings(spark):
    leaves = spark.range(40).select(F.lit("g").alias("group"), F.col("id").alias("key"), M.digest(F.col("id")).alias("leaf"))
    rows = M.proved(leaves).collect()
    for r in rows:
        proof = bytes(r["proof"])
        where = (r["position"], r["size"]), (r["top_position"], r["top_size"])
        assert M.fold(bytes(r["leaf"]), proof, *where) == bytes(r["root"])
        assert M.fold(bytes(r["leaf"]), bytes([proof[0] ^ 1]) + proof[1:], *where) != bytes(r["root"])
