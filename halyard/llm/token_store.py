"""Token ids in a bit-packed file format.

A store is a folder with two tables written by Spark, so that lost tasks are simply written again:

* ``blocks`` - one row a block of about 64 Ki ids, whole documents in ascending doc_id order:
  ``shard``, ``block``, ``start`` (ids of the shard before it), ``n_tokens``, ``bits``, ``doc_ids``,
  ``offsets`` (where each document begins in the block, and the end), ``payload``.
* ``shards`` - one row a shard: ``shard``, ``base`` (ids of all shards before it).

Every id takes the fewest bits that hold the vocabulary; the payload is the ids' bits one after the other,
lowest bit first, so id i lies at bit i * bits: numpy unpacks a block at once or any slice of it, and the
offsets give random access to a document or a range of ids.

Null texts count as empty (only the end id).  Null doc_ids come first; rows with the same doc_id follow each
other in the order of their ids.  A shard is a range of doc_ids, written by one task block after block.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from halyard.llm.common import small_batches
from halyard.llm.pieces import Memory, Parts, byte_letters, byte_spelling, disagreed, groups, piece_values, revive

BLOCK = 1 << 16  # ids from which a block is closed

BLOCKS = ("shard int, block int, start long, n_tokens int, bits int, doc_ids array<long>, offsets array<int>, payload binary")


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each id, one after the other."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for at in range(0, len(ids), BLOCK):  # BLOCK ids of any width fill whole bytes
        part = np.ascontiguousarray(ids[at:at + BLOCK], "<u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(part, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a payload as unsigned 32-bit integers."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, first * bits // 8).astype("<u4")
    out = np.empty(count, "<u4")
    for at in range(0, count, BLOCK):
        n = min(BLOCK, count - at)
        low = (first + at) * bits
        raw = np.frombuffer(payload, np.uint8, -(-(low + n * bits) // 8) - low // 8, low // 8)
        own = np.unpackbits(raw, bitorder="little")[low % 8:low % 8 + n * bits].reshape(n, bits)
        wide = np.zeros((n, 32), np.uint8)
        wide[:, :bits] = own
        out[at:at + n] = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()
    return out


class WordEncoder:
    """The library's ids for vocabularies that lower-case the text and drop its white space.

    No pre-token reaches across white space, so the parts between are encoded once and remembered.  Texts
    with a special token's string or with characters that the regex module and the library may treat
    differently are encoded by the library as they are.
    """

    def __init__(self, spec: str):
        self.spec = spec
        parsed = json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.specials = [t["content"] for t in parsed.get("added_tokens", [])]
        split = next(p for p in parsed["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.match = regex.compile(split["pattern"]["Regex"])
        self.letters, self.model = byte_letters(), self.library.model
        self._words = Memory(self._word)
        self._parts = Memory(lambda part: b"".join(map(self._words.__getitem__, self.match.findall(part))))

    def __reduce__(self):
        return revive, (WordEncoder, self.spec)

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(byte_spelling(word, self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text."""
        out: list[list[bytes]] = [[] for _ in texts]
        plain = []
        for i, (text, odd) in enumerate(zip(texts, disagreed(texts))):
            if not text:
                continue
            if odd or any(s in text for s in self.specials):
                out[i].append(np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                plain.append((i, text.lower()))
        for numbers, group in groups(plain):
            parts = Parts(group, blank=False)
            for i, ids in zip(numbers, parts.joined([piece_values(p, "", self._words, self._parts) for p in parts.distinct])):
                out[i].append(ids)
        return [b"".join(ids) for ids in out]


def shard_bounds(docs: DataFrame, shards: int) -> list[int]:
    """Ascending doc_ids that cut the documents into about equal shards; reads the ids alone."""
    if shards < 2:
        return []
    cuts = docs.agg(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)], 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def write_store(spark: SparkSession, docs: DataFrame, path: str, spec: str, end_id: int | None = None,
                shards: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write the store.

    Each id list moves once, to its shard; the driver sees the shards' bounds only.
    """
    small_batches(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = np.array(shard_bounds(rows, shards), np.int64)
    shared = spark.sparkContext.broadcast(WordEncoder(spec))
    bits = bits_for(shared.value.vocabulary)
    narrow = "<u2" if bits <= 16 else "<u4"
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = shared.value
        for df in batches:
            ids = [np.frombuffer(i + tail, "<u4").astype(narrow).tobytes() for i in encoder.encode(df["text"].tolist())]
            known = df["doc_id"].notna().to_numpy()
            shard = np.where(known, np.searchsorted(bounds, df["doc_id"].fillna(0).to_numpy().astype(np.int64), "left"), 0)
            yield pd.DataFrame({"shard": shard.astype(np.int32), "doc_id": df["doc_id"].astype("Int64"), "ids": ids})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, block, start, held, doc_ids, offsets = None, 0, 0, [], [], [0]

        def close() -> pd.DataFrame:
            nonlocal block, start, held, doc_ids, offsets
            ids = np.concatenate([np.frombuffer(h, narrow) for h in held])
            out = pd.DataFrame([(shard, block, start, len(ids), bits, doc_ids, offsets, pack(ids, bits))], columns=[c.split()[0] for c in BLOCKS.split(", ")])
            block, start, held, doc_ids, offsets = block + 1, start + len(ids), [], [], [0]
            return out
        width = np.dtype(narrow).itemsize
        for df in batches:
            for s, doc_id, ids in zip(df["shard"], df["doc_id"].astype("Int64"), df["ids"]):
                if s != shard:
                    if held:
                        yield close()
                    shard, block, start = int(s), 0, 0
                held.append(ids)
                doc_ids.append(None if doc_id is pd.NA else int(doc_id))
                offsets.append(offsets[-1] + len(ids) // width)
                if offsets[-1] >= BLOCK:
                    yield close()
        if held:
            yield close()

    encoded = rows.mapInPandas(encode, "shard int, doc_id long, ids binary")
    placed = encoded.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids")
    placed.mapInPandas(blocks, BLOCKS).write.mode("overwrite").parquet(f"{path}/blocks")
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base")) \
        .write.mode("overwrite").parquet(f"{path}/shards")


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start`` counted over the whole store."""
    blocks, shards = spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/shards")
    return blocks.join(F.broadcast(shards), "shard").withColumn("start", F.col("start") + F.col("base")).drop("base")


def read_documents(store: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit), one row a document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for start, bits, doc_ids, offsets, payload in df.itertuples(index=False):
                at = np.asarray(offsets, np.int64)
                ids = unpack(payload, bits, 0, int(at[-1]))
                yield pd.DataFrame({"doc_id": pd.array([None if d is None or d != d else int(d) for d in doc_ids], "Int64"), "start": start + at[:-1], "n_tokens": np.diff(at),
                                    "ids": [ids[a:b].tobytes() for a, b in zip(at, at[1:])]})
    return store.select("start", "bits", "doc_ids", "offsets", "payload") \
        .mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary")


def read_range(store: DataFrame, first: int, count: int) -> DataFrame:
    """Ids ``first`` to ``first + count`` of the store: rows of (start, ids), one for each block touched."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for start, n, bits, payload in df.itertuples(index=False):
                a, b = max(first, start), min(first + count, start + n)
                yield pd.DataFrame({"start": [a], "ids": [unpack(payload, bits, a - start, b - a).tobytes()]})
    return store.where((F.col("start") < first + count) & (F.col("start") + F.col("n_tokens") > first)) \
        .select("start", "n_tokens", "bits", "payload").mapInPandas(run, "start long, ids binary")
