"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Every match of the split pattern is encoded by itself.  Its bytes are halved down to short leaves, which are
merged directly; two encoded neighbours are joined by re-encoding a window of tokens around the boundary.

When a join is final: call tokens a, b compatible if the bytes of a and b together encode to [a, b].  A
sequence whose neighbours are all compatible is the encoding of its bytes: consider the first merge that
crosses a boundary between some a and b; until then the merges inside a and b came in the same order as when
their bytes stand alone, so that merge would also come first there, and [a, b] would not be the result.  Both
halves are encodings, the window is one too, so it is enough that the window's first and last token are
compatible with the tokens outside; otherwise the window doubles on that side.

At the pattern's own boundaries no window is needed: matches, parts and stretches of a text are joined by
concatenation.  Decoding concatenates the tokens' bytes, halves first, up the same kind of tree.

Null and empty texts have no ids.  Very long texts are encoded stretch by stretch; a match of any length is halved
by the tree.  Tokens in the text that look like special ones are ordinary text.  Repeated rows are encoded alike, an
empty table gives no rows, and only the text column is read, whatever the others are called.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T

from halyard.llm.common import map_text, small_batches
from halyard.llm.pieces import BLANK_IN_RUN, Memory, Parts, groups, piece_values, revive

LEAF = 6         # bytes merged directly
NO_RANK = 1 << 30

SCHEMA = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class TreeBpe:
    """Encoder and decoder for one rank table and split pattern; a worker keeps one with its memories."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.match = regex.compile(self.pattern)
        self._fits: dict[tuple[int, int], bool] = {}
        self._pieces = Memory(self._piece)
        self._after_blank = Memory(lambda part: self._matches(" " + part))

    def __reduce__(self):
        return revive, (TreeBpe, self.ranks, self.pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Merge the neighbouring pair of lowest rank, the first of equals, until none has a rank."""
        rank = self.ranks.get
        bounds = list(range(len(piece) + 1))
        costs = [rank(piece[i:i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while costs:
            low = min(costs)
            if low == NO_RANK:
                break
            i = costs.index(low)
            del bounds[i + 1], costs[i]
            if i:
                costs[i - 1] = rank(piece[bounds[i - 1]:bounds[i + 1]], NO_RANK)
            if i < len(costs):
                costs[i] = rank(piece[bounds[i]:bounds[i + 2]], NO_RANK)
        return [self.ranks[piece[a:b]] for a, b in zip(bounds, bounds[1:])]

    def compatible(self, a: int, b: int) -> bool:
        found = self._fits.get((a, b))
        if found is None:
            if len(self._fits) > 200_000:
                self._fits.clear()
            found = self._fits[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded byte strings together."""
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i:] + right[:j])))
            fits_left = i == len(left) or self.compatible(left[-i - 1], window[0])
            fits_right = j == len(right) or self.compatible(window[-1], right[j])
            if fits_left and fits_right:
                return left[:len(left) - i] + window + right[j:]
            i, j = i * (1 if fits_left else 2), j * (1 if fits_right else 2)

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def _piece(self, piece: str) -> bytes:
        b = piece.encode()
        whole = self.ranks.get(b)
        ids = self.tree(b) if whole is None else [whole]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _matches(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self.match.findall(text)))

    def encode(self, texts: list) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        plain = []
        for i, text in enumerate(texts):
            if text and BLANK_IN_RUN.search(text):
                out[i].append(b"".join(self._pieces[m.group()] for m in self.match.finditer(text)))
            elif text:
                plain.append((i, text))
        for numbers, group in groups(plain):
            parts = Parts(group, blank=True)
            values = [piece_values(p, " ", self._pieces, self._after_blank) for p in parts.distinct] + [self._matches(p) for p in parts.firsts]
            for i, ids in zip(numbers, parts.joined(values)):
                out[i].append(ids)
        return [b"".join(ids) for ids in out]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian ids."""
        if len(ids) > 1 << 14:
            half = len(ids) // 8 * 4
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(spark: SparkSession, text: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """Struct column of ``ids`` (binary, little-endian unsigned 32-bit) and the bytes they decode to.

    The rank table is broadcast: its size is the vocabulary's.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(TreeBpe(ranks, pattern))

    def run(texts: list) -> pd.DataFrame:
        bpe = shared.value
        ids = bpe.encode(texts)
        return pd.DataFrame({"ids": ids, "decoded": [bpe.decode(i) for i in ids]}, columns=SCHEMA.names)
    return map_text(text, run, SCHEMA)
