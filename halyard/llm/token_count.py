"""Token counts by the whole-token shortcut.

Offline, on the driver, every vocabulary string is encoded by itself; those that give exactly one token are
proved whole.  A pre-token that is proved whole counts one without any merging; only the rest are merged by
the library's model, and a bounded memory keeps their counts.

A text with a special token's string, or with a character that the library and the split pattern may class
differently, is encoded by the library as it is.  Null texts count as empty: no tokens.  Repeated rows are counted alike, row by row,
an empty table gives no rows, and only the text column is read, whatever the others are called.
"""

from __future__ import annotations

import json

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from halyard.llm.common import small_batches
from halyard.llm.pieces import AGREED, BLANK_IN_RUN, Memory, Parts, byte_letters, byte_spelling, groups, piece_values, revive


def whole_tokens(spec: str, pattern: str) -> frozenset[str]:
    """The vocabulary strings that the pattern leaves in one piece and that encode alone as one token."""
    library, match = Tokenizer.from_str(spec), regex.compile(pattern)
    back = {c: b for b, c in byte_letters().items()}
    texts = []
    for token in library.get_vocab(with_added_tokens=False):
        try:
            text = bytes(back[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if not AGREED.search(text) and match.findall(text) == [text]:
            texts.append(text)
    return frozenset(t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)) if len(e.ids) == 1)


class TokenCounter:
    """Counts by one tokenizer file; a worker keeps one with its memories."""

    def __init__(self, spec: str, pattern: str, whole: frozenset[str]):
        self.state = spec, pattern, whole
        self.library, self.match = Tokenizer.from_str(spec), regex.compile(pattern)
        self.specials = [t["content"] for t in json.loads(spec).get("added_tokens", [])]
        self.letters, self.model = byte_letters(), self.library.model
        self._pieces = Memory(lambda piece: 1 if piece in whole else len(self.model.tokenize(byte_spelling(piece, self.letters))))
        self._after_blank = Memory(lambda part: self._matches(" " + part))

    def __reduce__(self):
        return revive, (TokenCounter, *self.state)

    def _matches(self, text: str) -> int:
        return sum(map(self._pieces.__getitem__, self.match.findall(text)))

    def count(self, texts: list) -> list[int]:
        out = [0] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if AGREED.search(text) or any(s in text for s in self.specials):
                out[i] = len(self.library.encode(text, add_special_tokens=False).ids)
            elif BLANK_IN_RUN.search(text):
                out[i] = sum(self._pieces[m.group()] for m in self.match.finditer(text))
            else:
                plain.append((i, text))
        for numbers, group in groups(plain):
            parts = Parts(group, blank=True)
            values = [piece_values(p, " ", self._pieces, self._after_blank) for p in parts.distinct] + [self._matches(p) for p in parts.firsts]
            for i, n in zip(numbers, parts.sums(values)):
                out[i] += n
        return out


def count_tokens(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """Number of tokens (long) of each whole text; the broadcast is the tokenizer file and its whole tokens."""
    small_batches(spark)
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    shared = spark.sparkContext.broadcast(TokenCounter(spec, pattern, whole_tokens(spec, pattern)))

    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.count(texts.tolist()), dtype="int64")
    return run(text)
