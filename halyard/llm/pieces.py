"""Splitting texts into pre-tokens, and bounded memories of what pieces encode to.

The byte-level vocabularies split text by a pattern whose matches never reach across the place before a
single blank.  So a text cut at its blanks, each blank going with what follows it, splits into the same
pre-tokens part by part, and what a part encodes to can be remembered.  Runs of white space with a blank
inside are the exception: they are one match, and such texts are matched as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

MEMORY = 200_000     # entries of a generation of remembered parts
LONGEST = 64         # longer parts are not remembered
STRETCH = 1 << 20    # characters of a text that are cut into parts at once
GROUP = 1 << 21      # characters of all stretches that are handled together

BLANK_IN_RUN = regex.compile(r"\s (?=\s|\Z)")
LONE_BLANK = regex.compile(r"(?<=\S) (?=\S)")

#: Characters on which the installed regex module and the tokenizers library agree in classes and case;
#: other characters may be newer than one of the two.
AGREED = regex.compile(r"[^\x00-\x1B\x20-ɏА-яḀ-ẕ‐-‧€ぁ-ゖァ-ヺ一-龥]")


def disagreed(texts: list) -> list:
    """Of each text, whether it has a character outside AGREED's classes (null: null); all texts in one pass."""
    return pc.match_substring_regex(pa.array(texts, pa.large_string()), AGREED.pattern).to_pylist()


_held: dict[type, tuple] = {}


def revive(cls: type, *state):
    """The worker's ``cls(*state)``: the last object is held, so that its memories outlast a task and are not held
    twice when another broadcast brings the same state; those of other stages are given up."""
    if cls not in _held or _held[cls][0] != state:
        _held.clear()
        _held[cls] = state, cls(*state)
    return _held[cls][1]


def give_up() -> None:
    """Drop what ``revive`` holds; stages that encode nothing call it, so that no worker carries the memories through them."""
    _held.clear()


class Memory(dict):
    """A dict that fills itself by ``make``.

    It has two generations: with MEMORY entries it becomes the old one and starts afresh, and an entry of
    the old one that is asked for moves over, so frequent parts stay and at most 2 * MEMORY are held.
    """

    def __init__(self, make: Callable, base: dict | None = None):
        super().__init__()
        self.make, self.old = make, base or {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST:
                return value
        if len(self) >= MEMORY:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def piece_values(part: str, lead: str, pieces: Memory, rest: Memory):
    """The values of a part's pre-tokens, joined: the part after ``lead`` (a blank or nothing).

    Letters are one pre-token, letters with a full stop or comma behind are two; no pattern is needed there.
    """
    if part.isalpha():
        return pieces[lead + part]
    if part[-1:] in (".", ",") and part[:-1].isalpha():
        return pieces[lead + part[:-1]] + pieces[part[-1]]
    return rest[part]


def stretches(text: str) -> Iterator[str]:
    """The text in stretches of about STRETCH characters, cut before lone blanks only."""
    at = 0
    while len(text) - at > STRETCH:
        cut = LONE_BLANK.search(text, at + STRETCH)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def byte_spelling(text: str, letters: dict[int, str]) -> str:
    """A text as the byte-level vocabularies spell it."""
    return text.encode().decode("latin-1").translate(letters)


class Parts:
    """The parts of a group of stretches: distinct texts, and which of them stand where.

    ``blank``: cut at every blank, and the part before a stretch's first blank is kept apart (``firsts``);
    otherwise cut at runs of white space.
    """

    def __init__(self, group: list[str], blank: bool):
        strings = pa.array(group, pa.large_string())
        lists = pc.split_pattern(strings, " ") if blank else pc.utf8_split_whitespace(strings)
        coded = lists.flatten().dictionary_encode()
        self.offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        self.which = np.asarray(coded.indices).astype(np.int64)
        self.distinct = coded.dictionary.to_pylist()
        self.firsts = [self.distinct[i] for i in self.which[self.offsets[:-1]]] if blank else []
        if blank:
            self.which[self.offsets[:-1]] = len(self.distinct) + np.arange(len(group))

    def sums(self, values: list[int]) -> list[int]:
        """Of each stretch, the sum of its parts' values (the distinct parts' and then the firsts')."""
        total = np.concatenate([[0], np.cumsum(np.asarray(values, np.int64)[self.which])])
        return (total[self.offsets[1:]] - total[self.offsets[:-1]]).tolist()

    def joined(self, values: list[bytes]) -> list[bytes]:
        """Of each stretch, its parts' values (of 4-byte ids) one after the other."""
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        begins = np.cumsum(sizes) - sizes
        n = sizes[self.which]
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(values), "<u4")
        total = int(ends[-1]) if len(ends) else 0
        narrow = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
        from_ = np.repeat((begins[self.which] - (ends - n)).astype(narrow), n)
        from_ += np.arange(total, dtype=narrow)
        ids = ids[from_]
        at = np.concatenate([[0], ends])[self.offsets]
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]


def groups(texts: list[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """(number, text) pairs as groups of stretches of about GROUP characters in all."""
    numbers, held, size = [], [], 0
    for number, text in texts:
        for stretch in stretches(text):
            if held and size + len(stretch) > GROUP:
                yield numbers, held
                numbers, held, size = [], [], 0
            numbers.append(number)
            held.append(stretch)
            size += len(stretch)
    if held:
        yield numbers, held
