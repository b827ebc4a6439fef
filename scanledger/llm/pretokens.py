"""Splitting of texts before byte-level BPE, and tables of encoded words."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import regex

# The public split pattern, with its classes written out. The first form is for texts
# whose characters all lie below U+0100, where the standard library's faster matcher can be used.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\\x09-\\x0d \x85\xa0"
_WIDE_SPACE = _SPACE + "\u1680\u2000-\u200a\u2028-\u2029\u202f\u205f\u3000"


def _pattern(letter: str, number: str, space: str) -> str:
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


_NARROW = re.compile(_pattern(_LETTER, _NUMBER, _SPACE)).findall
_WIDE = regex.compile(_pattern(r"\p{L}", r"\p{N}", _WIDE_SPACE)).findall
_IS_WIDE = re.compile("[^\x00-\xff]").search


def split_words(text: str) -> list[str]:
    """The pre-tokens of a text; joined, they are the text."""
    return _WIDE(text) if _IS_WIDE(text) else _NARROW(text)


class WordTable:
    """Ids of words, kept in flat arrays so that whole documents are looked up at once.

    ``encode`` gives the ids of a word not held yet. When more than ``most``
    words are held, those met once are forgotten between two lookups.
    """

    def __init__(self, encode: Callable[[str], list[int]], most: int):
        self.encode, self.most = encode, most
        self._fill([], [])

    def _fill(self, words: list[str], ids: list[array]) -> None:
        table = self

        class Index(dict):
            def __missing__(self, word: str) -> int:
                self[word] = at = table._add(table.encode(word))
                return at

        self.index, self.hits = Index(), np.zeros(0, np.int64)
        self.starts, self.lengths, self.flat = array("q"), array("q"), array("I")
        for word, own in zip(words, ids, strict=True):
            self.index[word] = self._add(own)

    def _add(self, ids) -> int:
        at = len(self.lengths)
        self.starts.append(len(self.flat))
        self.lengths.append(len(ids))
        self.flat.extend(ids)
        return at

    def lookup(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some lists of words, one after the other, and how many each list has."""
        self._forget()
        places = array("q")
        for words in texts:
            places.extend(map(self.index.__getitem__, words))
        at = np.frombuffer(places, np.int64) if places else np.zeros(0, np.int64)
        starts, lengths = np.array(self.starts), np.array(self.lengths)
        met = np.bincount(at, minlength=len(lengths))
        met[: len(self.hits)] += self.hits
        self.hits = met
        ends = np.concatenate([[0], np.cumsum(lengths[at])])
        edges = np.concatenate([[0], np.cumsum([len(words) for words in texts])])
        return gather(np.array(self.flat), starts[at], lengths[at]), np.diff(ends[edges])

    def _forget(self) -> None:
        if len(self.index) <= self.most:
            return
        kept = np.flatnonzero(self.hits > 1)
        if len(kept) > self.most // 2:
            kept = np.sort(np.argsort(-self.hits, kind="stable")[: self.most // 2])
        words = list(self.index)
        spans = [(self.starts[k], self.lengths[k]) for k in kept]
        self._fill([words[k] for k in kept], [self.flat[s : s + n] for s, n in spans])


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Slices of an array, joined."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(total)]


def groups_of(texts: Iterable[str], chars: int = 2_000_000) -> Iterable[list[str]]:
    """Consecutive texts of so many characters together, or a single longer one."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
