"""Encoding or counting whole texts chunk by chunk, so that a chunk seen before costs one look-up.

The pattern of byte-level BPE never lets a match reach over a place where one space
stands before a non-blank: the space begins the next match. Texts are cut there.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from accountwatch.llm.words import text_slices

#: Bytes of a generation, its texts and values and what the dictionary adds to each; a worker holds up to two generations of a cache.
CACHE_BYTES = 32_000_000
_ENTRY_BYTES = 160


class Generations:
    """A cache of bounded size: what was not asked for during a whole generation is forgotten."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most = most
        self.size = 0
        self.young: dict = {}
        self.old: dict = {}

    def holding(self, keys: set[str], make: Callable[[list[str]], list]) -> dict:
        """A dictionary that has all ``keys``; the missing ones are made together."""
        missing = keys.difference(self.young)
        if missing and self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0
            missing = keys
        again = {key: self.old[key] for key in missing if key in self.old}
        new = list(missing.difference(again))
        again.update(zip(new, make(new), strict=True))
        self.young.update(again)
        self.size += _ENTRY_BYTES * len(again) + sum(map(len, again)) + sum(len(value) for value in again.values() if isinstance(value, bytes))
        return self.young


class ChunkEncoder:
    """Texts to token ids, as bytes of little-endian unsigned 32-bit integers.

    ``pattern`` cuts chunks into words, and ``encode_words`` encodes the distinct new
    words of a batch together. Chunks and words are both remembered.
    """

    def __init__(self, pattern: str, encode_words: Callable[[list[str]], list[bytes]], most: int = CACHE_BYTES):
        self.pattern = regex.compile(pattern)
        self.encode_words = encode_words
        self.words = Generations(most)
        self.spaced = Generations(most)

    def encode(self, texts: list[str]) -> list[bytes]:
        # One piece stands for a text that may not be cut at its spaces.
        cut = [[text] if _UNCUT.search(text) else text.split(" ") for text in texts]
        heads = self._encode_chunks([pieces[0] for pieces in cut])
        known = self.spaced.holding(set().union(*(pieces[1:] for pieces in cut)), self._encode_spaced)
        return [head + b"".join(map(known.__getitem__, pieces[1:])) for head, pieces in zip(heads, cut, strict=True)]

    def _encode_spaced(self, pieces: list[str]) -> list[bytes]:
        return self._encode_chunks([" " + piece for piece in pieces])

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(chunk) for chunk in chunks]
        known = self.words.holding(set().union(*cut), self.encode_words)
        return [b"".join(map(known.__getitem__, words)) for words in cut]


class ChunkCounter:
    """Texts to numbers of tokens; ``count_words`` counts the distinct new words of a batch together."""

    def __init__(self, pattern: str, count_words: Callable[[list[str]], list[int]], most: int = CACHE_BYTES):
        self.pattern = regex.compile(pattern)
        self.count_words = count_words
        self.words = Generations(most)
        self.spaced = Generations(most)

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of every word."""
        return self._numbers(self.words, words, self.count_words)

    def runs(self, texts: list[str], size: int) -> list[tuple[list[int], list[int]]]:
        """Characters and tokens of each run of ``size`` pieces of every text.

        Pieces are a text's chunks, or its words if it may not be cut at its spaces.
        """
        uncut = [bool(_UNCUT.search(text)) for text in texts]
        cut = [self.pattern.findall(text) if whole else text.split(" ") for text, whole in zip(texts, uncut, strict=True)]
        # Words stand for themselves, or for the first chunk of a text, which has no space before it.
        words = [pieces if whole else self.pattern.findall(pieces[0]) for pieces, whole in zip(cut, uncut, strict=True)]
        spaced = [[] if whole else pieces[1:] for pieces, whole in zip(cut, uncut, strict=True)]
        by_word = np.split(self.count([*chain(*words)]), np.cumsum([*map(len, words)]))
        by_piece = np.split(self._numbers(self.spaced, [*chain(*spaced)], self._count_spaced), np.cumsum([*map(len, spaced)]))
        out = []
        for pieces, whole, own, others in zip(cut, uncut, by_word[:-1], by_piece[:-1], strict=True):
            chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
            tokens = own
            if not whole:
                chars[1:] += 1
                tokens = np.concatenate([[own.sum()], others])
                if not pieces[0]:
                    chars, tokens = chars[1:], tokens[1:]
            firsts = np.arange(0, len(chars), size)
            out.append((np.add.reduceat(chars, firsts).tolist(), np.add.reduceat(tokens, firsts).tolist()) if len(chars) else ([], []))
        return out

    def _count_spaced(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece with the space before it. All are one text, which may be cut before every piece."""
        words = self.pattern.findall(" " + " ".join(pieces))
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1
        firsts = np.searchsorted(ends, np.cumsum(sizes) - sizes, side="right")
        return np.add.reduceat(self.count(words), firsts).tolist()

    def _numbers(self, cache: Generations, keys: list[str], make: Callable[[list[str]], list[int]]) -> np.ndarray:
        """The cached number of every key; the missing ones are made together."""
        numbers = np.fromiter(map(cache.young.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        places = np.flatnonzero(numbers < 0)
        if len(places):
            missing = [keys[i] for i in places.tolist()]
            known = cache.holding(set(missing), lambda new: make(new) if new else [])
            numbers[places] = [*map(known.__getitem__, missing)]
        return numbers


#: A space before a blank or the end, where the space does not begin a match.
_UNCUT = re.compile(r" (?:\s|\Z)")


def slices(texts: list[str], most: int = 4_000_000):
    """Ranges of consecutive texts of about ``most`` characters, one text at least."""
    yield from text_slices(map(len, texts), most)


def text_batches(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Where a slice of a text column begins, and its texts; a slice is cut before its texts are unpacked."""
    for begin, end in text_slices(pc.utf8_length(column).to_pylist(), most):
        yield begin, column.slice(begin, end - begin).to_pylist()
