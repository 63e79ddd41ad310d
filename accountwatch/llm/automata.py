"""Weighted acyclic automata over words: minimal, built from sorted phrases, counts by order number.

States with the same continuations are one state, also where the counts behind them differ:
an arc carries how many phrases come before those behind it, so that a phrase's path adds up
to its place in the order, and the weights stand by place.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import zstandard

Phrase = tuple[bytes, ...]


class CountTransducer:
    """From phrases to counts.

    ``words`` are the labels in ascending order; ``states`` are (final, arcs), an arc is
    (number of a word, state); the last state is the root.
    """

    def __init__(self, words: list[bytes], states: list[tuple[bool, tuple[tuple[int, int], ...]]], weights: list[int]):
        self.words = words
        self.states = states
        self.weights = weights

    @classmethod
    def build(cls, entries: Iterable[tuple[Phrase, int]]) -> CountTransducer:
        """From distinct phrases in ascending order."""
        phrases, weights = [], []
        for phrase, weight in entries:
            phrases.append(phrase)
            weights.append(weight)
        words = sorted(set().union(*phrases))
        number = {word: i for i, word in enumerate(words)}
        width = max(map(len, phrases), default=0)
        rows = np.full((len(phrases), width), -1, dtype=np.int64)
        for i, phrase in enumerate(phrases):
            rows[i, : len(phrase)] = [number[word] for word in phrase]
        return cls.from_rows(words, rows, weights)

    @classmethod
    def from_rows(cls, words: list[bytes], rows: np.ndarray, weights: list[int]) -> CountTransducer:
        """From distinct phrases in ascending order, as rows of word numbers with -1 behind their ends.

        What no later phrase can change is minimised at once: only the states on the last
        phrase's path are still open.
        """
        width = rows.shape[1]
        lengths = (rows >= 0).sum(axis=1).tolist()
        same = np.zeros(rows.shape, dtype=bool)
        same[1:] = (rows[1:] == rows[:-1]) & (rows[1:] >= 0)
        shared = np.cumprod(same, axis=1).sum(axis=1).tolist()
        leaf = (True, ())
        states: list[tuple] = [leaf]
        known = {leaf: 0}
        arcs: list[list] = [[] for _ in range(width + 1)]
        final = [False] * (width + 1)
        depth, last = 0, []

        def close(down_to: int) -> None:
            nonlocal depth
            while depth > down_to:
                number = 0
                if arcs[depth]:
                    state = (final[depth], tuple(arcs[depth]))
                    number = known.setdefault(state, len(states))
                    if number == len(states):
                        states.append(state)
                    arcs[depth] = []
                final[depth] = False
                depth -= 1
                arcs[depth].append((last[depth], number))

        for row, length, common in zip(rows.tolist(), lengths, shared, strict=True):
            if depth > common:
                close(common)
            last, depth = row, length
            final[length] = True
        close(0)
        # The root is a state of its own, even where another one equals it, and stands last.
        states.append((final[0], tuple(arcs[0])))
        return cls(words, states, weights)

    @cached_property
    def behind(self) -> list[int]:
        """How many phrases each state accepts."""
        many: list[int] = []
        for final, arcs in self.states:
            many.append(final + sum(many[state] for _, state in arcs))
        return many

    def __len__(self) -> int:
        return len(self.weights)

    def items(self) -> Iterator[tuple[Phrase, int]]:
        """Phrases in order with their counts."""
        weights, words = iter(self.weights), self.words
        waiting: list[tuple[Phrase, int]] = [((), len(self.states) - 1)]
        while waiting:
            prefix, state = waiting.pop()
            final, arcs = self.states[state]
            if final:
                yield prefix, next(weights)
            waiting.extend([((*prefix, words[word]), target) for word, target in reversed(arcs)])

    def compose(self, other: CountTransducer) -> Iterator[tuple[Phrase, int, int]]:
        """The phrases that both accept, with the count of each: one walk over the pairs of states that meet."""
        waiting = [((), len(self.states) - 1, 0, len(other.states) - 1, 0)]
        while waiting:
            prefix, a, skip_a, b, skip_b = waiting.pop()
            (final_a, arcs_a), (final_b, arcs_b) = self.states[a], other.states[b]
            if final_a and final_b:
                yield prefix, self.weights[skip_a], other.weights[skip_b]
            there: dict[bytes, tuple[int, int]] = {}
            skip_b += final_b
            for word, target in arcs_b:
                there[other.words[word]] = target, skip_b
                skip_b += other.behind[target]
            skip_a += final_a
            for number, target in arcs_a:
                word = self.words[number]
                if word in there:
                    waiting.append(((*prefix, word), target, skip_a, *there[word]))
                skip_a += self.behind[target]

    def to_bytes(self) -> bytes:
        arcs = [arc for _, arcs in self.states for arc in arcs]
        stored = (
            b"\xff".join(self.words),
            np.array([2 * len(arcs) + final for final, arcs in self.states], dtype="<u4").tobytes(),
            np.array(arcs, dtype="<u4").tobytes(),
            np.array(self.weights, dtype="<u8").tobytes(),
        )
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(stored))

    @classmethod
    def from_bytes(cls, stored: bytes) -> CountTransducer:
        joined, heads, arcs, weights = pickle.loads(zstandard.ZstdDecompressor().decompress(stored))
        arcs = list(map(tuple, np.frombuffer(arcs, "<u4").reshape(-1, 2).tolist()))
        states, at = [], 0
        for head in np.frombuffer(heads, "<u4").tolist():
            states.append((bool(head & 1), tuple(arcs[at : at + head // 2])))
            at += head // 2
        return cls(joined.split(b"\xff"), states, np.frombuffer(weights, "<u8").tolist())


def union(transducers: Iterable[CountTransducer]) -> dict[Phrase, int]:
    """Counts summed over transducers; phrases in no order."""
    total: dict[Phrase, int] = {}
    for transducer in transducers:
        for phrase, weight in transducer.items():
            total[phrase] = total.get(phrase, 0) + weight
    return total
