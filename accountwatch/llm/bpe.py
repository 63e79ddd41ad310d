"""Byte-level BPE by replaying all merges over the distinct words of a corpus part.

The words of a part are laid out as one sequence of byte tokens. An inverted index
leads from a merge to the places of its pair; merges are applied in rank order, each
to all its places, and only the neighbours of a merged place enter the index anew.
Ids come back as bytes, so that a document is a concatenation of its words.

Defined results: a null text is empty and has no ids; no special tokens; repeated rows
are encoded alike; an empty table gives an empty result. Texts are never cut short: a
word of any length is one sequence of the index.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwatch.llm.chunks import ChunkCounter, ChunkEncoder, text_batches
from accountwatch.llm.text import whole

#: Bytes of distinct words that are replayed together.
PART_BYTES = 1 << 21
#: A few short words, as an edit brings them, are not worth an index.
SHORT_PART = 2_000
SHORT_WORD = 64
#: A merge with so many places is applied to all of them at once.
MANY = 48


class _State(NamedTuple):
    """Tokens and their neighbours, -1 for none or merged away; each as an array and as a numpy view of it."""

    tok: array
    nxt: array
    prv: array
    ids: np.ndarray
    after: np.ndarray
    before: np.ndarray


class _Index:
    """From a merge to the places where its pair begins, some of them out of date."""

    def __init__(self) -> None:
        self.queue: list[int] = []
        self.many: dict[int, list[np.ndarray]] = {}
        self.single: dict[int, list[int]] = {}

    def add(self, places: np.ndarray, ranks: np.ndarray) -> None:
        places, ranks = places[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        firsts = np.flatnonzero(np.diff(ranks, prepend=-1))
        for rank, part in zip(ranks[firsts].tolist(), np.split(places, firsts[1:]) if len(firsts) else [], strict=True):
            if rank not in self.many:
                self.many[rank] = []
                if rank not in self.single:
                    heappush(self.queue, rank)
            self.many[rank].append(part)

    def add_one(self, place: int, rank: int, lowest: int) -> int:
        """Adds a place unless the pair has no merge; the lower one of its merge and ``lowest``."""
        if rank < 0:
            return lowest
        if rank in self.single:
            self.single[rank].append(place)
        else:
            self.single[rank] = [place]
            if rank not in self.many:
                heappush(self.queue, rank)
        return min(rank, lowest)

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heappop(self.queue)
        single = np.array(self.single.pop(rank, ()), dtype=np.int32)
        return rank, np.concatenate([*self.many.pop(rank, ()), single])


class MergeReplay:
    """Ids of words under a table of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.wide = 1 << (max(ranks.values()) + 1).bit_length()
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        #: Every pair that has a merge: all the ways to cut a token into two others.
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.wide + right] = rank
        self.pair_codes = np.array(sorted(self.pairs), dtype=np.int64)
        self.pair_merges = np.array([self.pairs[code] for code in self.pair_codes.tolist()], dtype=np.int64)
        every = np.arange(256)
        #: The merges of two bytes, by both.
        self.byte_merges = self._lowest(self.byte_ids[every[:, None]].repeat(256, 1), self.byte_ids[every[None, :]].repeat(256, 0))

    def pair_rank(self, pair: int) -> int:
        """The merge of a pair of ids, -1 for none."""
        return self.pairs.get(pair, -1)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        if sum(map(len, words)) < SHORT_PART and all(len(word) <= SHORT_WORD for word in words):
            return [np.array(self._merge_word(word), dtype="<u4") for word in words]
        out: list[np.ndarray] = []
        begin = size = 0
        for i, word in enumerate(words):
            size += len(word)
            if size >= PART_BYTES or i + 1 == len(words):
                out += self._replay(words[begin : i + 1])
                begin, size = i + 1, 0
        return out

    def count(self, words: list[bytes]) -> list[int]:
        """Numbers of ids. Short words of one length are merged side by side, one merge of each at a time."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        counts = lengths.copy()
        order = np.argsort(lengths, kind="stable")
        firsts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
        for which in np.split(order, firsts[1:]) if len(firsts) else []:
            size = int(lengths[which[0]])
            if size > SHORT_WORD:
                counts[which] = [len(ids) for ids in self.encode([words[i] for i in which.tolist()])]
            elif size > 1:
                for begin in range(0, len(which), max(1, PART_BYTES // size)):
                    part = which[begin : begin + max(1, PART_BYTES // size)]
                    counts[part] -= self._merges(b"".join([words[i] for i in part.tolist()]), size)
        return counts.tolist()

    def _merges(self, joined: bytes, size: int) -> np.ndarray:
        """How often each of the joined words, all of one size, is merged: its lowest merge, leftmost first, until it has none."""
        letters = np.frombuffer(joined, dtype=np.uint8).reshape(-1, size)
        ids = self.byte_ids[letters]
        merges = self.byte_merges[letters[:, :-1], letters[:, 1:]]
        done = np.zeros(len(ids), dtype=np.int64)
        left = np.arange(len(ids))
        while merges.shape[1]:
            at = merges.argmin(axis=1)
            lowest = merges[np.arange(len(at)), at]
            going = np.flatnonzero(lowest < self.wide)
            if not len(going):
                break
            if len(going) < len(left):
                left, ids, merges, at, lowest = left[going], ids[going], merges[going], at[going], lowest[going]
            done[left] += 1
            # All that are left have equally many ids, and lose one each.
            rows = np.arange(len(left))
            ids[rows, at] = lowest
            kept = np.ones(ids.shape, dtype=bool)
            kept[rows, at + 1] = False
            ids = ids[kept].reshape(len(rows), -1)
            kept = np.ones(merges.shape, dtype=bool)
            kept[rows, at] = False
            merges = merges[kept].reshape(len(rows), -1)
            inner = np.flatnonzero(at < merges.shape[1])
            merges[inner, at[inner]] = self._lowest(lowest[inner], ids[inner, at[inner] + 1])
            inner = np.flatnonzero(at > 0)
            merges[inner, at[inner] - 1] = self._lowest(ids[inner, at[inner] - 1], lowest[inner])
        return done

    def _lowest(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge of each pair, ``wide`` for none, so that the lowest is one that there is."""
        ranks = self._pair_ranks(left, right)
        return np.where(ranks < 0, self.wide, ranks)

    def _merge_word(self, word: bytes) -> list[int]:
        """A short word by itself: its lowest merge, leftmost first, until it has none."""
        ids = [self.ranks[word[i : i + 1]] for i in range(len(word))]
        while len(ids) > 1:
            ranks = [self.pair_rank(a * self.wide + b) for a, b in zip(ids, ids[1:], strict=False)]
            lowest = min((r for r in ranks if r >= 0), default=-1)
            if lowest < 0:
                break
            at = ranks.index(lowest)
            ids[at : at + 2] = [lowest]
        return ids

    def _replay(self, words: list[bytes]) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(words) else 0
        if not n:
            return [np.zeros(0, dtype="<u4") for _ in words]
        ids = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        full = lengths > 0
        after[ends[full] - 1] = -1
        before[(ends - lengths)[full]] = -1

        tok, nxt, prv = (array("i", x.astype(np.int32).tobytes()) for x in (ids, after, before))
        state = _State(tok, nxt, prv, *(np.frombuffer(x, dtype=np.int32) for x in (tok, nxt, prv)))
        index = _Index()
        places = np.flatnonzero(after >= 0).astype(np.int32)
        index.add(places, self._pair_ranks(ids[places], ids[places + 1]))
        while index.queue:
            rank, spots = index.pop()
            if len(spots) < MANY or not self._merge_all(state, index, rank, spots):
                self._merge_each(state, index, rank, spots.tolist())

        ids = state.ids
        alive = ids >= 0
        stops = np.cumsum(alive)[ends - 1] if n else ends
        stops = np.where(ends > 0, stops, 0)
        return np.split(ids[alive].astype("<u4"), stops[:-1])


    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge of each pair, -1 for none."""
        if not len(self.pair_codes):
            return np.full(len(left), -1, dtype=np.int64)
        codes = left.astype(np.int64) * self.wide + right
        at = np.minimum(np.searchsorted(self.pair_codes, codes), len(self.pair_codes) - 1)
        return np.where(self.pair_codes[at] == codes, self.pair_merges[at], -1)

    def _merge_all(self, s: _State, index: _Index, rank: int, spots: np.ndarray) -> bool:
        """Applies a merge to all its places at once.

        Refuses, with nothing changed, where their order matters: places that overlap,
        and merges that give rise to one of a lower rank.
        """
        spots = np.sort(spots)
        spots = spots[(s.ids[spots] >= 0) & (s.after[spots] >= 0)]
        rights = s.after[spots]
        fits = self._pair_ranks(s.ids[spots], s.ids[rights]) == rank
        spots, rights = spots[fits], rights[fits]
        if len(spots) == 0:
            return True
        if (rights[:-1] >= spots[1:]).any():
            return False
        following, lefts = s.after[rights], s.before[spots]
        # To the left stands what an earlier place has become, to the right what is not merged yet.
        left_ids = s.ids[lefts]
        joined = np.flatnonzero(lefts[1:] == rights[:-1]) + 1
        lefts[joined], left_ids[joined] = spots[joined - 1], rank
        with_right, with_left = following >= 0, lefts >= 0
        fresh_right = self._pair_ranks(np.full(with_right.sum(), rank), s.ids[following[with_right]])
        fresh_left = self._pair_ranks(left_ids[with_left], np.full(with_left.sum(), rank))
        for fresh in (fresh_right, fresh_left):
            if ((fresh >= 0) & (fresh < rank)).any():
                return False
        s.ids[spots] = rank
        s.ids[rights] = -1
        s.after[spots] = following
        s.before[following[with_right]] = spots[with_right]
        index.add(spots[with_right], fresh_right)
        index.add(lefts[with_left], fresh_left)
        return True

    def _merge_each(self, s: _State, index: _Index, rank: int, spots: list[int]) -> None:
        """Applies a merge place by place, from the left."""
        spots.sort()
        tok, nxt, prv, wide = s.tok, s.nxt, s.prv, self.wide
        for done, at in enumerate(spots):
            right = nxt[at]
            if tok[at] < 0 or right < 0 or self.pair_rank(tok[at] * wide + tok[right]) != rank:
                continue
            tok[at], tok[right] = rank, -1
            following = nxt[at] = nxt[right]
            left, lowest = prv[at], rank
            if following >= 0:
                prv[following] = at
                lowest = index.add_one(at, self.pair_rank(rank * wide + tok[following]), lowest)
            if left >= 0:
                lowest = index.add_one(left, self.pair_rank(tok[left] * wide + rank), lowest)
            if lowest < rank:
                # A merge of a lower rank has appeared: it goes first, the other places wait.
                rest = np.array(spots[done + 1 :], dtype=np.int32)
                index.add(rest, np.full(len(rest), rank))
                return


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Bpe:
    """Encoder and decoder of one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.chunks = ChunkEncoder(pattern, self._encode_words)
        self.counter = ChunkCounter(pattern, lambda words: self.replay.count([word.encode("utf-8") for word in words]))
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(token for token, _ in sorted(ranks.items(), key=lambda t: t[1])), dtype=np.uint8)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.replay.encode([word.encode("utf-8") for word in words])]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.chunks.encode(texts)

    def decode(self, ids: bytes, piece: int = 1 << 20) -> Iterator[bytes]:
        """The text's bytes, gathered from the vocabulary in pieces of a bounded number of ids."""
        every = np.frombuffer(ids, dtype="<u4")
        for begin in range(0, len(every), piece):
            part = every[begin : begin + piece]
            sizes = self.lengths[part]
            shift = np.repeat(self.starts[part] - (np.cumsum(sizes) - sizes), sizes)
            yield self.blob[np.arange(len(shift)) + shift].tobytes()


@lru_cache(maxsize=2)
def worker_bpe(path: str, pattern: str) -> Bpe:
    return Bpe(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and ``ids`` of every text. One pass over the rows, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(path, pattern)
        for batch in batches:
            for begin, texts in text_batches(batch.column(1)):
                ids = pa.array(bpe.encode(texts), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), ids], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole(text).alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


_DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]


def _digests(bpe: Bpe, encoded: Iterable[bytes]) -> list[pa.Array]:
    """Number of ids, the digest of the ids and that of the bytes they decode to."""
    counts, ids_hash, decoded_hash = [], [], []
    for ids in encoded:
        digest = hashlib.sha256()
        for part in bpe.decode(ids):
            digest.update(part)
        counts.append(len(ids) // 4)
        ids_hash.append(hashlib.sha256(ids).hexdigest())
        decoded_hash.append(digest.hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(decoded_hash, pa.string())]


def _digest_schema(kind: str, id_col: str) -> str:
    return f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """id, ``n_tokens`` and the digests of the ids and of the bytes they decode to.

    The texts themselves come from :meth:`Bpe.decode`; a digest is what a check of a
    round trip over a large corpus needs, and is as small as a row should be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(path, pattern)
        for batch in batches:
            digests = _digests(bpe, (value.as_py() or b"" for value in batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *digests], names=[id_col, *_DIGESTS])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, F.col(ids)).mapInArrow(run, _digest_schema(kind, id_col))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``decode_documents`` gives for ``encode_documents``, in one pass and one worker a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(path, pattern)
        for batch in batches:
            for begin, texts in text_batches(batch.column(1)):
                digests = _digests(bpe, bpe.encode(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), *digests], names=[id_col, *_DIGESTS])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole(text).alias("_text")).mapInArrow(run, _digest_schema(kind, id_col))
