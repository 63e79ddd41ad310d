"""Collocations: phrases that occur far more often than their parts would together.

Every shard of the corpus (a bounded run of texts) turns its sorted phrases of one to five
words into weighted acyclic automata, one for each range of prefixes; a prefix, the first two
words, lies in the range of its hash, so that common first words spread over many. Automata
of one range are united and their weights summed, which gives the count of every phrase.
What a candidate's score needs, the counts of its parts, lies in other ranges: the parts a
range asks another for are an automaton too, and composing it with the united one answers.

Before that a first pass keeps most phrases out of the automata: hashed counters, of a fixed
number whatever the corpus, bound the count of every phrase from above. A phrase goes on only
if the counters of itself and all its parts reach the least count. They leave out no phrase
that reaches it, and what they let through wrongly the exact counts remove. A corpus that fills
all counters is counted in full.

Defined results: a null or empty text has no words; a null language is ``und``; repeated
rows count as often as they stand; a phrase never reaches over the end of a piece or a
document; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountwatch.llm.automata import CountTransducer, Phrase, union
from accountwatch.llm.text import whole
from accountwatch.llm.words import MARK, marked_words, text_slices
from accountwatch.session import shared_folder

MOST_WORDS = 5
#: Counters for the phrases of one, two and three words each; longer ones are judged by their parts.
COUNTERS = 1 << 22
SKETCHED = 3
#: Counters of a row on their way to their sums.
COUNTER_BLOCK = 1 << 14
#: Characters of a shard, and words of the corpus for each range.
SHARD_CHARS = 12_000_000
RANGE_WORDS = 1_000_000

_FACTOR = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1
_PIECE_END = re.compile(r"[.,;:!?\x0A-\x0D]")


def _hash(word: bytes, lang: str) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=zlib.crc32(lang.encode()))


def range_of(phrase: Phrase, lang: str, ranges: int) -> int:
    """The range of a phrase's first two words."""
    key = _hash(phrase[0], lang)
    if len(phrase) > 1:
        key = (key * _FACTOR + _hash(phrase[1], lang)) & _WRAP
    return key % ranges


def _parts(text: str, most: int) -> Iterator[str]:
    """A very long text in parts that end where a piece does."""
    begin = 0
    while len(text) - begin > most:
        end = _PIECE_END.search(text, begin + most)
        if end is None:
            break
        yield text[begin : end.end()]
        begin = end.end()
    yield text[begin:]


class Shard:
    """Words of some texts as numbers, 0 between pieces, with a hash of each word and its language."""

    def __init__(self, texts: list[tuple[str, str]]):
        numbers = count(1)
        by_lang: dict[str, defaultdict] = {}
        rows = [np.zeros(1, dtype=np.int64)]
        for lang, text in texts:
            if lang not in by_lang:
                by_lang[lang] = defaultdict(numbers.__next__, {MARK: 0})
            found = marked_words(text)
            rows.append(np.fromiter(map(by_lang[lang].__getitem__, found), dtype=np.int64, count=len(found)))
        self.ids = np.concatenate(rows)
        self.langs = list(by_lang)
        size = next(numbers)
        self.names: list[bytes] = [b""] * size
        self.hashes = np.zeros(size, dtype=np.uint64)
        self.lang = np.zeros(size, dtype=np.int64)
        for i, lang in enumerate(self.langs):
            for word, number in by_lang[lang].items():
                if number:
                    self.names[number], self.hashes[number], self.lang[number] = word, _hash(word, lang), i

    def words_by_lang(self) -> dict[str, int]:
        many = np.bincount(self.lang[self.ids[self.ids > 0]], minlength=len(self.langs))
        return dict(zip(self.langs, many.tolist(), strict=True))

    def phrases(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each number of words, whether a phrase begins at a place, and its hash."""
        begins, keys = self.ids > 0, self.hashes[self.ids]
        for length in range(1, most + 1):
            if length > 1:
                begins = begins[:-1] & (self.ids[length - 1 :] > 0)
                keys = keys[:-1] * np.uint64(_FACTOR) + self.hashes[self.ids[length - 1 :]]
            yield begins, keys

    def counted(self, bitmaps: np.ndarray, most: int, ranges: int) -> Iterator[tuple[str, int, CountTransducer]]:
        """Language, range and automaton of what the counters let through."""
        shift = np.uint64(65 - bitmaps.shape[1].bit_length())
        begins = self.ids > 0
        ordinal = np.zeros(len(self.ids), dtype=np.int64)
        rows, weights, places = [], [], []
        for length, (_, keys) in enumerate(self.phrases(most), 1):
            if length > 1:
                begins = begins[:-1] & begins[1:]
            if length <= len(bitmaps):
                begins = begins & bitmaps[length - 1][keys >> shift]
            if length <= 2:
                prefix = keys
            at = np.flatnonzero(begins)
            # A phrase is the number of its beginning without the last word, and that word.
            codes = ordinal[at] * len(self.names) + self.ids[at + length - 1]
            _, first, inverse, many = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
            ordinal[at] = inverse
            first = at[first]
            row = np.zeros((len(first), most), dtype=np.int64)
            row[:, :length] = self.ids[first[:, None] + np.arange(length)]
            rows.append(row)
            weights.append(many)
            places.append((prefix[first] % np.uint64(ranges)).astype(np.int64))
        ids, weight, place = np.concatenate(rows), np.concatenate(weights), np.concatenate(places)
        # Words by number in their own order; only those of a phrase are sorted.
        used = np.flatnonzero(np.bincount(ids.ravel(), minlength=len(self.names)))[1:].tolist()
        ordered = sorted(used, key=self.names.__getitem__)
        rank = np.full(len(self.names), -1, dtype=np.int64)
        rank[ordered] = np.arange(len(ordered))
        lang, ranked = self.lang[ids[:, 0]], rank[ids]
        order = np.lexsort((*ranked.T[::-1], place, lang))
        ranked, weight, place, lang = ranked[order], weight[order], place[order], lang[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(lang) != 0)]) if len(order) else np.zeros(0, dtype=np.int64)
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=False):
            labels, own = np.unique(ranked[begin:end], return_inverse=True)
            padded = int(labels[0] < 0)
            words = [self.names[ordered[i]] for i in labels[padded:].tolist()]
            automaton = CountTransducer.from_rows(words, own.reshape(-1, most) - padded, weight[begin:end].tolist())
            yield self.langs[lang[begin]], int(place[begin]), automaton


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        texts = [
            (lang, part) for lang, text in zip(batch.column(0), batch.column(1), strict=True) for part in _parts(text.as_py(), SHARD_CHARS)
            for lang in [lang.as_py()]
        ]
        for begin, end in text_slices((len(text) for _, text in texts), SHARD_CHARS):
            yield Shard(texts[begin:end])


def upper_counts(texts: DataFrame, least: int) -> tuple[np.ndarray, int]:
    """Whether each counter reaches ``least``, and the words of the corpus. Of a fixed size."""
    kind = np.uint8 if least < 256 else np.uint32
    blocks = COUNTERS // COUNTER_BLOCK
    shift = np.uint64(65 - COUNTERS.bit_length())

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, total = np.zeros((SKETCHED, COUNTERS), dtype=np.uint32), 0
        for shard in _shards(batches):
            total += int((shard.ids > 0).sum())
            for length, (begins, keys) in enumerate(shard.phrases(SKETCHED)):
                where = (keys[begins] >> shift).astype(np.int64)
                counters[length] += np.bincount(where, minlength=COUNTERS).astype(np.uint32)
        # Sums reach the least count if and only if the sums of counts cut there do.
        cut = np.minimum(counters, least).astype(kind).reshape(SKETCHED * blocks, COUNTER_BLOCK)
        full = np.flatnonzero(cut.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *full.tolist()], pa.int32()), pa.array([total] + [0] * len(full), pa.int64()),
             pa.array([b"", *(cut[i].tobytes() for i in full)], pa.binary())],
            names=["block", "words", "counts"],
        )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        total = 0
        for batch in batches:
            for block, words, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                total += words
                if block >= 0:
                    held = sums.setdefault(block, np.zeros(COUNTER_BLOCK, dtype=np.uint64))
                    held += np.frombuffer(counts, dtype=kind)
        rows = [(block, 0, np.packbits(held >= least).tobytes()) for block, held in sums.items()]
        block, words, bits = zip(*rows, (-1, total, b""), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(words, pa.int64()), pa.array(bits, pa.binary())], names=["block", "words", "bits"])

    rows = texts.mapInArrow(sketch, "block int, words bigint, counts binary").repartition("block")
    bitmaps = np.zeros((SKETCHED * blocks, COUNTER_BLOCK), dtype=bool)
    total = 0
    for row in rows.mapInArrow(summed, "block int, words bigint, bits binary").collect():
        total += row.words
        if row.block >= 0:
            bitmaps[row.block] = np.unpackbits(np.frombuffer(row.bits, dtype=np.uint8)).astype(bool)
    return bitmaps.reshape(SKETCHED, COUNTERS), total


def shard_automata(texts: DataFrame, bitmaps: np.ndarray, most: int, ranges: int) -> DataFrame:
    """Per shard: range, lang and ``automaton`` of its phrases; and rows without a range with its words by language."""
    shipped = texts.sparkSession.sparkContext.broadcast(np.packbits(bitmaps, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shipped.value, axis=1).astype(bool)
        for shard in _shards(batches):
            rows = [(None, lang, n, None) for lang, n in shard.words_by_lang().items()]
            rows += [(place, lang, 0, automaton.to_bytes()) for lang, place, automaton in shard.counted(bits, most, ranges)]
            yield _batch(rows, _SHARD_KINDS)

    return texts.mapInArrow(run, "range int, lang string, words bigint, automaton binary")


_SHARD_KINDS = {"range": pa.int32(), "lang": pa.string(), "words": pa.int64(), "automaton": pa.binary()}
_ASKED_KINDS = {"range": pa.int32(), "lang": pa.string(), "home": pa.int32(), "automaton": pa.binary()}
_ANSWER_KINDS = {"range": pa.int32(), "lang": pa.string(), "contained": pa.bool_(), "automaton": pa.binary()}
_SCORED_KINDS = {"lang": pa.string(), "phrase": pa.string(), **{c: pa.int64() for c in ("a", "l", "r", "n", "score")}}


def _columns(rows: list[tuple], kinds: dict[str, pa.DataType]) -> list[pa.Array]:
    return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds.values())]


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(_columns(rows, kinds), names=list(kinds))


def _table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.Table.from_arrays(_columns(rows, kinds), names=list(kinds))


def _automata(table: pa.Table) -> list[CountTransducer]:
    return [CountTransducer.from_bytes(x.as_py()) for x in table.column("automaton")]


def united(shards: DataFrame, least: int) -> DataFrame:
    """range, lang and the automaton of all its phrases that occur ``least`` times."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        total = union(CountTransducer.from_bytes(x.as_py()) for x in table.column("automaton"))
        kept = sorted((phrase, n) for phrase, n in total.items() if n >= least)
        return _table([(key[0].as_py(), key[1].as_py(), CountTransducer.build(kept).to_bytes())] if kept else [], kinds)

    kinds = {k: v for k, v in _SHARD_KINDS.items() if k != "words"}
    return shards.where("range is not null").groupBy("range", "lang").applyInArrow(run, "range int, lang string, automaton binary")


def asked_parts(phrases: DataFrame, ranges: int) -> DataFrame:
    """Per pair of ranges: the parts of the one's candidates that begin in the other, each with the largest count of a candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for home, lang, stored in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                asked: dict[Phrase, int] = {}
                for phrase, n in CountTransducer.from_bytes(stored).items():
                    for k in range(1, len(phrase)):
                        for part in (phrase[:k], phrase[k:]):
                            asked[part] = max(n, asked.get(part, 0))
                placed = sorted((range_of(part, lang, ranges), part, n) for part, n in asked.items())
                rows = [
                    (place, lang, home, CountTransducer.build(row[1:] for row in parts).to_bytes())
                    for place, parts in groupby(placed, key=lambda row: row[0])
                ]
                yield _batch(rows, _ASKED_KINDS)

    return phrases.select("range", "lang", "automaton").mapInArrow(run, "range int, lang string, home int, automaton binary")


def _answers(key: tuple, asked: pa.Table, phrases: pa.Table) -> pa.Table:
    """The counts a range was asked for, to those that asked; and to itself, which of its phrases a longer one repeats each time."""
    rows: list[tuple] = []
    contained: set[Phrase] = set()
    place, lang = key[0].as_py(), key[1].as_py()
    for own in _automata(phrases):
        for home, request in zip(asked.column("home").to_pylist(), _automata(asked), strict=True):
            met = sorted(own.compose(request))
            rows.append((home, lang, False, CountTransducer.build((part, n) for part, n, _ in met).to_bytes()))
            contained.update(part for part, n, longest in met if longest >= n)
    if contained:
        rows.append((place, lang, True, CountTransducer.build((part, 1) for part in sorted(contained)).to_bytes()))
    return _table(rows, _ANSWER_KINDS)


def _scored(key: tuple, answers: pa.Table, phrases: pa.Table) -> pa.Table:
    """Candidates of a range that no longer one repeats, by their lowest cut."""
    counts: dict[Phrase, int] = {}
    contained: set[Phrase] = set()
    for flag, automaton in zip(answers.column("contained").to_pylist(), _automata(answers), strict=True):
        if flag:
            contained.update(part for part, _ in automaton.items())
        else:
            counts.update(automaton.items())
    rows = []
    for n, own in zip(phrases.column("n").to_pylist(), _automata(phrases), strict=True):
        for phrase, a in own.items():
            if len(phrase) > 1 and phrase not in contained:
                cuts = ((counts[phrase[:k]], counts[phrase[k:]], k) for k in range(1, len(phrase)))
                score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for l, r, k in cuts)
                rows.append((key[1].as_py(), b" ".join(phrase).decode(), a, l, r, n, score))
    return _table(rows, _SCORED_KINDS)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def candidates(docs: DataFrame, least: int = 100, most_words: int = MOST_WORDS, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, phrase, a, l, r, n and score of every phrase that counts ``least`` and that no longer one repeats each time."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), whole(text).alias("text")).where("text <> ''")
    bitmaps, total = upper_counts(texts, least)
    ranges = max(8, total // RANGE_WORDS)
    shards = _stored(shard_automata(texts, bitmaps, most_words, ranges), "shards")
    phrases = _stored(united(shards, least), "phrases")
    sizes = shards.where("range is null").groupBy("lang").agg(F.sum("words").alias("n"))
    answers = (
        asked_parts(phrases, ranges).groupBy("range", "lang").cogroup(phrases.groupBy("range", "lang"))
        .applyInArrow(_answers, "range int, lang string, contained boolean, automaton binary")
    )
    return (
        answers.groupBy("range", "lang").cogroup(phrases.join(sizes, "lang").groupBy("range", "lang"))
        .applyInArrow(_scored, "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    )


def collocations(docs: DataFrame, top: int = 2000, **settings: object) -> DataFrame:
    """The first ``top`` candidates of each language, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = candidates(docs, **settings).withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
