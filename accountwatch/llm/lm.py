"""Katz backoff: a bigram model with Good-Turing discounts and exactly normalised backoff weights.

A text is its words and one end; the first word follows the beginning of the text. Counts come
from the training documents alone. A pair that occurs there has its discounted count over that
of its first word. What the discounts set free is given, as the first word's backoff weight, to
the words not seen after it in proportion to their own probabilities; there the same rule applies
once more: discounted counts, and what they leave is the probability of an unknown word. So the
probabilities after any word, over the training words and one unknown word, add up to 1.

Counts stay in partitioned tables. Words are placed by their hash, pairs by that of their first
word, so that all that its backoff weight needs lies together. First words that are a good part
of the corpus are found first; their pairs are dealt out by both words, and a table of a bounded
number of entries carries their sums. Tasks pass on what each document's pairs add up to, not pairs.

Discounts: counts to five, by Katz's formula from the numbers of pairs (words) that occur once,
twice and so on. Where those give a discount that is not between 0 and 1, as in tiny or much
copied corpora, each of the five counts loses n1 / (n1 + 2 n2) instead (a half if none occurs
once). Where a first word's pairs all count more than five, nothing is set free; then its
probabilities are scaled by c / (c + 1).

Defined results: a null or empty text is one end; null ids are training rows like others whose
hash says so; repeated rows count as often as they stand; without training rows every
probability is that of the unknown word, 1; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwatch.llm.text import whole
from accountwatch.llm.words import PLAIN, numbering, text_slices, words
from accountwatch.session import shared_folder

#: Counts that are discounted.
DISCOUNTED = 5
#: Characters of texts taken together, and characters of the corpus for each part of a table.
SHARD_CHARS = 5_000_000
PART_CHARS = 8_000_000
#: A word is common if it is one in so many of all training tokens; so there are no more such words.
COMMON = 400

#: Stands for the beginning of a text as a first word and for its end as a second one; no word is empty.
EDGE = b""


def _pack(*values: object) -> bytes:
    slim = [_slim(v) if isinstance(v, np.ndarray) else v for v in values]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(slim, protocol=5))


def _unpack(stored: bytes) -> list:
    return [
        v.astype(np.int64) if isinstance(v, np.ndarray) and v.dtype.kind == "u" else v
        for v in pickle.loads(zstandard.ZstdDecompressor().decompress(stored))
    ]


def _slim(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(a.max(initial=0))) if a.dtype.kind == "i" else a


def _join(found: list[bytes]) -> bytes:
    return b" ".join(found)


def _split(joined: bytes) -> list[bytes]:
    return joined.split(b" ")


def discounts(n: list[int]) -> np.ndarray:
    """The share that counts 1 to 5 keep, from how many things occur once to six times."""
    r = np.arange(1, DISCOUNTED + 1)
    if all(n):
        many = np.array(n, dtype=float)
        rest = (DISCOUNTED + 1) * many[DISCOUNTED] / many[0]
        kept = ((r + 1) * many[1:] / (r * many[:-1]) - rest) / (1 - rest) if rest != 1 else np.zeros(DISCOUNTED)
        if (kept > 0).all() and (kept < 1).all():
            return kept
    lost = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return 1 - lost / r


class Words:
    """Probabilities of single words from their counts."""

    def __init__(self, tokens: int, distinct: int, n: list[int]):
        self.tokens, self.distinct = tokens, distinct
        self.kept = discounts(n)
        r = np.arange(1, DISCOUNTED + 1)
        freed = float(np.sum(np.array(n[:DISCOUNTED]) * r * (1 - self.kept)))
        self.scale = 1.0 if freed else tokens / (tokens + 1)
        self.unknown = freed / tokens if freed else 1 / (tokens + 1)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        share = np.where(counts > DISCOUNTED, self.scale, np.r_[0.0, self.kept][np.minimum(counts, DISCOUNTED)])
        return np.where(counts > 0, share * counts / max(self.tokens, 1), self.unknown)


class Shard:
    """Pairs of some texts: numbers of first and second words, and the document of each pair."""

    def __init__(self, texts: list[str | None], train: np.ndarray):
        numbers = numbering()
        numbers[EDGE]
        rows = []
        for text in texts:
            found = words(text, PLAIN)
            found.append(EDGE)
            rows.append(np.fromiter(map(numbers.__getitem__, found), dtype=np.int32, count=len(found)))
        self.names = list(numbers)
        self.lengths = np.array([len(row) for row in rows], dtype=np.int64)
        self.second = np.concatenate(rows)
        # A text ends where the next one begins, and both are the edge.
        self.first = np.zeros_like(self.second)
        self.first[1:] = self.second[:-1]
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        self.train = train
        self.crc = np.fromiter(map(zlib.crc32, self.names), dtype=np.int64, count=len(self.names))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Shard]]:
    for batch in batches:
        sizes = pc.utf8_length(batch.column("text")).to_pylist()
        for begin, end in text_slices(sizes, SHARD_CHARS):
            part = batch.slice(begin, end - begin)
            yield part, Shard(part.column("text").to_pylist(), part.column("train").to_numpy(zero_copy_only=False))


def _rows(rows: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    return [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(schema)]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(_rows(rows, schema), schema=schema)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays(_rows(rows, schema), schema=schema)


def _fields(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


_PLACED = "place int, words binary, counts binary"
_TALLY = "kind int, place int, shard string, many bigint, held binary"
_PAIRS = "place int, shard string, held binary"
_ASKED = "place int, home int, words binary"
_ANSWERS = "place int, origin int, counts binary"
_BACKED = "kind int, place int, shard string, mass double, held binary"


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    (df.write.partitionBy("kind") if "kind" in df.columns else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Words


def vocabulary(texts: DataFrame, parts: int) -> DataFrame:
    """Per part: the words of training documents with their counts, placed by hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _fields(_PLACED)
        for _, shard in _slices(batches):
            many = np.bincount(shard.second[shard.train[shard.doc]], minlength=len(shard.names))
            held = np.flatnonzero(many)
            held = held[np.argsort(shard.crc[held] % parts, kind="stable")]
            places, starts = np.unique(shard.crc[held] % parts, return_index=True)
            rows = [
                (int(place), _join([shard.names[i] for i in part]), _pack(many[part]))
                for place, part in zip(places, np.split(held, starts[1:]) if len(held) else [], strict=True)
            ]
            yield _batch(rows, schema)

    def add(key: tuple, table: pa.Table) -> pa.Table:
        numbers = numbering()
        which, many = [], []
        for joined, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
            which += map(numbers.__getitem__, _split(joined))
            many.append(_unpack(counts)[0])
        total = np.bincount(which, weights=np.concatenate(many)).astype(np.int64)
        return _table([(key[0].as_py(), _join(list(numbers)), _pack(total))], _fields(_PLACED))

    return texts.mapInArrow(count, _PLACED).groupBy("place").applyInArrow(add, _PLACED)


def word_figures(stored: DataFrame) -> tuple[Words, dict[bytes, int], int]:
    """The model of single words; the common words and their counts, at most ``COMMON``; the training documents."""

    def count(batches: Iterator[pa.RecordBatch], least: int | None) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for joined, packed in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                counts = _unpack(packed)[0]
                if least is None:
                    found = _split(joined)
                    ends = int(counts[found.index(EDGE)]) if EDGE in found else 0
                    n = np.bincount(counts[counts <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)[1:]
                    rows += [(-1, int(counts.sum()), b""), (0, len(counts), b""), (-2, ends, b"")]
                    rows += [(i, int(x), b"") for i, x in enumerate(n, 1)]
                else:
                    found = _split(joined)
                    rows += [(0, int(counts[i]), found[i]) for i in np.flatnonzero(counts >= least)]
        yield _batch(rows, _fields("key int, many bigint, word binary"))

    sums = dict.fromkeys(range(-2, DISCOUNTED + 2), 0)
    figures = stored.mapInArrow(lambda batches: count(batches, None), "key int, many bigint, word binary")
    sums |= {row.key: row.many for row in figures.groupBy("key").agg(F.sum("many").alias("many")).collect()}
    least = max(1, sums[-1] // COMMON + 1)
    common = stored.mapInArrow(lambda batches: count(batches, least), "key int, many bigint, word binary").collect()
    model = Words(sums[-1], sums[0], [sums[i] for i in range(1, DISCOUNTED + 2)])
    return model, {bytes(row.word): row.many for row in common}, sums[-2]


# Pairs


def placed_pairs(texts: DataFrame, common: dict[bytes, int], parts: int) -> DataFrame:
    """Per shard and part: words, runs of equal pairs and the documents they stand in; and the documents of each shard."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _fields(_PAIRS)
        task = TaskContext.get().partitionId()
        for number, (batch, shard) in enumerate(_slices(batches)):
            name = f"{task}-{number}"
            ids = batch.column("id").to_pylist()
            rows = [(zlib.crc32(name.encode()) % parts, name, _pack(ids, shard.train.tolist(), shard.lengths))]
            spread = np.fromiter((word in common for word in shard.names), dtype=bool, count=len(shard.names))
            # The second word's hash is stirred, since equal hashes of both words would undo each other.
            stirred = (shard.crc * 0x9E3779B1 & 0xFFFFFFFF) >> 7
            place = (shard.crc[shard.first] + np.where(spread[shard.first], stirred[shard.second], 0)) % parts
            size = len(shard.names)
            order = np.argsort((place * size + shard.first) * size + shard.second, kind="stable")
            place = place[order]
            first, second, doc = shard.first[order], shard.second[order], shard.doc[order]
            at = np.flatnonzero(np.r_[True, np.diff(place) > 0])
            for begin, end in zip(at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
                rows.append((int(place[begin]), name, _runs(shard, first[begin:end], second[begin:end], doc[begin:end])))
            for row in rows:
                yield _batch([row], schema)

    return texts.mapInArrow(cut, _PAIRS)


def _runs(shard: Shard, first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> bytes:
    begins = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
    taught = np.add.reduceat(shard.train[doc].astype(np.int64), begins)
    firsts, a = np.unique(first[begins], return_inverse=True)
    seconds, b = np.unique(second[begins], return_inverse=True)
    docs, d = np.unique(doc, return_inverse=True)
    lengths = np.diff(np.r_[begins, len(doc)])
    names = shard.names
    return _pack(_join([names[i] for i in firsts]), _join([names[i] for i in seconds]), a, b, lengths, taught, docs, d)


class Part:
    """All pairs of some first words: counts, and where each token of them stands."""

    def __init__(self, shards: list[tuple[str, bytes]]):
        firsts, seconds = numbering(), numbering()
        self.shards: list[tuple[str, np.ndarray]] = []
        pairs, runs, tokens = [], [], []
        offset = 0
        for name, held in shards:
            a_words, b_words, a, b, lengths, taught, docs, d = _unpack(held)
            a = np.fromiter(map(firsts.__getitem__, _split(a_words)), dtype=np.int64)[a]
            b = np.fromiter(map(seconds.__getitem__, _split(b_words)), dtype=np.int64)[b]
            pairs.append((a, b))
            runs.append((lengths, taught))
            tokens.append(d + offset)
            self.shards.append((name, docs))
            offset += len(docs)
        self.firsts, self.seconds = list(firsts), list(seconds)
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        lengths, taught = (np.concatenate(x) for x in zip(*runs, strict=True))
        codes, which = np.unique(a * len(self.seconds) + b, return_inverse=True)
        self.first, self.second = codes // len(self.seconds), codes % len(self.seconds)
        #: Count of each pair in the training documents.
        self.count = np.bincount(which, weights=taught, minlength=len(codes)).astype(np.int64)
        self.pair = np.repeat(which, lengths)
        self.doc = np.concatenate(tokens)
        self.docs = offset

    def by_shard(self, *columns: np.ndarray) -> Iterator[tuple[str, np.ndarray, list[np.ndarray]]]:
        begin = 0
        for name, docs in self.shards:
            yield name, docs, [column[begin : begin + len(docs)] for column in columns]
            begin += len(docs)


#: Kinds of rows of the stored tables.
_FIGURES, _SUMS, _UNSEEN, _DOCS = range(4)


def count_pairs(pairs: DataFrame, model: Words, common: dict[bytes, int]) -> DataFrame:
    """Counts of pairs. Figures of all of them; sums by document over the pairs seen in training; the others, to be backed off."""
    numbers = {word: i for i, word in enumerate(sorted(common))}
    shipped = pairs.sparkSession.sparkContext.broadcast((model, common, numbers))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        model, common, numbers = shipped.value
        place, rows, shards = key[0].as_py(), [], []
        for name, held in zip(table.column("shard").to_pylist(), table.column("held").to_pylist(), strict=True):
            if len(_unpack(held)) == 3:
                rows.append((_DOCS, place, name, 0, held))
            else:
                shards.append((name, held))
        if shards:
            rows += _counted(Part(sorted(shards)), place, model, common, numbers)
        return _table(rows, _fields(_TALLY))

    return pairs.groupBy("place").applyInArrow(run, _TALLY)


def _scaled(small: np.ndarray, common: np.ndarray) -> np.ndarray:
    """First words with nothing set free by discounts; the parts of a common one cannot know that, so it always counts as one."""
    return (small.sum(axis=1) == 0) | common


def backoff(small: np.ndarray, total: np.ndarray, mass: np.ndarray, kept: np.ndarray, common: np.ndarray) -> np.ndarray:
    """log10 of the backoff weight: what the seen pairs leave, over what their second words leave among all words."""
    freed = small @ (np.arange(1, DISCOUNTED + 1) * (1 - kept))
    left = np.where(_scaled(small, common), (1 + freed) / (total + 1), freed / np.maximum(total, 1))
    return np.where(total > 0, np.log10(np.where(total > 0, left, 1.0)) - np.log10(1 - mass), 0.0)


def _counted(part: Part, place: int, model: Words, common: dict[bytes, int], numbers: dict[bytes, int]) -> list[tuple]:
    rows: list[tuple] = []
    spread = np.array([numbers.get(word, -1) for word in part.firsts], dtype=np.int64)
    few = np.minimum(part.count, DISCOUNTED + 1)
    rows += [(_FIGURES, r, None, int(n), None) for r, n in enumerate(np.bincount(few[part.count <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)) if r and n]
    # How many pairs of each first word have each small count.
    small = np.bincount(part.first * (DISCOUNTED + 2) + few, minlength=len(part.firsts) * (DISCOUNTED + 2)).reshape(-1, DISCOUNTED + 2)
    for i in np.flatnonzero(spread >= 0):
        rows += [(_FIGURES, int(100 + 10 * spread[i] + r), None, int(small[i, r]), None) for r in range(1, DISCOUNTED + 1) if small[i, r]]
    total = np.bincount(part.first, weights=part.count, minlength=len(part.firsts)).astype(np.int64)
    total = np.where(spread >= 0, [common.get(word, 0) for word in part.firsts], total)

    seen = part.count[part.pair] > 0
    pair, doc, docs = part.pair, part.doc, part.docs
    with np.errstate(divide="ignore", invalid="ignore"):
        own = np.log10(part.count / total[part.first])
    logs = np.bincount(doc[seen], weights=own[pair[seen]], minlength=docs)
    discounted = [np.bincount(doc[(part.count[pair] == r)], minlength=docs) for r in range(1, DISCOUNTED + 1)]
    scales = np.where(_scaled(small[:, 1 : DISCOUNTED + 1], spread >= 0) & (total > 0), np.log10(np.maximum(total, 1) / (total + 1.0)), 0.0)
    logs += np.bincount(doc[seen], weights=scales[part.first[pair[seen]]], minlength=docs)
    # Every word is once the first of a pair; the ends are added where the documents are.
    edge = np.array([word == EDGE for word in part.firsts])
    base = np.log10((total + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
    base = np.bincount(doc, weights=np.where(edge, 0.0, base)[part.first[pair]], minlength=docs)
    known = np.bincount(doc, weights=((total > 0) & ~edge)[part.first[pair]], minlength=docs).astype(np.int64)
    for name, at, columns in part.by_shard(logs, base, known, *discounted):
        rows.append((_SUMS, place, name, 0, _pack(at, *columns)))

    # All of a common word's pairs go on: its weight needs the parts where none of them is unseen, too.
    needs = spread >= 0
    needs[part.first[part.count == 0]] = True
    kept = np.flatnonzero(needs[part.first])
    firsts, a = np.unique(part.first[kept], return_inverse=True)
    seconds, b = np.unique(part.second[kept], return_inverse=True)
    unseen = np.flatnonzero(~seen)
    renumbered = np.full(len(part.count), -1, dtype=np.int64)
    renumbered[kept] = np.arange(len(kept))
    if len(kept):
        held = _pack(
            _join([part.seconds[i] for i in seconds]), a, b, part.count[kept], total[firsts], small[firsts, 1 : DISCOUNTED + 1],
            (spread[firsts] + 1), renumbered[pair[unseen]], doc[unseen], [(name, docs) for name, docs in part.shards],
        )
        rows.append((_UNSEEN, place, None, 0, held))
    return rows


# Backing off


def asked_words(unseen: DataFrame, parts: int) -> DataFrame:
    """The second words that each part needs probabilities of, placed by their own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, held in zip(batch.column("place").to_pylist(), batch.column("held").to_pylist(), strict=True):
                seconds = _split(_unpack(held)[0])
                rows = [(target, place, _join([seconds[i] for i in at])) for target, at in _by_part(seconds, parts)]
                yield _batch(rows, _fields(_ASKED))

    return unseen.select("place", "held").mapInArrow(run, _ASKED)


def _by_part(found: list[bytes], parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where the words of each part stand in a list."""
    crc = np.fromiter(map(zlib.crc32, found), dtype=np.int64, count=len(found)) % parts
    order = np.argsort(crc, kind="stable")
    places, starts = np.unique(crc[order], return_index=True)
    yield from zip(places.tolist(), np.split(order, starts[1:]), strict=True)


def _answers(key: tuple, asked: pa.Table, vocabulary: pa.Table) -> pa.Table:
    counts: dict[bytes, int] = {}
    for joined, packed in zip(vocabulary.column("words").to_pylist(), vocabulary.column("counts").to_pylist(), strict=True):
        counts.update(zip(_split(joined), _unpack(packed)[0].tolist(), strict=True))
    rows = [
        (home, key[0].as_py(), _pack(np.array([counts.get(word, 0) for word in _split(joined)], dtype=np.int64)))
        for home, joined in zip(asked.column("home").to_pylist(), asked.column("words").to_pylist(), strict=True)
    ]
    return _table(rows, _fields(_ANSWERS))


def back_off(unseen: DataFrame, answers: DataFrame, model: Words, kept: np.ndarray, parts: int) -> DataFrame:
    """Sums by document over the unseen pairs. Those after a common word lack its weight, whose part of the mass is told."""
    shipped = unseen.sparkSession.sparkContext.broadcast((model, kept))

    def run(key: tuple, pairs: pa.Table, answers: pa.Table) -> pa.Table:
        model, kept = shipped.value
        rows: list[tuple] = []
        told = dict(zip(answers.column("origin").to_pylist(), answers.column("counts").to_pylist(), strict=True))
        for held in pairs.column("held").to_pylist():
            joined, a, b, count, total, small, spread, pair, doc, shards = _unpack(held)
            seconds = _split(joined)
            counts = np.zeros(len(seconds), dtype=np.int64)
            for origin, at in _by_part(seconds, parts):
                counts[at] = _unpack(told[origin])[0]
            p = model.probabilities(counts)
            seen = count > 0
            mass = np.bincount(a[seen], weights=p[b[seen]], minlength=len(total))
            common = spread > 0
            rows += [(_FIGURES, int(spread[i] - 1), None, float(mass[i]), None) for i in np.flatnonzero(common)]
            weight = np.where(common, 0.0, backoff(small, total, np.where(common, 0.0, mass), kept, common))
            sums = np.bincount(doc, weights=(weight[a] + np.log10(p[b]))[pair], minlength=sum(len(docs) for _, docs in shards))
            met = np.flatnonzero(common[a[pair]])
            codes, many = np.unique(doc[met] * (COMMON + 1) + spread[a[pair[met]]] - 1, return_counts=True)
            present = np.zeros(len(sums), dtype=bool)
            present[doc] = True
            begin = 0
            for name, docs in shards:
                own = slice(begin, begin + len(docs))
                low, high = np.searchsorted(codes, [begin * (COMMON + 1), (begin + len(docs)) * (COMMON + 1)])
                at = docs[codes[low:high] // (COMMON + 1) - begin]
                here = present[own]
                if here.any():
                    rows.append((_SUMS, key[0].as_py(), name, 0.0, _pack(docs[here], sums[own][here], at, codes[low:high] % (COMMON + 1), many[low:high])))
                begin += len(docs)
        return _table(rows, _fields(_BACKED))

    return unseen.groupBy("place").cogroup(answers.groupBy("place")).applyInArrow(run, _BACKED)


def add_up(rows: DataFrame, kind: str, model: Words, ends: int, kept: np.ndarray, weights: np.ndarray, id_col: str) -> DataFrame:
    """Every document's figures from the parts of its shard."""
    shipped = rows.sparkSession.sparkContext.broadcast((model, ends, kept, weights))
    types = rows.sparkSession.createDataFrame([], f"id {kind}").toArrow().schema

    def run(key: tuple, table: pa.Table) -> pa.Table:
        model, ends, kept, weights = shipped.value
        order = sorted(zip(*(table.column(c).to_pylist() for c in ("backed", "kind", "place", "held")), strict=True), key=lambda row: row[:3])
        ids, train, lengths = next(_unpack(held) for _, row, _, held in order if row == _DOCS)
        score, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), dtype=np.int64)
        for backed, row, _, held in order:
            if backed:
                at, sums, which, of, many = _unpack(held)
                score[at] += sums
                np.add.at(score, which, weights[of] * many)
            elif row == _SUMS:
                at, logs, parts, words_known, *discounted = _unpack(held)
                score[at] += logs + sum(np.log10(share) * n for share, n in zip(kept, discounted, strict=True))
                base[at] += parts
                known[at] += words_known
        base += np.log10((ends + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
        columns = [
            pa.array(ids, types.field("id").type), pa.array([not t for t in train]), pa.array(lengths, pa.int64()), pa.array(known + (ends > 0), pa.int64()),
            pa.array([model.tokens] * len(ids), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()),
        ]
        return pa.Table.from_arrays(columns, names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return rows.groupBy("shard").applyInArrow(run, schema)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, tokens, known ones, training tokens, the base score and the model's log10 probability of each text."""
    texts = docs.select(F.col(id_col).alias("id"), whole(text).alias("text"), F.coalesce(~held_out, F.lit(True)).alias("train"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(8, chars // PART_CHARS)
    counts = _stored(vocabulary(texts, parts), "vocabulary")
    model, common, ends = word_figures(counts)
    tally = _stored(count_pairs(placed_pairs(texts, common, parts), model, common), "pairs")
    figures = {r.place: r.many for r in tally.where(F.col("kind") == _FIGURES).groupBy("place").agg(F.sum("many").alias("many")).collect()}
    kept = discounts([figures.get(r, 0) for r in range(1, DISCOUNTED + 2)])
    unseen = tally.where(F.col("kind") == _UNSEEN).select("place", "held")
    answers = asked_words(unseen, parts).groupBy("place").cogroup(counts.groupBy("place")).applyInArrow(_answers, _ANSWERS)
    backed = _stored(back_off(unseen, answers, model, kept, parts), "unseen")
    masses = {r.place: r.mass for r in backed.where(F.col("kind") == _FIGURES).groupBy("place").agg(F.sum("mass").alias("mass")).collect()}
    weights = np.zeros(len(common))
    if common:
        small = np.array([[figures.get(100 + 10 * i + r, 0) for r in range(1, DISCOUNTED + 1)] for i in range(len(common))])
        total = np.array([common[word] for word in sorted(common)])
        mass = np.array([masses.get(i, 0.0) for i in range(len(common))])
        weights = backoff(small, total, mass, kept, np.ones(len(common), dtype=bool))
    rows = tally.where(F.col("kind").isin(_SUMS, _DOCS)).select("shard", "kind", "place", "held", F.lit(False).alias("backed"))
    rows = rows.union(backed.where(F.col("kind") == _SUMS).select("shard", "kind", "place", "held", F.lit(True).alias("backed")))
    return add_up(rows, docs.schema[id_col].dataType.simpleString(), model, ends, kept, weights, id_col)
