"""Ranked lexical search by presence masks.

A block of documents holds, for each term of the items, a bitmap of the documents that
have it. Documents of an item with the same matched terms share one mask. The best score
that a mask allows is known before any of its documents is scored: its terms' weights
times the most that a term can reach in the block. Masks are evaluated by descending
maximum until the next one cannot reach the k best found so far; ties are evaluated.

The documents are read once for a block of items: what they hold of the items' terms is
written as postings, from which document frequencies and then scores are read. Only the
k best of an item leave a task.

Defined results: a null text has no term and is in no result; a null item text ranks
nothing; items with equal texts get the same ranking and repeated item rows one each;
documents are rows, so a repeated row is ranked twice and tied; equal scores go by
ascending id, null ids last; empty tables give empty results; further columns of either
table are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountwatch.llm.text import whole
from accountwatch.llm.words import TERMS, words
from accountwatch.session import shared_folder

#: Characters of distinct item texts whose terms are shipped to the tasks together.
ITEM_CHARS = 4_000_000
#: Documents of a block, whose postings are held as a dense matrix.
BLOCK_DOCS = 1024
#: Cells of that matrix.
BLOCK_CELLS = 1 << 23
#: Documents scored at a time.
SCORED_TOGETHER = 64


class Queries:
    """The items of a block: their distinct terms, and each item's terms with how often it has them."""

    def __init__(self, texts: list[str]):
        counts = [Counter(words(text, TERMS)) for text in texts]
        self.texts = texts
        self.terms = {term: i for i, term in enumerate(sorted(set().union(*counts)))}
        self.of = [np.array([self.terms[t] for t in c], dtype=np.int64) for c in counts]
        self.times = [np.array(list(c.values()), dtype=np.int64) for c in counts]


def weight(documents: int, df: int) -> int:
    """How much a term that ``df`` of the documents hold counts."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def postings(docs: DataFrame, terms: dict[bytes, int], id_col: str, text: str) -> DataFrame:
    """Per document: id, ``n`` terms, and the asked ones among them as ``ids`` and ``tfs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shipped.value
        for batch in batches:
            n, ids, tfs = [], [], []
            for value in batch.column(1):
                found = words(value.as_py(), TERMS)
                n.append(len(found))
                held = Counter(asked[w] for w in found if w in asked)
                ids.append(np.fromiter(held, dtype="<i4", count=len(held)).tobytes())
                tfs.append(np.fromiter(held.values(), dtype="<i4", count=len(held)).tobytes())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "ids", "tfs"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole(text).alias("_text")).mapInArrow(run, f"id {kind}, n bigint, ids binary, tfs binary")


def document_frequencies(stored: DataFrame, terms: int) -> np.ndarray:
    """Documents by term, then the documents with a term, then all their terms. Bounded by the items' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 2, dtype=np.int64)
        for batch in batches:
            n = batch.column("n").to_numpy()
            held = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype="<i4")
            total[:terms] += np.bincount(held, minlength=terms)[:terms]
            total[terms:] += (n > 0).sum(), n.sum()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "many"])

    sums = np.zeros(terms + 2, dtype=np.int64)
    for row in stored.mapInArrow(run, "term bigint, many bigint").groupBy("term").agg(F.sum("many").alias("many")).collect():
        sums[row.term] = row.many
    return sums


class Block:
    """Postings of some documents: what each term adds to each, and a bitmap over the documents for each term."""

    def __init__(self, ids: list, n: np.ndarray, held: list[bytes], tfs: list[bytes], terms: int, documents: int, length: int):
        self.ids = ids
        grown = 75 + (25 * n * documents) // max(length, 1)
        term = np.frombuffer(b"".join(held), dtype="<i4")
        doc = np.repeat(np.arange(len(ids)), [len(h) // 4 for h in held])
        tf = np.frombuffer(b"".join(tfs), dtype="<i4").astype(np.int64)
        adds = (10**9 * tf) // (1000 * tf + 12 * grown[doc])
        present, row = np.unique(term, return_inverse=True)
        self.row = np.full(terms, -1, dtype=np.int64)
        self.row[present] = np.arange(len(present))
        self.adds = np.zeros((len(present), len(ids)), dtype=np.int64)
        self.adds[row, doc] = adds
        has = np.zeros(self.adds.shape, dtype=bool)
        has[row, doc] = True
        self.bitmaps = np.packbits(has, axis=1)
        self.most = self.adds.max(axis=1, initial=0)

    def masks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct masks over the terms at ``rows`` as a matrix, the documents ordered by mask, and where each mask begins."""
        held = np.unpackbits(self.bitmaps[rows], axis=1, count=len(self.ids))
        packed = np.ascontiguousarray(np.packbits(held, axis=0).T)
        wide = -packed.shape[1] % 8
        keys = np.ascontiguousarray(np.pad(packed, ((0, 0), (0, wide)))).view(np.uint64)
        order = np.lexsort(keys.T) if keys.shape[1] > 1 else np.argsort(keys[:, 0], kind="stable")
        ordered = keys[order]
        starts = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
        return held[:, order[starts]].T.astype(np.int64), order, starts

    def scores(self, rows: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return weights @ self.adds[np.ix_(rows, docs)]


def _order(pair: tuple[int, object]) -> tuple:
    score, doc = pair
    return -score, doc is None, 0 if doc is None else doc


def best_of_block(block: Block, terms: np.ndarray, weights: np.ndarray, best: list[tuple[int, object]], k: int) -> list[tuple[int, object]]:
    """The ``k`` best of an item after this block, given those before it."""
    rows = block.row[terms]
    rows, weights = rows[rows >= 0], weights[rows >= 0]
    floor = best[-1][0] if len(best) == k else 1
    if not len(rows) or int(weights @ block.most[rows]) < floor:
        return best
    masks, order, starts = block.masks(rows)
    maxima = masks @ (weights * block.most[rows])
    ends = np.r_[starts[1:], len(order)]
    waiting: list[np.ndarray] = []
    descending = np.argsort(-maxima, kind="stable").tolist()
    for turn, mask in enumerate(descending):
        if maxima[mask] < floor:
            break
        waiting.append(order[starts[mask] : ends[mask]])
        last = turn + 1 == len(descending) or maxima[descending[turn + 1]] < floor
        if last or sum(map(len, waiting)) >= SCORED_TOGETHER:
            docs = np.concatenate(waiting)
            waiting = []
            scores = block.scores(rows, weights, docs)
            fit = np.flatnonzero(scores >= floor)
            best = sorted([*best, *((int(scores[i]), block.ids[docs[i]]) for i in fit)], key=_order)[:k]
            floor = best[-1][0] if len(best) == k else 1
    return best


def best_documents(stored: DataFrame, queries: Queries, sums: np.ndarray, k: int) -> DataFrame:
    """query (its place), id and score: the ``k`` best of each task for each item, in place of all its documents."""
    terms, (documents, length) = len(queries.terms), (int(x) for x in sums[-2:])
    by_term = np.array([weight(documents, int(df)) for df in sums[:-2]], dtype=np.int64)
    asked = [(of, by_term[of] * times) for of, times in zip(queries.of, queries.times, strict=True)]
    shipped = stored.sparkSession.sparkContext.broadcast(asked)
    docs_at_once = max(1, min(BLOCK_DOCS, BLOCK_CELLS // max(terms, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, object]]] = [[] for _ in shipped.value]
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for begin in range(0, batch.num_rows, docs_at_once):
                part = batch.slice(begin, docs_at_once).to_pydict()
                block = Block(part["id"], np.array(part["n"], dtype=np.int64), part["ids"], part["tfs"], terms, documents, length)
                for i, (of, weights) in enumerate(shipped.value):
                    best[i] = best_of_block(block, of, weights, best[i], k)
        if kind is not None:
            rows = [(i, doc, score) for i, found in enumerate(best) for score, doc in found]
            query, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(query, pa.int32()), pa.array(doc, kind), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "id", "score"])

    kind = stored.schema["id"].dataType.simpleString()
    return stored.mapInArrow(run, f"query int, id {kind}, score bigint")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """item id, ``rank`` from 1, document id and ``score``: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("asked")).where("asked is not null")
    texts = asked.select("asked").distinct()
    chars = texts.agg(F.sum(F.length("asked"))).first()[0] or 0
    blocks = math.ceil(max(chars, 1) / ITEM_CHARS)
    ranked = []
    for part in range(blocks):
        # About ITEM_CHARS of texts come to the driver at a time.
        queries = Queries([row.asked for row in texts.where(F.pmod(F.xxhash64("asked"), F.lit(blocks)) == part).collect()])
        path = shared_folder(spark, "postings")
        postings(docs, queries.terms, id_col, text).write.parquet(path)
        stored = spark.read.parquet(path)
        best = best_documents(stored, queries, document_frequencies(stored, len(queries.terms)), k)
        named = spark.createDataFrame(list(enumerate(queries.texts)), "query int, asked string")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.append(top.join(named, "query").select("asked", "rank", "id", "score"))
    together = ranked[0]
    for more in ranked[1:]:
        together = together.union(more)
    return asked.join(together, "asked").select(
        F.col("item").alias(item_id), "rank", F.col("id").alias(id_col), "score"
    )
