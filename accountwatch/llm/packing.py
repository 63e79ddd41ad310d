"""Packing by Karmarkar-Karp multiway differencing.

A document's ids, with the end id, are cut where windows are full; what is left over is
an item. The items of a batch are partitioned into windows: the two partial partitions
with the largest imbalance are merged in opposite order, largest part onto smallest,
until one is left, which makes the windows near-equal. If some window then exceeds the
capacity, the batch is partitioned anew into one window more.

So that near-equal is nearly full, a share of the left-overs is cut into small items
that even out the others. Which, is drawn from a hash, alike at every size.

Defined results: a null or empty text is the end id alone; repeated rows are packed one
by one; null and repeated ids are packed like any other. An empty table gives an empty
result. A batch holds a bounded number of ids, so no task grows with the input.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwatch.llm.chunks import slices
from accountwatch.llm.text import unused, whole

CAPACITY = 1024
END = 0
#: One left-over in so many is cut into items of at most FINE ids.
FINE_SHARE = 3
FINE = 96
#: Ids of the items of a batch, on average: a few hundred windows.
BATCH_IDS = 192 * CAPACITY


def partition(sizes: list[int], k: int) -> np.ndarray:
    """The part, from 0 to k-1, of each size, parts near-equal in sum."""
    queue = []
    trees: list[tuple] = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, dtype=np.int64)
        sums[0] = size
        trees.append((i,))
        queue.append((-size, i, sums))
    heapify(queue)
    while len(queue) > 1:
        _, a, high = heappop(queue)
        _, b, low = heappop(queue)
        merged = high + low[::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        # Only differences count: what all parts have in common is left out.
        merged -= merged[-1]
        trees.append((a, b, order))
        heappush(queue, (-int(merged[0]), len(trees) - 1, merged))
    out = np.zeros(len(sizes), dtype=np.int64)
    stack = [(queue[0][1], np.arange(k))] if queue else []
    while stack:
        at, parts = stack.pop()
        if len(trees[at]) == 1:
            out[trees[at][0]] = parts[0]
            continue
        a, b, order = trees[at]
        mine = np.empty(k, dtype=np.int64)
        mine[order] = parts
        stack += [(a, mine), (b, mine[::-1])]
    return out


def windows(sizes: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """The window of each size, none over the capacity; as few windows as differencing reaches."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = partition(sizes, k)
        if np.bincount(parts, weights=sizes, minlength=k).max(initial=0) <= capacity:
            return parts
        k += 1


def cut(total: int, fine: bool, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full windows, then the left-over."""
    full = total // capacity * capacity
    step = FINE if fine else capacity
    return [(at, capacity) for at in range(0, full, capacity)] + [(at, min(step, total - at)) for at in range(full, total, step)]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of the vocabulary stands for: its own if it prints, else the next one that does not."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(path: str) -> dict[bytes, int]:
    """Bytes and id of every token of a byte-level BPE file whose ids follow the order of its merges.

    Then merging the pair of the lowest id is merging by the file's order: within the
    span of a token, nothing outside has a say as long as no merge crosses its edges.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary = model["vocab"]
    pairs = (merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"])
    made = [vocabulary["".join(pair)] for pair in pairs]
    if any(a >= b for a, b in zip(made, made[1:], strict=False)) or len(vocabulary) - len(made) != 256:
        raise ValueError(f"{path}: ids do not follow the order of merges over 256 bytes")
    alphabet = byte_alphabet()
    return {bytes(map(alphabet.__getitem__, token)): rank for token, rank in vocabulary.items()}


def added_tokens(path: str) -> dict[str, int]:
    """The file's added tokens, which are cut out of a text before it is encoded."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if any(token.get(flag) for token in added for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError(f"{path}: an added token takes more than its own characters")
    return {token["content"]: token["id"] for token in added}


@lru_cache(maxsize=2)
def worker_encoder(path: str, pattern: str) -> Callable[[str], bytes]:
    """Encodes a whole text as the file's own tokenizer does, with no token that the text does not hold."""
    import tiktoken

    added, ranks = added_tokens(path), merge_ranks(path)
    special = {token: rank for token, rank in added.items() if token.encode() not in ranks or ranks[token.encode()] != rank}
    ranks = {token: rank for token, rank in ranks.items() if rank not in special.values()}
    encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: np.array(encoding.encode(text, allowed_special="all"), dtype="<u4").tobytes()


def pieces(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` of every piece. One pass, no shuffle."""
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, stop in slices(texts):
                rows: list[tuple[int, int, int, int, int]] = []
                for at in range(begin, stop):
                    ids = encode(texts[at]) + end
                    total = len(ids) // 4
                    fine = zlib.crc32(ids) % FINE_SHARE == 0
                    rows += [(at, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), total) for s, n in cut(total, fine)]
                at, *numbers = (list(column) for column in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), *(pa.array(column, pa.int64()) for column in numbers)],
                    names=[id_col, "start", "length", "ids_crc32", "doc_tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return docs.select(id_col, whole(text).alias("_text")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", batch_ids: int = BATCH_IDS) -> DataFrame:
    """The pieces with ``sequence_id`` and their ``offset`` in the sequence, gapless from 0.

    A result's name that the id already has gets underscores.
    """
    given, id_col = docs.select(id_col), "_id"
    docs = docs.select(F.col(given.columns[0]).alias(id_col), F.col(text).alias("_text"))
    cut_up = pieces(docs, path, pattern, id_col, "_text").withColumn("_piece", F.monotonically_increasing_id()).checkpoint()
    full = cut_up.where(F.col("length") == CAPACITY).select(
        id_col, "start", "length", "ids_crc32", "doc_tokens", (F.col("_piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    items = cut_up.where(F.col("length") < CAPACITY)
    # Batches are drawn by piece, so a document or an id of any weight spreads over all of them.
    batches = max(1, round((items.agg(F.sum("length")).first()[0] or 0) / batch_ids))

    def run(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("_piece")
        lengths = batch.column("length").to_numpy()
        window = windows(lengths.tolist())
        order = np.argsort(window, kind="stable")
        sorted_lengths, sorted_window = lengths[order], window[order]
        before = np.cumsum(sorted_lengths) - sorted_lengths
        firsts = np.flatnonzero(np.diff(sorted_window, prepend=-1))
        offset = before - np.repeat(before[firsts], np.diff(firsts, append=len(order)))
        sequence = (batch.column("_batch").to_numpy()[order] << 20 | sorted_window) * 2
        columns = [batch.column(name).take(pa.array(order)) for name in (id_col, "start", "length", "ids_crc32", "doc_tokens")]
        return pa.Table.from_arrays(
            [*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
            names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    drawn = F.pmod(F.xxhash64("_piece"), F.lit(batches)).cast("bigint")
    packed = items.withColumn("_batch", drawn).groupBy("_batch").applyInArrow(run, full.schema)
    return full.union(packed).toDF(*given.columns, *(unused(given, name) for name in full.columns[1:]))
