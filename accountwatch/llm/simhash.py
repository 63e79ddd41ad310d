"""Near duplicates by SimHash, found through deletion-variant signatures.

Two fingerprints of 64 bits that differ in at most three are cut into two segments of
32 bits: one segment then differs in at most one bit. Each segment is indexed once as
it is and once for each bit left out, so that an equality of keys finds it; the whole
fingerprints are then compared. A bucket yields the edges of a spanning forest, never
its pairs, and buckets of a frequent segment are cut into slices that meet two by two.

Defined results: shingles are words of the A-Z-lowered text, joined by a space, with
repeats; a text of fewer words is one shingle; a text without words (null, empty,
blank) has fingerprint 0, linked like any other. Equal fingerprints are one class.
``component_id`` is the smallest id reachable; null ids are passed over and stay null
only in a component of null ids. An empty table gives an empty result. Columns other
than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwatch.llm.components import component_roots
from accountwatch.llm.text import unused, whole

SHINGLE = 3
MOST_BITS = 3
SEED = 42
HALF = 32
#: Bits of a key: a segment's, then its number and the place left out; above them stands a pair of slices.
KEY_BITS = 39
#: Fingerprints of a slice; a bucket's task compares two slices at most.
SLICE = 16_384
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PART = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(grams), _PART):
        part = grams[begin : begin + _PART]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in part), dtype="<u8", count=len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(grams), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a long, bit for bit."""

    @F.pandas_udf("bigint")
    def marked(texts):
        import pandas as pd

        prints = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(prints.view(np.int64))

    return docs.withColumn(out, marked(whole(text)))


def _variants(prints: DataFrame) -> DataFrame:
    """``key`` and fingerprint, 66 rows each: segment, place of the bit left out (32 for none), remaining bits."""
    fp = F.col("fp")
    keys = []
    for segment in (0, 1):
        bits = F.shiftrightunsigned(fp, HALF * segment).bitwiseAND(F.lit((1 << HALF) - 1))
        for place in range(HALF + 1):
            left = bits if place == HALF else bits.bitwiseAND(F.lit(((1 << HALF) - 1) & ~(1 << place)))
            keys.append(left.bitwiseOR(F.lit((segment * (HALF + 1) + place) << HALF)))
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def _forest(members: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.uint64]]:
    """Trees over the links between members: who hangs below which smallest member."""
    out = []
    rest = np.unique(members)
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        waiting = [root]
        while waiting and len(rest):
            near = np.bitwise_count(rest ^ waiting.pop()) <= bits
            if near.any():
                hit = rest[near]
                out.append((hit, root))
                waiting.extend(hit)
                rest = rest[~near]
    return out


def _bucket_links(bits: int):
    """Links within each run of rows with equal keys; rows come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys = np.zeros(0, dtype=np.int64)
        held_prints = np.zeros(0, dtype=np.uint64)

        def links(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch | None:
            starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            sizes = np.diff(starts, append=len(keys))
            lower, upper = [], []
            for begin, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                members = prints[begin : begin + size]
                segment, place = divmod((int(keys[begin]) & ((1 << KEY_BITS) - 1)) >> HALF, HALF + 1)
                if place < HALF:
                    # Members with the same bit there are equal in the segment and meet without a wildcard.
                    shift = np.uint64(place + HALF * segment)
                    side = (members >> shift) & np.uint64(1)
                    if side.min() == side.max():
                        continue
                for hit, root in _forest(members, bits):
                    lower.append(np.full(len(hit), root, dtype=np.uint64))
                    upper.append(hit)
            if not lower:
                return None
            a, b = np.concatenate(lower).view(np.int64), np.concatenate(upper).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([held_keys, batch.column(0).to_numpy(zero_copy_only=False)])
            prints = np.concatenate([held_prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            # The last key may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut and (found := links(keys[:cut], prints[:cut])):
                yield found
            held_keys, held_prints = keys[cut:], prints[cut:]
        if len(held_keys) and (found := links(held_keys, held_prints)):
            yield found

    return run


def _sliced(variants: DataFrame, most: int) -> DataFrame:
    """The variants with large buckets cut into slices: any two slices share a key of their own."""
    sizes = variants.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most)
    sizes = sizes.select("key", F.ceil(F.col("n") / (most // 2)).cast("bigint").alias("slices")).checkpoint()
    mine = F.pmod(F.xxhash64("fp"), F.col("slices"))
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1), lambda k: k != mine)
    met = F.transform(others, lambda k: F.least(k, mine) * F.col("slices") + F.greatest(k, mine))
    small = variants.join(sizes, "key", "left_anti").select("key", "fp")
    large = variants.join(sizes, "key").select("key", "fp", F.explode(met).alias("pair"))
    return small.union(large.select(F.col("key").bitwiseOR(F.shiftleft("pair", KEY_BITS)).alias("key"), "fp"))


def links_between(prints: DataFrame, bits: int = MOST_BITS, most: int = SLICE) -> DataFrame:
    """``a`` and ``b``: links of distinct fingerprints ``fp`` that connect what lies within ``bits`` bits."""
    if bits > 3:
        raise ValueError("two segments with one bit left out find at most three differing bits")
    variants = _variants(prints)
    # Only a frequent segment makes a large bucket, and segments are far fewer rows to count.
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))
    segments = prints.select(F.explode(F.array(low, F.shiftrightunsigned("fp", HALF).bitwiseOR(F.lit(1 << HALF)))).alias("s"))
    crowded = not segments.groupBy("s").count().where(F.col("count") > most // 2).isEmpty()
    rows = _sliced(variants, most) if crowded else variants
    dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_bucket_links(bits), "a bigint, b bigint").distinct()


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = MOST_BITS, shingle: int = SHINGLE, slice_rows: int = SLICE, carry: tuple[str, ...] = ()
) -> DataFrame:
    """id, ``carry``, ``fp`` and ``component_id`` of every row. Texts are not shuffled."""
    rows = with_fingerprints(docs.select(id_col, *carry, F.col(text).alias("_text")), "_text", "fp", shingle)
    rows = rows.select(id_col, *carry, "fp").checkpoint()
    classes = rows.groupBy("fp").agg(F.min(id_col).alias("least")).checkpoint()
    roots = component_roots(links_between(classes.select("fp"), bits, slice_rows))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    table = rooted.select("fp", "root").join(least, "root").select("fp", "component_id").checkpoint()
    return rows.join(table, "fp").select(id_col, *carry, "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = MOST_BITS, shingle: int = SHINGLE) -> DataFrame:
    """The first row of every component: smallest id (null last), ties by place in the table.

    ``docs`` is read twice and must give the same rows in the same order, as a stored table does.
    """
    row = unused(docs, "row_number")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = near_duplicate_classes(numbered, id_col, text, bits, shingle, carry=(row,))
    first = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row))).alias("first")
    # Rows without an id have components too: the class root would do, but ids suffice where there are any.
    kept = rows.groupBy(F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp "), F.col("fp").cast("string")))).agg(first)
    kept = kept.select(F.col("first")[row].alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)
