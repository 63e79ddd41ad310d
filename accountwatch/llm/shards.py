"""Shards by jump consistent hashing: no ring table, and growth moves only what it must.

A key walks a sequence of jumps drawn from a generator seeded with the key's hash. Its
shard among n is the last jump below n, so one walk up to the larger count gives the
shard for both counts, and a new shard only ever takes rows into itself.

Defined results: a null key has a hash of its own and is placed like any other; equal keys share a shard;
a null text has no bytes and the checksum of the empty text; repeated rows take slots
of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwatch.llm.text import unused

# Fixed values of the published generator: multiplier and the span of its draws.
MULTIPLIER = Decimal(2862933555777941757)
SPAN = float(1 << 31)
WORD = Decimal(1 << 64)

#: Slots are numbered in pieces of about so many rows, each a unit of sorting.
ROWS_PER_PIECE = 50_000
#: At least so many pieces a shard, so that pieces outnumber the tasks of a small cluster.
LEAST_PIECES = 32


def stable_key(key: str) -> Column:
    """A hash of the key as text, as an unsigned 64-bit decimal. A null is a key too."""
    signed = F.xxhash64(F.col(key).cast("string"), F.col(key).isNull())
    wide = signed.cast("decimal(20,0)")
    return F.when(signed < 0, wide + F.lit(WORD)).otherwise(wide).cast("decimal(20,0)")


def jumps(key: Column, most: int) -> Column:
    """The jumps of a key below ``most``, in rising order; the first is 0."""
    seed = F.struct(
        key.alias("state"),
        F.lit(0).cast("bigint").alias("next"),
        F.array().cast("array<bigint>").alias("seen"),
    )

    def step(acc: Column, _: Column) -> Column:
        drawn = (acc["state"] * F.lit(MULTIPLIER) + F.lit(1)) % F.lit(WORD)
        state = drawn.cast("decimal(20,0)")
        high = F.floor(state / F.lit(Decimal(1 << 33))).cast("double")
        following = F.floor((acc["next"] + 1).cast("double") * (F.lit(SPAN) / (high + 1.0))).cast("bigint")
        walked = F.struct(
            state.alias("state"), following.alias("next"), F.concat(acc["seen"], F.array(acc["next"])).alias("seen")
        )
        return F.when(acc["next"] >= most, acc).otherwise(walked)

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), seed, step, lambda acc: acc["seen"])


def shard_of(seen: Column, count: int) -> Column:
    return F.array_max(F.filter(seen, lambda x: x < count)).cast("int")


def assign_shards(
    docs: DataFrame,
    shards: int,
    grown: int,
    key: str = "doc_id",
    text: str = "text",
    overhead: int = 8,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """key, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard``, the shard among ``grown``.

    A result's name that the key already has gets underscores. Slots are gapless within a shard. They come from a rank within a piece of a shard
    plus the rows of the pieces before it, so no task sorts a whole shard.
    """
    given, key = docs.select(key), "_key"
    docs = docs.select(F.col(given.columns[0]).alias(key), F.col(text).alias("_text"))
    body = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + overhead).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jumps(stable_key(key), grown).alias("_seen"),
        F.xxhash64(F.col(key).cast("string"), body, F.monotonically_increasing_id()).alias("_tie"),
    )
    rows = rows.select(
        key, "size", "text_crc32", "_tie", shard_of(F.col("_seen"), shards).alias("shard"), shard_of(F.col("_seen"), grown).alias("grown_shard")
    )
    # Rows of one key spread over the pieces too: a repeated key can hold many of them.
    rows = rows.checkpoint()
    pieces = max(LEAST_PIECES, rows.count() // (shards * rows_per_piece))
    rows = rows.withColumn("_piece", F.pmod(F.col("_tie"), F.lit(pieces)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "_piece")
        .agg(F.count("*").alias("_rows"))
        .select("shard", "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("shard", "_piece").orderBy("_tie", key, "size", "text_crc32")
    placed = (
        rows.withColumn("_rank", F.row_number().over(within) - 1)
        .join(starts, ["shard", "_piece"])
        .select(key, "size", "text_crc32", "shard", (F.col("_start") + F.col("_rank")).alias("slot"), "grown_shard")
    )
    return placed.toDF(*given.columns, *(unused(given, name) for name in placed.columns[1:]))
