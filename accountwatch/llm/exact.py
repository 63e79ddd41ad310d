"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical without blanks ([\\x20\\x09-\\x0D]).
The first pass groups narrow rows by length and, within a length, by the hash of a
prefix. What survives is marked in a bitmap of a fixed size that every task gets, so
that only surviving rows are hashed in full and only they are shuffled. A bit shared
with another group costs a hash too many and never changes a result.

Defined results: a null text is empty, and empty texts equal each other. Among equal
texts the row with the most code points stays, then the smallest id (null last), then
the first row; of rows repeated in every column exactly one stays. An empty table
gives an empty result. Other columns are carried along or left out, never read. A result's name that
an id or carried column has already gets underscores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwatch.llm.text import BLANKS, unused, whole

#: Code points of the prefix that is hashed before the full content.
PREFIX = 64
#: Bits of the survivor bitmap: 1 MiB, whatever the size of the input.
FILTER_BITS = 1 << 23
#: What Spark's bitmap functions hold in one value.
PART_BITS = 1 << 15
#: Bits of a row's number below that of the task which read it.
ROW_BITS = 33
#: So many numbers of rows are sent to all tasks, a few MB.
SHIPPED_ROWS = 500_000


def normalised(text: str | Column) -> Column:
    """The text without blanks. Plain replacements are several times faster than a pattern."""
    return reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit("")), BLANKS, whole(text))


def full_hash(bare: Column) -> Column:
    """SHA-256 of a normalised text."""
    return F.sha2(bare.cast("binary"), 256)


def _slot(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(FILTER_BITS)).cast("long")


def mark_survivors(docs: DataFrame, bare: str, flag: str, prefix: int = PREFIX) -> DataFrame:
    """``docs`` with ``flag``: false only where no other row can equal the text in ``bare``."""
    length, start = F.length(bare), F.xxhash64(F.substring(bare, 1, prefix))
    by_prefix = docs.select(length.alias("n"), start.alias("p")).groupBy("n", "p").agg(F.count("*").alias("rows"))
    # A length held by one row has one prefix with one row, so one aggregate serves both levels.
    shared = by_prefix.where("rows > 1").select(_slot(F.col("n"), F.col("p")).alias("slot"))
    parts = shared.groupBy(F.floor(F.col("slot") / PART_BITS).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.col("slot") % PART_BITS).alias("bits")
    )
    # One value of FILTER_BITS at most: the bitmap parts by number, those without survivors left out.
    bitmap = parts.agg(F.map_from_entries(F.collect_list(F.struct("part", "bits"))).alias("bits"))
    filled = bitmap.select(
        F.transform(F.sequence(F.lit(0), F.lit(FILTER_BITS // PART_BITS - 1)), lambda k: F.try_element_at("bits", k)).alias("bits")
    ).scalar()
    slot = _slot(length, start)
    bits = F.get(filled, F.floor(slot / PART_BITS).cast("int"))
    at = (slot % PART_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return docs.withColumn(flag, F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False)))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One narrow row per row of ``docs``: id, ``carry``, ``keep_id``, ``group_size``, ``kept``.

    The texts themselves are not shuffled. A group is counted by the task that read its
    rows, then over tasks, and its rows take count and winner back by group and task: a
    text that a third of all rows share lies in as many places as tasks have read it.
    """
    plain = [id_col, *carry]
    chars, row, bare, maybe, full, task, best, size = (
        unused(docs, n) for n in ("chars", "row", "bare", "maybe_equal", "full_hash", "task", "best", "size")
    )
    rows = docs.select(
        *plain,
        F.length(whole(text)).alias(chars),
        F.monotonically_increasing_id().alias(row),
        normalised(text).alias(bare),
    )
    rows = mark_survivors(rows, bare, maybe)
    hashed = F.when(F.col(maybe), full_hash(F.col(bare))).alias(full)
    rows = rows.select(*plain, chars, row, F.shiftright(row, ROW_BITS).alias(task), hashed).checkpoint()
    order = F.struct((-F.col(chars)).alias("c"), F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col(row).alias("r"))
    # Rows without a full hash are alone; in the join their nulls would meet in one task.
    alone, survivors = rows.where(F.col(full).isNull()), rows.where(F.col(full).isNotNull())
    parts = survivors.groupBy(full, task).agg(F.min(order).alias(best), F.count("*").alias(size))
    groups = parts.groupBy(full).agg(F.min(best).alias(best), F.sum(size).alias(size)).where(F.col(size) > 1)
    found = parts.select(full, task).join(groups, full)
    winner = F.col(best)
    keep_id, group_size, kept = (unused(docs.select(*plain), n) for n in ("keep_id", "group_size", "kept"))
    return alone.select(
        *plain, F.col(id_col).alias(keep_id), F.lit(1).cast("bigint").alias(group_size), F.lit(True).alias(kept)
    ).union(
        survivors.join(found, [full, task], "left").select(
            *plain,
            F.when(winner.isNull(), F.col(id_col)).otherwise(winner["i"]).alias(keep_id),
            F.coalesce(size, F.lit(1)).alias(group_size),
            F.coalesce(winner["r"] == F.col(row), F.lit(True)).alias(kept),
        )
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shipped_rows: int = SHIPPED_ROWS
) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns and nothing else.

    Winners are found on narrow rows. Up to ``shipped_rows`` numbers of rows that go are
    sent to the tasks, which read the texts once more and shuffle none. Beyond that, rows
    that may have a copy meet these numbers in a join, spread evenly by row; the others
    pass without a shuffle. ``docs`` is read twice and must give the same rows in the
    same order, as a stored table does.
    """
    row, bare, flag = (unused(docs, n) for n in ("row_number", "bare", "maybe_equal"))
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    groups = exact_groups(numbered, id_col, text, carry=(row,))
    lost = groups.where(~F.col(groups.columns[-1])).select(row).checkpoint()
    if lost.count() <= shipped_rows:
        return numbered.join(F.broadcast(lost), row, "left_anti").select(*docs.columns)
    marked = mark_survivors(numbered.withColumn(bare, normalised(text)), bare, flag)
    shared = marked.where(flag).join(lost, row, "left_anti")
    return marked.where(~F.col(flag)).select(*docs.columns).union(shared.select(*docs.columns))
