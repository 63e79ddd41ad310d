"""Nearest policy text by exact cosine distance.

Distances are matrix products over Arrow batches: one row of numbers per
complaint, never one row per pair. A knowledge base whose vectors fit the size
bound is shipped to the tasks; a larger one is searched cell by cell
(``operators/cells.py``).
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwatch.functions.matrix import search_kernel
from accountwatch.functions.tiers import policy_or_default
from accountwatch.operators.cells import MATCH, search_cells
from accountwatch.operators.keep import keep_first

SHIPPED_BYTES = 64 << 20
BLOCK_BYTES = 64 << 20


def _shipped(complaints: DataFrame, table: pa.Table, vector: str, dim: int, k: int) -> DataFrame:
    """Complaints with the k best of ``table``, which every task gets; with the policies' texts if it holds them."""
    matrix, nearest = search_kernel(k)
    table = table.sort_by("sop_id")
    rows, policies = matrix(table["embedding"], dim)
    ids, texts = table["sop_id"].to_numpy()[rows], None
    if "content" in table.column_names:
        texts = pa.array(table["content"].take(pa.array(rows)).to_pylist(), pa.string())
    shipped = complaints.sparkSession.sparkContext.broadcast((ids, policies, texts))
    kept = [f for f in complaints.schema.fields if f.name != vector]
    names = [f.name for f in kept]
    added = [*MATCH.fields, T.StructField("policy", T.StringType())] if texts is not None else MATCH.fields
    out = [*names, *(f.name for f in added)]

    def search(batches):
        import numpy as np
        import pyarrow as pa

        ids, policies, texts = shipped.value
        for batch in batches:
            hit, place, distance, rank = nearest(matrix(batch.column(vector), dim), np.arange(len(ids)), policies)
            missed = np.setdiff1d(np.arange(batch.num_rows), hit)
            take = pa.array(np.concatenate([hit, missed]))
            gone = np.arange(len(hit) + len(missed)) >= len(hit)
            pad = np.zeros(len(missed))
            places = pa.array(np.concatenate([place, pad.astype("int64")]), mask=gone)
            columns = [batch.column(name).take(take) for name in names]
            columns += [
                pa.array(ids).take(places),
                pa.array(np.concatenate([distance, pad]), mask=gone),
                pa.array(np.concatenate([rank, pad.astype("int32") + np.int32(1)])),
            ]
            if texts is not None:
                columns.append(texts.take(places))
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return complaints.mapInArrow(search, T.StructType([*kept, *added]))


def _measured(kb: DataFrame) -> tuple[dict[int, tuple[int, int]], int, int]:
    """The six most frequent vector lengths with rows and first ``sop_id``, rows and bytes of text in all: one job."""
    figures = (
        kb.select("sop_id", "content", F.size("embedding").alias("dim"))
        .rollup("dim")
        .agg(
            F.grouping("dim").alias("whole"),
            F.count("*").alias("n"),
            F.min("sop_id").alias("first"),
            F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).alias("text_bytes"),
        )
        .orderBy(F.desc("whole"), F.col("dim").isNull(), F.desc("n"), "dim")
        .limit(7)
        .collect()
    )
    lengths = {r["dim"]: (r["n"], r["first"]) for r in figures if not r["whole"] and r["dim"] is not None and r["dim"] >= 0}
    total = next((r for r in figures if r["whole"]), None)
    return lengths, total["n"] if total else 0, total["text_bytes"] if total else 0


def _lengths(table: pa.Table) -> dict[int, tuple[int, int]]:
    """As ``_measured`` gives them, of a table that has been fetched."""
    sizes = table.select(["sop_id"]).append_column("dim", pc.list_value_length(table["embedding"]))
    found = sizes.group_by("dim").aggregate([("sop_id", "count"), ("sop_id", "min")])
    found = found.sort_by([("sop_id_count", "descending"), ("dim", "ascending")]).slice(0, 6).to_pylist()
    return {r["dim"]: (r["sop_id_count"], r["sop_id_min"]) for r in found}


def _dimension(lengths: dict[int, tuple[int, int]]) -> int:
    """The one length of the policies' vectors; names those that stand out."""
    if len(lengths) > 1:
        told = ", ".join(f"{n} of length {dim} (first sop_id {first})" for dim, (n, first) in lengths.items())
        raise ValueError(f"policy vectors differ in length: {told}; pass dim to search one length only")
    return max(*lengths, 1) if lengths else 1


def nearest_policy(
    complaints: DataFrame,
    kb: DataFrame,
    vector: str = "embedding",
    k: int = 1,
    dim: int | None = None,
    shipped_bytes: int = SHIPPED_BYTES,
    block_bytes: int = BLOCK_BYTES,
    report: Callable[[dict], None] | None = None,
) -> DataFrame:
    """Add sop_id, distance, rank and policy for the ``k`` nearest policies of each complaint.

    Every complaint stays, whatever its keys: without a usable vector, or with an empty
    knowledge base, it gets the default policy. A policy counts once however often it is
    stored; of rows with one ``sop_id`` the first by content stays, one with a vector
    before others. Policies without an id or a vector are not searched. All their vectors
    have one length, or ``dim`` says which length is searched. Both forms, for a small
    and a large knowledge base, give the same rows. ``report`` gets the large form's
    numbers: blocks, complaints, blocks searched and the share skipped.
    """
    known = kb.filter(F.col("sop_id").isNotNull()).select("sop_id", "content", "embedding")
    kb = keep_first(known, ["sop_id"], [F.col("embedding").isNull().asc(), F.asc("content"), F.asc("embedding")])
    stored = known.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("content")).alias("text_bytes"), F.sum(F.size("embedding")).alias("numbers")
    ).first()
    if 8 * stored["n"] + (stored["text_bytes"] or 0) + 8 * max(stored["numbers"] or 0, 0) <= shipped_bytes:
        # Doubled rows included, the whole knowledge base fits: it is fetched once, texts and all.
        table = kb.filter(F.col("embedding").isNotNull()).toArrow()
        ranked = _shipped(complaints, table, vector, _dimension(_lengths(table)) if dim is None else dim, k)
        return ranked.withColumn("policy", policy_or_default("policy"))
    lengths, rows, text_bytes = _measured(kb)
    if dim is None:
        dim = _dimension(lengths)
    vectors = kb.filter(F.size("embedding") == dim)
    # A length beyond the six most frequent ones is taken to be that of all rows.
    kb_bytes = (lengths[dim][0] if dim in lengths else rows if len(lengths) > 5 else 0) * dim * 8
    if kb_bytes <= shipped_bytes:
        ranked = _shipped(complaints, vectors.select("sop_id", "embedding").toArrow(), vector, dim, k)
    else:
        ranked = search_cells(complaints, vectors, vector, dim, k, block_bytes, report)
    policies = kb.select("sop_id", F.col("content").alias("policy"))
    if kb_bytes + text_bytes <= shipped_bytes:
        policies = F.broadcast(policies)
    return ranked.join(policies, "sop_id", "left").withColumn("policy", policy_or_default("policy"))
