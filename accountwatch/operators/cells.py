"""Exact nearest policies in a knowledge base too large to ship, with cells that need no search left out.

Some policies are pivots; each policy belongs to the cell of its nearest pivot, and a
cell knows its radius. On unit vectors cosine distance is half the squared Euclidean
one, for which the triangle inequality holds: nothing in a cell is nearer to a
complaint than the pivot's distance less the radius. A complaint first searches one
block of its own cell; the k-th distance found there bounds what it still needs, and
it is sent on only to blocks that this bound cannot rule out. A large cell is several
blocks, a crowded block is met by slices of the complaints, so a task holds one block
and one slice whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwatch.functions.matrix import search_kernel
from accountwatch.operators.keep import keep_first
from accountwatch.session import shared_folder

#: Pivots are sent to all tasks: at most so many, and so many bytes.
PIVOTS = 1024
PIVOT_BYTES = 16 << 20
#: Pivots per block of policies; smaller cells can be ruled out more often.
CELLS_PER_BLOCK = 4

#: Added to what rounding may take from a Euclidean distance near zero, and from a rounded cosine distance.
LENGTH_SLACK = 1e-6
DISTANCE_SLACK = 1e-11

MATCH = T.StructType(
    [
        T.StructField("sop_id", T.LongType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]
)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _usable(vectors: DataFrame) -> DataFrame:
    norm = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return vectors.filter((norm > 0) & (norm < float("inf")))


def _pivots(vectors: DataFrame, dim: int, block_rows: int):
    """Unit vectors of the first policies by a hash of their id, as many as the bounds allow."""
    matrix, _ = search_kernel(1)
    wanted = CELLS_PER_BLOCK * -(-vectors.count() // block_rows)
    most = max(1, min(PIVOTS, PIVOT_BYTES // (dim * 8), wanted))
    first = vectors.orderBy(F.xxhash64("sop_id"), "sop_id").limit(most).select("embedding").toArrow()
    return matrix(first["embedding"], dim)[1]


def _gaps(matrix: Callable, pivots) -> Callable:
    """Build the function that gives row numbers and Euclidean distances to all pivots, some rows at a time."""

    def gaps(vectors, dim):
        import numpy as np

        rows, values = matrix(vectors, dim)
        step = max(1, (2 << 20) // max(1, len(pivots.value)))
        for start in range(0, len(rows), step):
            dots = values[start : start + step] @ pivots.value.T
            yield rows[start : start + step], np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))

    return gaps


def _assigned(rows: DataFrame, key: str, vector: str, gaps: Callable, dim: int) -> DataFrame:
    """``key``, the vector, its nearest pivot ``cell`` and the distance to it; unusable vectors are left out."""

    def assign(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at, gap in gaps(batch.column(1), dim):
                cell = gap.argmin(axis=1)
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(cell.astype("int32")),
                        pa.array(gap[np.arange(len(at)), cell]),
                    ],
                    names=[key, vector, "cell", "gap"],
                )

    kept = rows.select(key, vector)
    return kept.mapInArrow(assign, T.StructType([*kept.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("gap", T.DoubleType())]))


def _met(asked: DataFrame, known: DataFrame, vector: str, dim: int, k: int, block_rows: int) -> DataFrame:
    """The k best of its block for each row of ``asked``, which names a cell and a block of it."""
    matrix, nearest = search_kernel(k)
    block = ["cell", "block"]
    crowd = asked.groupBy(*block).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("slices"))
    left = asked.join(crowd, block).select("__row", vector, *block, F.pmod(F.xxhash64("__row"), F.col("slices")).cast("int").alias("slice"))
    right = known.join(crowd, block).select("sop_id", "embedding", *block, F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))

    def search(asked, known):
        import pyarrow as pa

        known = known.sort_by("sop_id")
        rows, policies = matrix(known["embedding"], dim)
        hit, sop, distance, _ = nearest(matrix(asked[vector], dim), known["sop_id"].to_numpy()[rows], policies)
        return pa.table(
            {"__row": asked["__row"].combine_chunks().take(pa.array(hit)), "sop_id": pa.array(sop), "distance": pa.array(distance)}
        )

    task = [*block, "slice"]
    return left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(search, "__row long, sop_id long, distance double")


def _visits(asked: DataFrame, vector: str, gaps: Callable, dim: int, k: int, cells) -> DataFrame:
    """Row, vector, cell and block of every block that the bound ``kth`` does not rule out, the first one left out."""

    def needed(batches):
        import numpy as np
        import pyarrow as pa

        count, radius, blocks = cells.value
        for batch in batches:
            own = batch.column(2).to_numpy()
            kth = batch.column(3).fill_null(float("inf")).to_numpy()
            for at, gap in gaps(batch.column(1), dim):
                # All of a cell lies within gap + radius: the first cells with k policies bound the k-th too.
                order = np.argsort(gap + radius, axis=1, kind="stable")
                enough = np.cumsum(count[order], axis=1) >= k
                farthest = np.take_along_axis(gap + radius, order, axis=1)[np.arange(len(at)), enough.argmax(axis=1)]
                bound = np.where(enough.any(axis=1), (farthest + LENGTH_SLACK) ** 2 / 2, np.inf)
                bound = np.minimum(bound, kth[at]) + DISTANCE_SLACK
                least = np.maximum(0.0, gap - radius - LENGTH_SLACK) ** 2 / 2
                row, cell = np.nonzero((least <= bound[:, None]) & (count > 0))
                for start in range(0, len(row), 4096):
                    r, c = row[start : start + 4096], cell[start : start + 4096]
                    many = blocks[c]
                    r, c = np.repeat(r, many), np.repeat(c, many)
                    b = np.arange(len(r)) - np.repeat(np.cumsum(many) - many, many)
                    new = (b > 0) | (c != own[at[r]])
                    take = pa.array(at[r[new]])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take), batch.column(1).take(take), pa.array(c[new].astype("int32")), pa.array(b[new].astype("int32"))],
                        names=["__row", vector, "cell", "block"],
                    )

    kept = asked.select("__row", vector, "cell", "kth")
    fields = [kept.schema["__row"], kept.schema[vector], T.StructField("cell", T.IntegerType()), T.StructField("block", T.IntegerType())]
    return kept.mapInArrow(needed, T.StructType(fields))


def search_cells(
    complaints: DataFrame,
    vectors: DataFrame,
    vector: str,
    dim: int,
    k: int,
    block_bytes: int,
    report: Callable[[dict], None] | None = None,
) -> DataFrame:
    """``complaints`` without their vector, with ``sop_id``, ``distance`` and ``rank`` of the k nearest.

    Complaints are stored once with a row number, which names them whatever their own
    keys are. Nothing but pivots and one row per cell comes to the driver.
    """
    import numpy as np

    spark = complaints.sparkSession
    root = shared_folder(spark, "nearest")
    block_rows = max(1, block_bytes // (dim * 8))
    numbered = _stored(complaints.withColumn("__row", F.monotonically_increasing_id()), f"{root}/complaints")
    plain = _usable(vectors.select("sop_id", "embedding"))
    found = _pivots(plain, dim, block_rows)
    if not len(found):
        nothing = F.lit(None)
        return numbered.drop(vector, "__row").select("*", nothing.cast("long").alias("sop_id"), nothing.cast("double").alias("distance"), F.lit(1).alias("rank"))
    pivots = spark.sparkContext.broadcast(found)
    gaps = _gaps(search_kernel(k)[0], pivots)

    known = _stored(_assigned(plain, "sop_id", "embedding", gaps, dim), f"{root}/policies")
    count, radius = np.zeros(len(found), "int64"), np.zeros(len(found))
    for cell in known.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect():
        count[cell["cell"]], radius[cell["cell"]] = cell["n"], cell["radius"]
    blocks = -(-count // block_rows)
    cells = spark.sparkContext.broadcast((count, radius, blocks))
    table = spark.createDataFrame([(i, int(n)) for i, n in enumerate(blocks)], "cell int, blocks int")
    known = known.join(F.broadcast(table), "cell").select(
        "sop_id", "embedding", "cell", F.pmod(F.xxhash64("sop_id"), F.col("blocks")).cast("int").alias("block")
    )

    asked = _stored(_assigned(numbered, "__row", vector, gaps, dim), f"{root}/asked")
    first = _stored(_met(asked.withColumn("block", F.lit(0)), known, vector, dim, k, block_rows), f"{root}/first")
    bounds = first.groupBy("__row").agg(F.when(F.count("*") >= k, F.max("distance")).alias("kth"))
    further = _stored(_visits(asked.join(bounds, "__row", "left"), vector, gaps, dim, k, cells), f"{root}/further")
    if report:
        rows, all_blocks = asked.count(), int(blocks.sum())
        searched = rows + further.count()
        skipped = 1 - searched / (rows * all_blocks) if rows else 0.0
        report({"blocks": all_blocks, "complaints": rows, "searched": searched, "skipped_share": skipped})
    second = _met(further, known, vector, dim, k, block_rows)
    best = keep_first(first.union(second), ["__row"], [F.asc("distance"), F.asc("sop_id")], k, rank="rank")
    joined = numbered.drop(vector).join(best, "__row", "left").drop("__row")
    return joined.withColumn("rank", F.coalesce("rank", F.lit(1)))
