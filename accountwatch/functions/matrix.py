"""Distances between Arrow columns of vectors as matrix products."""

from __future__ import annotations

from collections.abc import Callable


def search_kernel(k: int) -> Callable:
    """Build the per-batch function. Nested, so that it travels to the tasks by value."""

    def matrix(vectors, dim):
        """Vectors of the right length as a matrix, with the row numbers they came from."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), dim), False)
        rows = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
        flat = vectors.filter(fits).flatten().to_numpy(zero_copy_only=False)
        values = flat.astype("float64").reshape(len(rows), dim)
        norms = np.sqrt((values * values).sum(axis=1))
        usable = np.isfinite(norms) & (norms > 0)
        return rows[usable], values[usable] / norms[usable, None]

    def nearest(queries, ids, policies):
        """Row numbers, policy ids, distances and ranks of the k best, ids breaking ties."""
        import numpy as np

        out = ([], [], [], [])
        rows, values = queries
        k_here = min(k, len(ids))
        step = max(1, (4 << 20) // max(1, len(ids)))
        for start in range(0, len(rows) if k_here else 0, step):
            # Rounded, so that equal vectors tie whatever the order of additions; a negative zero becomes zero.
            distance = np.round(1.0 - values[start : start + step] @ policies.T, 12) + 0.0
            if k_here == 1:
                best = distance.argmin(axis=1)[:, None]
            else:
                best = np.argsort(distance, axis=1, kind="stable")[:, :k_here]
            n = len(best)
            out[0].append(np.repeat(rows[start : start + step], k_here))
            out[1].append(ids[best].ravel())
            out[2].append(np.take_along_axis(distance, best, axis=1).ravel())
            out[3].append(np.tile(np.arange(1, k_here + 1, dtype="int32"), n))
        empty = (np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0), np.empty(0, "int32"))
        return tuple(np.concatenate(part) if part else none for part, none in zip(out, empty))

    return matrix, nearest
