"""Small helpers over columns of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the rows whose vector is not null and holds neither null nor a number that isn't finite, as doubles."""

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("v").isNotNull() & F.forall("v", finite))


def rows_of(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of vectors, and where each vector begins among them, with the end."""
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    return vectors.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def stripped(row: np.ndarray) -> bytes:
    """A vector as bytes, without the zeros at its end, so that a shorter one equals itself with zeros for what it lacks."""
    if len(row) and not row[-1]:
        own = np.flatnonzero(row)
        row = row[: own[-1] + 1 if len(own) else 0]
    return row.tobytes()


def matrix_of(packed: list[bytes], kind: str, dims: int) -> np.ndarray:
    """Packed vectors as rows of a matrix, zeros at their end."""
    size = dims * np.dtype(kind).itemsize
    if all(len(p) == size for p in packed):
        return np.frombuffer(b"".join(packed), dtype=kind).reshape(len(packed), dims)
    found = np.zeros((len(packed), dims), dtype=kind)
    for k, p in enumerate(packed):
        own = np.frombuffer(p, dtype=kind)
        found[k, : len(own)] = own
    return found
