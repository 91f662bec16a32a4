"""Whitening of embeddings by the covariance of their distinct quantised vectors.

Rows with equal quantised vectors x are one vector with a multiplicity. The fit counts each once, or as often as it occurs: weights of a
first pass that gives exact sums, and of a second that multiplies what is centred about them, one matrix product a batch. Only the sums and
the covariance, whose size is set by the dimensions, reach the driver, which takes its eigenvectors. Each distinct vector is whitened
once, and rows get their result back by a join on x. A vector shared by a third of all rows is one row of the first aggregate after its partial
counts, and in the join it is on the side that is split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalmart.llm.texts import column, table_of
from arrivalmart.llm.vectors import finite_rows, matrix_of, rows_of, stripped

SCALE = 256
COMPONENTS = 4
ONE, COPIES = "one", "copies"  # weights of the fit
ROWS = 4096  # rows of a matrix product
LONG = np.iinfo(np.int64)


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) in 64 bits; what they can't hold becomes their least or greatest number."""
    with np.errstate(over="ignore"):
        found = np.floor(values.astype(np.float64) * scale)
    inside = (found >= -(2.0**63)) & (found < 2.0**63)
    return np.where(inside, np.where(inside, found, 0).astype(np.int64), np.where(found < 0, LONG.min, LONG.max))


def packed(row: np.ndarray) -> bytes:
    """A vector of whole numbers as bytes of the least width that holds all of them, the width first, without zeros at the end."""
    size = max(-int(row.min()) - 1, int(row.max())) if len(row) else 0
    width = next(w for w in (1, 2, 4, 8) if size < 1 << (8 * w - 1))
    return bytes([width]) + stripped(row.astype(f"<i{width}"))


def unpacked(keys: list[bytes], dims: int) -> np.ndarray:
    """Packed vectors as rows of 64-bit numbers."""
    widths = np.array([k[0] for k in keys])
    found = np.zeros((len(keys), dims), dtype=np.int64)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        found[rows] = matrix_of([keys[r][1:] for r in rows.tolist()], f"<i{width}", dims)
    return found


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, x, dims): the packed quantised vector of every row that has one, and how many dimensions it was given with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = rows_of(column(batch, "v"))
            whole = whole_numbers(values, scale)
            keys = [packed(whole[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(keys, pa.binary()), pa.array(np.diff(offsets))], ["id", "x", "dims"])

    rows = finite_rows(df, id_col, vector_col)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x binary, dims long")


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(x, copies, dims): each distinct vector and how many rows have it."""
    return rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"), F.max("dims").alias("dims"))


def _batches(batches: Iterator[pa.RecordBatch], dims: int, weights: str) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Vectors as matrices of at most ROWS rows, with their weights."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            copies = column(part, "copies").to_numpy()
            yield unpacked(column(part, "x").to_pylist(), dims), copies if weights == COPIES else np.ones(len(copies), dtype=np.int64), part


def _exact_sums(x: np.ndarray, weight: np.ndarray) -> list[int]:
    """Weighted sums of columns, as whole numbers of any size."""
    if float(np.abs(x.astype(float)).max(initial=0)) * float(weight.sum()) < 2.0**62:
        return (weight @ x).tolist()
    return [sum(int(a) * int(w) for a, w in zip(own, weight, strict=True)) for own in x.T]


def _sums(distinct: DataFrame, dims: int, weights: str) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for x, weight, _ in _batches(batches, dims, weights):
            total = [a + b for a, b in zip(total, _exact_sums(x, weight), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int64()), pa.array(list(map(Decimal, total)), pa.decimal128(38, 0))], ["dim", "total"])

    found = distinct.select("x", "copies").mapInArrow(run, "dim long, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    by_dim = {row.dim: int(row.total) for row in found.collect()}
    return [by_dim.get(k, 0) for k in range(dims)]


def _products(distinct: DataFrame, mean: np.ndarray, weights: str) -> np.ndarray:
    """The weighted sum of products of centred dimensions; tasks send its upper half."""
    dims = len(mean)
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for x, weight, _ in _batches(batches, dims, weights):
            centred = (x - mean) * np.sqrt(weight)[:, None]
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["place", "total"])

    found = distinct.select("x", "copies").mapInArrow(run, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).toArrow()
    whole = np.zeros(len(upper[0]))
    whole[found["place"].to_numpy()] = found["total"].to_numpy()
    total = np.zeros((dims, dims))
    total[upper] = whole
    return total + np.triu(total, 1).T


@dataclass(frozen=True)
class Fit:
    """The mean and the leading components of a table's distinct vectors."""

    n: int
    sums: tuple[int, ...]
    mean: np.ndarray
    axes: np.ndarray  # components x dimensions
    variances: np.ndarray
    trace: float

    @property
    def varied(self) -> np.ndarray:
        """Which components have a variance beyond rounding; others can't be whitened."""
        return self.variances > len(self.mean) * np.finfo(float).eps * max(self.trace, 0.0)

    @property
    def explained(self) -> list[float | None]:
        return [float(e / self.trace) if ok else 0.0 for e, ok in zip(self.variances, self.varied, strict=True)] if self.trace > 0 else [None] * len(self.variances)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows x components; NaN for a component without variance."""
        scale = np.where(self.varied, np.sqrt(np.where(self.varied, self.variances, 1)), np.nan)
        return (x - self.mean) @ self.axes.T / scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact sum over dimensions of (n * x - S) squared, of every row."""
        sums = np.array(self.sums, dtype=object)
        far = self.n * int(np.abs(x.astype(object)).max(initial=0)) + max(map(abs, self.sums), default=0)
        if far * far * max(1, x.shape[1]) < 1 << 62:
            own = self.n * x - sums.astype(np.int64)
            return (own * own).sum(axis=1).tolist()
        return [int(sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums, strict=True))) for row in x.tolist()]


def fit(distinct: DataFrame, components: int = COMPONENTS, weights: str = ONE) -> Fit | None:
    """The fit over written rows (x, copies, dims), each counted once or with its copies; None without rows."""
    size = F.sum("copies") if weights == COPIES else F.count(F.lit(1))
    n, dims = distinct.agg(size, F.max("dims")).first()
    if not n:
        return None
    sums = _sums(distinct, dims, weights)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    covariance = _products(distinct, mean, weights) / n
    values, vectors = np.linalg.eigh(covariance)
    axes = vectors[:, ::-1][:, :components].T
    # Of either direction the one in which the largest entry is positive.
    signs = [1.0 if not dims or row[np.argmax(np.abs(row))] >= 0 else -1.0 for row in axes]
    return Fit(n, tuple(sums), mean, axes * np.array(signs)[:, None], values[::-1][:components].copy(), float(np.trace(covariance)))


def whiten_distinct(distinct: DataFrame, fitted: Fit) -> DataFrame:
    """(x, copies, whitened, deviation) of every distinct vector. A component without variance is null, and so is a deviation above 38 digits."""
    dims, largest = len(fitted.mean), 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _, part in _batches(batches, dims, ONE):
            flat = fitted.whitened(x).ravel()
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(fitted.axes)
            whitened = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, mask=np.isnan(flat)))
            deviations = [Decimal(d) if d < largest else None for d in fitted.deviations(x)]
            yield pa.RecordBatch.from_arrays(
                [column(part, "x"), column(part, "copies"), whitened, pa.array(deviations, pa.decimal128(38, 0))], ["x", "copies", "whitened", "deviation"]
            )

    return distinct.select("x", "copies").mapInArrow(run, "x binary, copies long, whitened array<double>, deviation decimal(38,0)")


def identity_error(whitened: DataFrame, fitted: Fit, weights: str = ONE) -> float | None:
    """The largest entry of the covariance of what was whitened, less the identity, over the components that have variance."""
    own = np.flatnonzero(fitted.varied).tolist()
    if not own:
        return None
    weight = F.col("copies") if weights == COPIES else F.lit(1)

    def mean_of(value: Column) -> Column:
        return F.sum(weight * value) / F.lit(fitted.n)

    def part(k: int) -> Column:
        return F.col("whitened")[k]

    means = whitened.agg(*[mean_of(part(k)).alias(f"m{k}") for k in own]).first()
    entries = {(i, j): mean_of((part(i) - F.lit(means[f"m{i}"])) * (part(j) - F.lit(means[f"m{j}"]))) for i in own for j in own if i <= j}
    found = whitened.agg(*[e.alias(f"c{i}_{j}") for (i, j), e in entries.items()]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in entries)


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, weights: str = ONE, scale: int = SCALE
) -> DataFrame:
    """A row for each row with a whole vector and each component, from 1: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, or hold null or a number that isn't finite, are left out. A vector shorter than others counts as zero in the dimensions it
    lacks, an empty one in all. Quantised numbers beyond 64 bits become the least or greatest of these. Null ids and repeated rows are kept; no rows
    give none, and fewer dimensions than components give a component for each dimension. A component without variance explains
    nothing, and its whitened value is null; if there is no variance at all, explained and identity_error are null.
    """
    rows = quantised(df, id_col, vector_col, scale)
    distinct = table_of(distinct_vectors(rows), "whitening-distinct")
    fitted = fit(distinct, components, weights)
    kind = f"`{id_col}` {rows.schema['id'].dataType.simpleString()}"
    if fitted is None:
        return df.sparkSession.createDataFrame([], f"{kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    known = table_of(whiten_distinct(distinct, fitted), "whitening-distinct-whitened")
    error = identity_error(known, fitted, weights)
    shares = F.array(*[F.lit(e).cast("double") for e in fitted.explained])
    joined = rows.select("id", "x").join(known.select("x", "whitened", "deviation"), "x")
    return joined.select(F.col("id").alias(id_col), "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        id_col,
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
