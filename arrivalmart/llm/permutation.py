"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its distances from some pivots. Near vectors see the pivots in nearly the same order, and the
footrule, the sum of the differences between a pivot's positions in two orders, says how nearly. Every distinct vector is
posted in the inverted file of each pivot, with that pivot's position in its order. A query adds up the footrule from the files,
the nearest share of all vectors by footrule is compared with it exactly, and the best of these are its neighbours.

Largest inner product is made smallest distance by one more dimension, sqrt(longest^2 - |v|^2) for indexed vectors and 0 for queries.
Equal vectors are one entry with their smallest ids, as many as can be among the neighbours, so a vector that a third of all
rows share is no longer list than any other. The index is cut into blocks by a hash of the vector, and each block is built once for every lane of
queries that streams past it.

The pivots, and the share of vectors that are compared exactly, are fitted on a bounded sample of distinct vectors: the share is what
finds COVER of the sample's own neighbours. A sample's neighbours are further apart than a whole table's, so the share errs on the side of recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivalmart.llm.texts import column, table_of
from arrivalmart.llm.vectors import finite_rows, matrix_of, rows_of, stripped

TOP = 20
PIVOTS = 128
FITTED = 4_096  # distinct vectors that the index is fitted on, at most
TRIED = 256  # of these, queries that the share is measured with
COVER = 0.98
LEAST = 10  # times the neighbours wanted are compared exactly in a block, at least
ROWS = 8_192  # distinct vectors of a block, about
QUERIES = 65_536  # queries of a lane, about
VECTOR = "<f8"


def packed_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): each vector that takes part, as bytes without zeros at the end. Null, zero and empty vectors, and those with null or a number that isn't finite, don't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = rows_of(column(batch, "v"))
            values = values.astype(VECTOR) + 0.0  # no negative zeros
            packed = [stripped(values[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(packed, pa.binary())], ["id", "v"])

    rows = finite_rows(df, id_col, vector_col).where("id IS NOT NULL")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, v binary").where(F.length("v") > 0)


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(v, ids, copies): each distinct vector with its `most` smallest ids, in order, and how many rows have each of them."""
    counted = rows.groupBy("v", "id").agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("v").orderBy("id")
    first = counted.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    listed = first.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", "copies"))).alias("own"))
    return listed.select("v", F.col("own.id").alias("ids"), F.col("own.copies").alias("copies"))


def inner(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product, its terms added without rounding, so that it doesn't depend on their order."""
    with np.errstate(over="ignore", invalid="ignore"):
        terms = a * b
        try:
            return math.fsum(terms.tolist())
        except (OverflowError, ValueError):
            return float(terms.sum())


@dataclass(frozen=True)
class Index:
    """What blocks and queries have in common: pivots, the units of the table's vectors, and the share that is compared exactly."""

    dims: int
    unit: float  # largest component; distances are taken in units of it, so that no square overflows
    longest: float  # length of the longest vector, in units
    pivots: np.ndarray  # pivots x dimensions, in units
    share: float

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest**2 - np.einsum("ij,ij->i", x, x), 0))

    def positions(self, x: np.ndarray, asked: bool) -> np.ndarray:
        """The position of each pivot in the order of every vector: vectors x pivots. Ties go to the first pivot."""
        x = x / self.unit
        # Of two points at one distance from the origin the nearer has the larger inner product; a query's length plays no part.
        near = x @ self.pivots.T
        if not asked:
            near += self._lift(x)[:, None] * self._lift(self.pivots)[None]
        order = np.argsort(-near, axis=1, kind="stable")
        found = np.empty(order.shape, dtype=np.int16)
        np.put_along_axis(found, order, np.arange(order.shape[1], dtype=np.int16)[None], axis=1)
        return found


class Block:
    """The inverted files of a block's distinct vectors, and the vectors themselves for the exact comparison."""

    def __init__(self, index: Index, vectors: np.ndarray, ids: list[list], copies: list[list]):
        self.index, self.vectors, self.ids, self.copies = index, vectors, ids, copies
        # The file of a pivot: its position in the order of each vector.
        self.files = np.ascontiguousarray(index.positions(vectors, False).T)
        self.sizes = np.sqrt(np.einsum("ij,ij->i", vectors / index.unit, vectors / index.unit))

    def footrule(self, asked: np.ndarray) -> np.ndarray:
        """The footrule of each vector for the positions of a query, added up file by file."""
        return np.abs(self.files - asked[:, None]).sum(axis=0, dtype=np.int32)

    def candidates(self, asked: np.ndarray, k: int) -> np.ndarray:
        """The share of vectors that are nearest by footrule, with all that tie with the last of them."""
        n = len(self.vectors)
        wanted = max(math.ceil(self.index.share * n), LEAST * k)
        if wanted >= n:
            return np.arange(n)
        far = self.footrule(asked)
        return np.flatnonzero(far <= np.partition(far, wanted - 1)[wanted - 1])

    def top(self, query, vector: np.ndarray, asked: np.ndarray, k: int) -> list[tuple[float, object]]:
        """The k best (score, id) among the candidates, ties to the smaller id, without rows of the query's own id."""
        rows = self.candidates(asked, k)
        unit = self.index.unit
        near = (self.vectors[rows] / unit) @ (vector / unit)
        # One more vector than wanted, as one may hold the query's rows alone; and all within rounding of the last.
        if len(rows) > k + 1:
            slack = 1e-12 * float(np.linalg.norm(vector / unit)) * float(self.sizes.max())
            own = near >= np.partition(near, -(k + 1))[-(k + 1)] - slack
            rows = rows[own]
        found = []
        for row in rows.tolist():
            score = inner(vector, self.vectors[row])
            left = k
            for own, n in zip(self.ids[row], self.copies[row], strict=True):
                if own != query and left > 0:
                    found += [(score, own)] * min(n, left)
                    left -= n
        return sorted(found, key=lambda f: (-f[0], f[1]))[:k]


def fit(distinct: DataFrame, k: int = TOP) -> Index | None:
    """An index for written rows (v, ids, copies), fitted on the FITTED distinct vectors whose hashes are smallest; None without rows."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(v, dtype=VECTOR) for v in column(batch, "v").to_pylist()]
            largest = [float(np.abs(v).max()) for v in own]
            # The length as a share of the largest component, so that it can't overflow.
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(v) for v in own], pa.int64()), pa.array(largest, pa.float64()), pa.array([float(np.linalg.norm(v / m)) for v, m in zip(own, largest, strict=True)], pa.float64())],
                ["dims", "largest", "long"],
            )

    measured = distinct.select("v").mapInArrow(sizes, "dims long, largest double, long double")
    dims, unit = measured.agg(F.max("dims"), F.max("largest")).first()
    if dims is None:
        return None
    longest = measured.agg(F.max(F.col("long") * (F.col("largest") / F.lit(unit)))).first()[0]
    chosen = [bytes(r.v) for r in distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(FITTED).collect()]
    sample = matrix_of(chosen, VECTOR, dims)
    index = Index(dims, unit, longest, sample[:PIVOTS] / unit, 1.0)
    return Index(dims, unit, longest, index.pivots, measured_share(index, sample, k))


def measured_share(index: Index, sample: np.ndarray, k: int) -> float:
    """The share of a sample's vectors, nearest by footrule, that holds COVER of the neighbours of some of them."""
    block = Block(index, sample, [[]] * len(sample), [[]] * len(sample))
    ranks = []
    for row in range(max(0, len(sample) - TRIED), len(sample)):
        far = block.footrule(index.positions(sample[row : row + 1], True)[0])
        near = (sample / index.unit) @ (sample[row] / index.unit)
        near[row] = -np.inf
        best = np.argsort(-near, kind="stable")[: min(k, len(sample) - 1)]
        # With a vector at its footrule come all that tie with it.
        ranks += np.searchsorted(np.sort(far), far[best], side="right").tolist()
    return float(np.quantile(ranks, COVER)) / len(sample) if ranks else 1.0


def nearest_rows(
    df: DataFrame, queries: str, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP, rows: int = ROWS, queries_at_once: int = QUERIES
) -> DataFrame:
    """The k nearest rows found for every query, a row for which the condition holds: query_id, rank from 1, the id, score.

    Nearest is the largest inner product, in double precision; ties go to the smaller id. Vectors that are null, zero, empty, or hold
    null or a number that isn't finite, take no part, nor do null ids. A vector shorter than others counts as zero in the dimensions it lacks. Repeated rows of
    an id are candidates of their own, and no query is answered by a row of its own id; of a query with several vectors
    the one whose bytes are smallest is asked. Fewer than k candidates are all given; no rows give none.
    """
    spark = df.sparkSession
    whole = packed_vectors(df, id_col, vector_col)
    # The k smallest ids of a vector, and one for the query's own.
    distinct = table_of(distinct_vectors(whole, k + 1), "permutation-distinct")
    asked = packed_vectors(df.where(queries), id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    asked = table_of(asked, "permutation-queries")
    kind = whole.schema["id"].dataType.simpleString()
    index = fit(distinct, k)
    if index is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{id_col}` {kind}, score double")
    # A unit of work is a block with a lane of the queries; the block is sent once to each of its lanes.
    blocks, lanes = (max(1, -(-n // most)) for n, most in ((distinct.count(), rows), (asked.count(), queries_at_once)))

    def spread(number: str, size: int):
        return F.pmod(F.xxhash64("v", F.lit(number)), F.lit(size))

    every = lambda size: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")))
    posted = distinct.withColumn("block", spread("block", blocks)).withColumn("lane", every(lanes)).withColumn("query", F.lit(False))
    sent = asked.select("v", F.array("id").alias("ids"), F.array(F.lit(1).cast("long")).alias("copies"))
    sent = sent.withColumn("lane", spread("lane", lanes)).withColumn("block", every(blocks)).withColumn("query", F.lit(True))
    met = posted.unionByName(sent).withColumn("unit", (F.col("block") * lanes + F.col("lane")).cast("int"))
    met = met.select("unit", "query", "v", "ids", "copies").repartitionById(blocks * lanes, F.col("unit")).sortWithinPartitions("unit", "query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, waiting, block = None, [], None
        for batch in batches:
            units, is_query = column(batch, "unit").to_numpy(), column(batch, "query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(units) != 0) | (is_query[1:] != is_query[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if units[a] != unit:
                    unit, waiting, block = units[a], [], None
                part = batch.slice(a, b - a)
                if not is_query[a]:
                    waiting.append(part)
                    continue
                if block is None and waiting:
                    held = [[x for p in waiting for x in column(p, n).to_pylist()] for n in ("v", "ids", "copies")]
                    block, waiting = Block(index, matrix_of(held[0], VECTOR, index.dims), *held[1:]), []
                if block is not None:
                    yield _answers(block, part, k, id_col)

    best = met.mapInArrow(run, f"query_id {kind}, `{id_col}` {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")


def _answers(block: Block, part: pa.RecordBatch, k: int, id_col: str) -> pa.RecordBatch:
    """The neighbours in a block of a batch of queries."""
    asked = matrix_of(column(part, "v").to_pylist(), VECTOR, block.index.dims)
    positions = block.index.positions(asked, True)
    ids = [own[0] for own in column(part, "ids").to_pylist()]
    found = [(q, i, score) for q, v, p in zip(ids, asked, positions, strict=True) for score, i in block.top(q, v, p, k)]
    kind = part.schema.field("ids").type.value_type
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], kind), pa.array([f[1] for f in found], kind), pa.array([f[2] for f in found], pa.float64())], ["query_id", id_col, "score"]
    )
