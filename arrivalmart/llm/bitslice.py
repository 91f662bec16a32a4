"""Exact search for the highest inner products by a bit-sliced index.

A block of rows is indexed by slices: one bitmap over the rows for each bit of each quantised attribute. A query's
scores over the block are sums of slices, built by bitmap arithmetic: the attributes whose weight has bit j are
added with carry-save adders, and the sums of all j are added at their shifts. The result is the score of every
row as slices, from which the highest k are selected from the most significant slice downward. Rows that tie at the
boundary are resolved exactly, by their ids. Queries and rows meet in blocks, and each block gives k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivalmart.llm.texts import column, table_of

SCALE = 64
TOP = 20
ROWS = 32_768
QUERIES = 256
# Quantised vectors as long as this or longer take no part: any two shorter ones have an inner product below 2 to the 62.
LONGEST = float(1 << 31)
MET = ("block", "ids", "vectors", "query_ids", "query_vectors")

Slices = list[np.ndarray]  # the least significant first; each a bitmap, or one for each of several numbers


def half_add(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return a ^ b, a & b


def full_add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    either = a ^ b
    return either ^ c, a & b | either & c


def sum_bitmaps(columns: list[np.ndarray]) -> Slices:
    """The slices of a sum of bitmaps: columns[j] holds bitmaps, one a row, that each count 2 to the j.

    Three bitmaps of a column become one there and one in the next, all threes of a column at a time.
    """
    found, j = [], 0
    while j < len(columns):
        own = columns[j]
        carries = []
        while len(own) > 2:
            thirds = len(own) // 3
            total, carry = full_add(own[:thirds], own[thirds : 2 * thirds], own[2 * thirds : 3 * thirds])
            carries.append(carry)
            own = np.concatenate((total, own[3 * thirds :]))
        if len(own) == 2:
            total, carry = half_add(own[:1], own[1:])
            carries.append(carry)
            own = total
        if carries:
            if j + 1 == len(columns):
                columns.append(carries[0][:0])
            columns[j + 1] = np.concatenate((columns[j + 1], *carries))
        found.append(own[0] if len(own) else None)
        j += 1
    return found


class SlicedBlock:
    """Bitmaps of the bits of every attribute of a block of rows. values: rows x attributes, whole numbers."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.low = values.min(axis=0)
        over = np.ascontiguousarray((values - self.low).T).astype(np.uint64)  # attributes x rows, none below zero
        self.span = over.max(axis=1).astype(np.int64)
        self.bits = max(1, int(self.span.max()).bit_length())
        pad = -self.n % 64
        self.all = self._bitmap(np.ones((1, self.n), dtype=bool), pad)[0]
        # [bit, attribute, word]; and of what each attribute lacks to its highest value, for weights below zero
        self.slices = np.stack([self._bitmap((over >> b & 1).astype(bool), pad) for b in range(self.bits)])
        lack = self.span[:, None].astype(np.uint64) - over
        self.lacking = np.stack([self._bitmap((lack >> b & 1).astype(bool), pad) for b in range(self.bits)])

    @staticmethod
    def _bitmap(flags: np.ndarray, pad: int) -> np.ndarray:
        return np.packbits(np.pad(flags, ((0, 0), (0, pad))), axis=1, bitorder="little").view(np.uint64)

    def scores(self, weights: np.ndarray) -> tuple[Slices, int]:
        """The score of every row as slices, and what is to be added to each.

        A weight w above zero adds w * (x - low); below zero it adds -w * (high - x). Both are never negative.
        """
        base = int((weights * self.low).sum() + (np.minimum(weights, 0) * self.span).sum())
        size, falling = np.abs(weights), weights < 0
        columns: list[list[np.ndarray]] = [[] for _ in range(int(size.max(initial=0)).bit_length() + self.bits - 1)]
        for j in range(int(size.max(initial=0)).bit_length()):
            has = (size >> j & 1).astype(bool)
            for b in range(self.bits):
                columns[j + b] += [self.slices[b, has & ~falling], self.lacking[b, has & falling]]
        joined = [np.concatenate(c) if c else self.slices[0, :0] for c in columns]
        empty = np.zeros_like(self.all)
        return [empty if s is None else s for s in sum_bitmaps(joined)], base

    def top(self, weights: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k highest rows, ties to the smaller id, without the row of one id."""
        slices, base = self.scores(weights)
        wanted = self.all.copy()
        if without is not None:
            for at in np.flatnonzero(self.ids == without).tolist():
                wanted[at // 64] &= ~np.uint64(1 << at % 64)
        sure, tied, missing = np.zeros_like(wanted), wanted, k
        for own in reversed(slices):
            high = tied & own
            n = int(np.bitwise_count(high).sum())
            if n > missing:
                tied = high
            else:
                sure, missing, tied = sure | high, missing - n, tied & ~own
                if not missing:
                    break
        rows, ties = self._rows(sure), self._rows(tied)
        if missing and len(ties):
            rows = np.concatenate((rows, ties[np.argsort(self.ids[ties], kind="stable")[:missing]]))
        score = np.full(len(rows), base, dtype=np.int64)
        for j, own in enumerate(slices):
            score += (own[rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64) << j
        return self.ids[rows], score

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.n])


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): each component as floor(scale * x).

    Vectors that are null, empty, or hold null or a number that isn't finite, are left out, and so are those with a length of
    LONGEST or more, whose scores needn't fit a long.
    """
    vector = F.col(vector_col)

    def whole(x):
        return F.floor(F.lit(scale).cast("double") * x.cast("double"))

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = df.select(F.col(id_col).alias("id"), vector.alias("v")).where(F.col("id").isNotNull() & (F.size("v") > 0))
    rows = rows.where(F.forall("v", finite)).select("id", F.transform("v", whole).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return rows.where(squares < LONGEST * LONGEST)


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks (ids, vectors) of about `size` rows, twice that at most. A vector has zeros up to the longest of its block."""
    most = 2 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []

        def block() -> pa.RecordBatch:
            width = max(map(len, vectors))
            whole = np.array([v if len(v) == width else v + [0] * (width - len(v)) for v in vectors], dtype="<i4")
            packed = [[np.array(ids, dtype="<i8").tobytes()], [whole.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(p, pa.binary()) for p in packed], ["ids", "vectors"])

        for batch in batches:
            for own, v in zip(column(batch, "id").to_pylist(), column(batch, "v").to_pylist(), strict=True):
                ids.append(own)
                vectors.append(v)
                if len(ids) == most:
                    yield block()
                    ids, vectors = [], []
        if ids:
            yield block()

    return rows.repartition(max(1, -(-rows.count() // size))).mapInArrow(run, "ids binary, vectors binary")


def _unpacked(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, dtype="<i8")
    return own, np.frombuffer(vectors, dtype="<i4").reshape(len(own), -1).astype(np.int64)


def _fitted(weights: np.ndarray, width: int) -> np.ndarray:
    """Weights for a block of that width: a dimension that either side lacks adds nothing."""
    lack = width - weights.shape[1]
    return np.pad(weights, ((0, 0), (0, lack))) if lack > 0 else weights[:, :width]


def top_rows(
    df: DataFrame,
    queries: str,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = TOP,
    scale: int = SCALE,
    rows: int = ROWS,
    queries_at_once: int = QUERIES,
) -> DataFrame:
    """The k highest inner products of every query, a row for which the condition holds, over all other rows.

    Returns query_id, rank from 1, the id, score. Fewer than k rows give all there are; ties go to the smaller id.
    Shorter vectors count as zero in the dimensions they lack; which take no part is told by `quantised`. Repeated rows of one id are
    candidates of their own, and no query is answered by a row of its own id; a query that is repeated is answered once, for the
    vector that comes first by its components.
    """
    spark = df.sparkSession
    whole = quantised(df, id_col, vector_col, scale)
    asked = quantised(df.where(queries), id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    blocks = table_of(_packed(whole, rows).withColumn("block", F.monotonically_increasing_id()), "bitslice-blocks")
    asks = table_of(_packed(asked, queries_at_once).toDF("query_ids", "query_vectors"), "bitslice-queries")
    # Every group of queries goes to every numbered place, where one block or a few are. A place has lanes, each with
    # a copy of its blocks and a share of the groups, so that few blocks still fill all cores.
    places = max(1, blocks.count())
    lanes = max(1, min(asks.count(), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // places)))
    sent = asks.withColumn("lane", F.pmod(F.xxhash64("query_ids"), F.lit(lanes))).withColumn(
        "place", F.explode(F.sequence(F.lit(0), F.lit(places - 1)))
    )
    put = blocks.withColumn("place", F.pmod(F.xxhash64("block"), F.lit(places)).cast("int"))
    put = put.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                number, ids, vectors, query_ids, query_vectors = (column(batch, n)[row].as_py() for n in MET)
                if number != last:
                    last, block = number, SlicedBlock(*_unpacked(ids, vectors))
                own = _unpacked(query_ids, query_vectors)
                weights = _fitted(own[1], block.low.shape[0])
                found = [block.top(w, k, q) for q, w in zip(own[0].tolist(), weights, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own[0], [len(x) for x, _ in found])),
                        pa.array(np.concatenate([x for x, _ in found])),
                        pa.array(np.concatenate([score for _, score in found])),
                    ],
                    ["query_id", id_col, "score"],
                )

    met = sent.join(put.hint("merge"), ["place", "lane"]).select(*MET)
    best = met.mapInArrow(run, f"query_id long, `{id_col}` long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
