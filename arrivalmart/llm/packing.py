"""Shortest-pack-first packing over the histogram of lengths.

Texts become ids and are cut into pieces of at most `room` ids. Only the histogram of piece lengths, at most
`room` numbers, is planned on the driver: lengths are placed longest first, each into the sequences with the
least in them, a whole run of equal sequences at a time. The plan gives sequences to the ranks of each length;
every piece finds its place by its own rank, so no piece passes through the driver.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivalmart.llm.bpe import coder_of
from arrivalmart.llm.texts import column, parts_of, table_of

ROOM = 2048
END_ID = 1
PLACES = "length long, from_rank long, to_rank long, first_sequence long, offset long"


def cut_pieces(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, end_id: int = END_ID
) -> DataFrame:
    """Pieces of every text's ids, with the end id: full ones of `room` ids, then the rest.

    A null text is empty and so has only the end id. Each piece carries the number of its task and its place
    among the task's pieces of equal length, which stay valid only once the rows are written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, seen = coder_of(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for part, texts in parts_of(batch, text_col):
                flat, offsets = coder.encode(texts)
                rows, starts, lengths, sums, totals, places = [], [], [], [], [], []
                for row, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist(), strict=False)):
                    ids = np.append(flat[a:b], end_id).astype("<u4")
                    for at in range(0, len(ids), room):
                        piece = ids[at : at + room]
                        rows.append(row)
                        starts.append(at)
                        lengths.append(len(piece))
                        sums.append(zlib.crc32(piece.tobytes()))
                        totals.append(len(ids))
                        places.append(seen[len(piece)])
                        seen[len(piece)] += 1
                numbers = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals, places, [task] * len(rows))]
                yield pa.RecordBatch.from_arrays(
                    [column(part, id_col).take(pa.array(rows, pa.int64())), *numbers],
                    [id_col, "start", "length", "ids_crc32", "doc_tokens", "place", "task"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, place long, task long"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def plan_places(histogram: dict[int, int], room: int = ROOM) -> list[tuple[int, int, int, int, int]]:
    """Places for all pieces of a histogram: (length, from_rank, to_rank, first_sequence, offset).

    Ranks from_rank to to_rank - 1 of a length go to first_sequence and the sequences after it, each at the offset.
    A step either uses up a length or a run of equal sequences, and makes one run at most besides; new
    sequences of a length hold as many of it as fit. So the plan has a number of rows bounded by `room` alone.
    """
    places, packs, sequences = [], [], 0  # packs: a heap of (filled, first sequence, how many)
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left and packs and packs[0][0] + length <= room:
            filled, first, count = heapq.heappop(packs)
            now = min(left, count)
            places.append((length, rank, rank + now, first, filled))
            if count > now:
                heapq.heappush(packs, (filled, first + now, count - now))
            if filled + length < room:
                heapq.heappush(packs, (filled + length, first, now))
            rank, left = rank + now, left - now
        most = room // length
        for copies, count in ((most, left // most), (left % most, 1)):
            if not copies or not count:
                continue
            for nth in range(copies):
                places.append((length, rank, rank + count, sequences, nth * length))
                rank += count
            if copies * length < room:
                heapq.heappush(packs, (copies * length, sequences, count))
            sequences += count
    return places


def place_pieces(spark: SparkSession, pieces: DataFrame, room: int = ROOM) -> DataFrame:
    """Written pieces with sequence_id and offset; equal rows are pieces of their own, and an empty table gives none."""
    counts = pieces.groupBy("length", "task").agg(F.max("place").alias("last"))
    counts = table_of(counts, "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum(F.col("last") + 1).alias("n")).collect()}
    places = F.broadcast(spark.createDataFrame(plan_places(histogram, room), PLACES))
    # The pieces of a length are ranked task by task: what all tasks before have, and the place in its own.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("start_rank"))
    ranked = pieces.join(starts.hint("merge"), ["length", "task"]).withColumn("rank", F.col("start_rank") + F.col("place"))
    inside = (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    placed = ranked.join(places.withColumnRenamed("length", "place_length"), (F.col("length") == F.col("place_length")) & inside)
    sequence = F.col("first_sequence") + F.col("rank") - F.col("from_rank")
    return placed.withColumn("sequence_id", sequence).drop(
        "place", "task", "start_rank", "rank", "place_length", "from_rank", "to_rank", "first_sequence"
    )


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM) -> DataFrame:
    """Every id of every text in exactly one place of one sequence: id, start, length, ids_crc32, doc_tokens, offset, sequence_id.

    Null texts are empty; null ids and equal rows are kept; other columns are not read; no rows give no pieces.
    """
    pieces = table_of(cut_pieces(df, path, id_col, text_col, room), "packing-pieces")
    return place_pieces(df.sparkSession, pieces, room)
