"""Near copies by SimHash and covering locality-sensitive hashing.

A text's fingerprint has the majority of each bit over the hashes of its word shingles. Two texts are linked if
their fingerprints differ in at most `radius` bits. The search is exact: bits are mapped to vectors of radius + 1
binary digits, and each non-zero vector v gives a table whose mask holds the bits whose vector is not orthogonal
to v. The vectors of at most `radius` differing bits leave some v orthogonal to all of them, and in that table
the pair has the same key. So every linked pair meets in some bucket, and no other threshold is involved.

Equal fingerprints are one node, so copies are never paired. Within a bucket only a spanning forest of its links is
given out. A bucket with more fingerprints than `most` is refined instead of compared: its free bits are cut into
radius + 1 blocks, and a linked pair agrees in one of them, so it meets again in a bucket with that block fixed as
well. Each refinement fixes a quarter of the free bits, which bounds a bucket whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from arrivalmart.llm.components import components
from arrivalmart.llm.texts import column, free_name, parts_of, table_of

BITS = 64
RADIUS = 3
WORDS = 3
SEED = 42
# Fingerprints that are compared with one another in one go; more of them are split by further bits.
MOST = 512
# After so many refinements of at most 36 free bits, at most 12 are left: 4,096 fingerprints.
REFINEMENTS = 4


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text as an unsigned number; a text without words has zero."""
    own = text.encode().lower().split()  # of bytes: A to Z only, and only the six blanks of ASCII
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
        ends = np.cumsum(lengths + 1) - 1
        starts, ends = (ends - lengths)[: 1 - words], ends[words - 1 :]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), dtype=np.uint64, count=len(starts)
        )
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)]
        set_bits += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """All rows and columns but the text, and the fingerprint as a signed long. A null text has no words."""
    fields = [f for f in df.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, text_col):
                found = np.array([fingerprint(t) for t in texts.to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*[column(part, f.name) for f in fields], pa.array(found)], [*[f.name for f in fields], name])

    return df.mapInArrow(run, StructType([*fields, StructField(name, LongType())]))


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask for each non-zero vector of radius + 1 digits; the bits take these vectors in turn."""
    vectors = range(1, 1 << (radius + 1))
    own = [vectors[bit % len(vectors)] for bit in range(bits)]
    return [sum(1 << bit for bit in range(bits) if (own[bit] & v).bit_count() % 2) for v in vectors]


def refined_masks(mask: int, radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The mask with each of radius + 1 blocks of its free bits added."""
    free = [bit for bit in range(bits) if not mask >> bit & 1]
    return [mask | sum(1 << bit for bit in free[k :: radius + 1]) for k in range(radius + 1)]


def signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def bucket_links(found: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """For each connected group of a bucket's fingerprints, links from its smallest to the others."""
    if len(found) == 2:
        near = int(found[0] ^ found[1]).bit_count() <= radius
        return [(int(found[0]), int(found[1]))] if near else []
    own = found.view(np.uint64)
    waiting, links = np.arange(len(found)), []
    while len(waiting) > 1:
        root, waiting = waiting[0], waiting[1:]
        reached = [root]
        while reached and len(waiting):
            near = np.bitwise_count(own[waiting] ^ own[reached.pop()]) <= radius
            links += [(int(found[root]), int(found[k])) for k in waiting[near]]
            reached += waiting[near].tolist()
            waiting = waiting[~near]
    return links


def _links_in_buckets(rows: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) with a < b of the buckets (mask, key); rows of a bucket are read in one run of a sorted task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((3, 0), dtype=np.int64)

        def links_of(block: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero((block[:2, 1:] != block[:2, :-1]).any(axis=0)) + 1
            begins, ends = np.append(0, cuts), np.append(cuts, block.shape[1])
            links = []
            for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                if b - a > 1:
                    links += bucket_links(block[2, a:b], radius)
            pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            block = np.concatenate([rest, np.array([c.to_numpy() for c in batch.columns], dtype=np.int64)], axis=1)
            if not block.shape[1]:
                continue
            same = (block[:2] == block[:2, -1:]).all(axis=0)
            last = block.shape[1] - int(np.argmin(same[::-1])) if not same.all() else 0
            yield from links_of(block[:, :last]) if last else ()
            rest = block[:, last:]
        if rest.shape[1]:
            yield from links_of(rest)

    ordered = rows.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return ordered.mapInArrow(run, "a long, b long")


def find_links(spark: SparkSession, distinct: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """Links that connect what is linked, over distinct fingerprints `fp`: a spanning forest of each bucket, without repeats."""
    level = covering_masks(radius)
    masks = F.array(*[F.lit(signed(m)) for m in level])
    rows = distinct.select("fp", F.explode(masks).alias("mask"))
    links = None
    for depth in range(REFINEMENTS + 1):
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = table_of(sizes, f"simhash-sizes-{depth}")  # a table, so that a hot bucket is split in the join
        shared = table_of(rows.join(sizes, ["mask", "key"]), f"simhash-buckets-{depth}")
        small = shared if depth == REFINEMENTS else shared.where(F.col("n") <= most)
        found = table_of(_links_in_buckets(small, radius), f"simhash-links-{depth}")
        links = found if links is None else links.unionByName(found)
        large = shared.where(F.col("n") > most)
        if depth == REFINEMENTS or large.isEmpty():
            break
        # The masks of a level depend on the radius alone, 15 times 4 to the depth.
        finer = [(signed(m), signed(x)) for m in level for x in refined_masks(m, radius)]
        level = [x for m in level for x in refined_masks(m, radius)]
        known = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        rows = large.select("mask", "fp").join(known, "mask").select("fp", F.col("finer").alias("mask"))
    return links.distinct()


def near_copies(fingerprints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """For each distinct fingerprint `fp` of written rows (id, fingerprint) its component_id: the smallest id reachable.

    Null ids take part, but no component is named by one unless it has no other.
    """
    spark = fingerprints.sparkSession
    distinct = fingerprints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("first_id"))
    distinct = table_of(distinct, "simhash-distinct")
    roots = components(find_links(spark, distinct.select("fp"), radius, most))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    joined = joined.withColumn("root", F.coalesce("root", "fp"))
    smallest = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")


def link_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, fingerprint as 16 hex digits, and component_id.

    Null and empty texts have the fingerprint zero and are linked like any other. Equal rows and null ids are kept;
    other columns are not read; no rows give none.
    """
    rows = with_fingerprints(df.select(id_col, text_col), text_col).select(id_col, "fingerprint")
    rows = table_of(rows, "simhash-rows")
    known = near_copies(rows, id_col)
    joined = rows.join(known, rows["fingerprint"] == known["fp"])
    return joined.select(rows[id_col], F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, the one with the smallest id, with all its columns.

    Of rows that share that id in a group, equal or not, one stays; a group of null ids only keeps one. Texts are
    moved once, in the join with the chosen rows; only ids, row numbers and texts pass through Python.
    """
    row = free_name(df, "row")
    wide = table_of(df.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")  # the numbers hold once they are written
    slim = wide.select(F.col(id_col).alias("id"), F.col(row).alias("row"), F.col(text_col).alias("text"))
    slim = table_of(with_fingerprints(slim), "simhash-fingerprints")
    known = near_copies(slim, "id")
    first = slim.join(known, slim["fingerprint"] == known["fp"]).where(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root").agg(F.min("row").alias(row)).select(row)
    return wide.join(chosen, row, "left_semi").select(*df.columns)
