"""Near copies by the Jaccard similarity of word shingles, proposed by covering tables over long fingerprints.

A text's fingerprint has the majority of each of 1,512 bits over its distinct shingles, cut into 42 parts of 36 bits. Each part
has the covering tables of radius 1, so a pair that differs in one bit of any part meets in a table: that is every
pair within 83 bits, and of pairs at a similarity of just 0.8, whose bits differ in 15 of 100, more than 9 in 10 by chance
over the parts. Whatever meets is confirmed by its exact similarity.

Equal sequences of words are one node. Buckets are never paired within: every node is first held against a bucket's smallest node,
its hub: the hub that most nodes meet, then those that this has not joined to it. What is still apart from the largest group of a bucket
is held against all of other groups if that is little, as in most buckets. In a crowded bucket it is held only against nodes with a shingle in common among the rarest of both, which no similar pair lacks: sets of n and m shingles that are similar share
4/9 (n + m) or more, so that in any common order the first one shared has at least as many left from there on, itself included, in either set.
The order puts last what several nodes of the cluster hold, so edits of one text meet only where they are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalmart.llm.components import components
from arrivalmart.llm.simhash import covering_masks
from arrivalmart.llm.texts import column, free_name, give_back, parts_of, table_of

WORDS = 5
SIMILARITY = 0.8
SEED = 42
PARTS = 42
PART_BITS = 36
PART_RADIUS = 1
MASKS = covering_masks(PART_RADIUS, PART_BITS)
# 64-bit words a fingerprint takes; one more is kept apart to sift pairs.
HASHED = -(-PARTS * PART_BITS // 64)
# At a similarity of 0.8 words of 64 bits differ in 9.7 bits, 2.9 either way; more than this is four such away.
SIFTED = 22
# A bucket is paired directly if its nodes and those outside its largest group make no more pairs than this.
DIRECT = 32
# Nodes whose shingles are taken for usual ones in their cluster. They order shingles, so they change the work and not the result.
SHOWN = 8
NODES = "row long, id long, same binary, n long, sieve long, parts array<long>"


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, bytes]:
    """The distinct shingles of a text as sorted 64-bit hashes, and a 128-bit hash of its words.

    A to Z are lower-cased. Fewer words than `words` are one shingle; no words give none.
    """
    own = text.encode().lower().split()
    joined = b" ".join(own)
    same = xxhash.xxh128_digest(joined)
    digest = xxhash.xxh64_intdigest
    if len(own) <= words:
        return np.array([digest(joined, SEED)] if own else [], dtype=np.uint64), same
    ends = np.cumsum(np.fromiter(map(len, own), dtype=np.int64, count=len(own)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: 1 - words]
    del own
    spans = zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(starts))), same


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """HASHED + 1 further 64-bit hashes of each hash, by the finaliser of SplitMix64."""
    steps = np.arange(1, HASHED + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = hashes[:, None] + steps[None, :]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> tuple[list[int], int]:
    """The parts of the fingerprint of distinct shingles, and the word that sifts pairs, as a signed number."""
    bits = 64 * (HASHED + 1)
    ones = np.zeros(bits, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 11):
        words = _mixed(hashes[at : at + (1 << 11)])
        ones += np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    flags = 2 * ones > len(hashes)
    parts = flags[: PARTS * PART_BITS].reshape(PARTS, PART_BITS) @ (1 << np.arange(PART_BITS, dtype=np.int64))
    return parts.tolist(), int(np.packbits(flags[-64:], bitorder="little").view(np.int64)[0])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sets of shingles; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _fingerprinted(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, "text", 2 << 20):
                same, n, sieve, parts = [], [], [], []
                for text in texts:
                    hashes, own = shingles(text.as_py())
                    bits, word = fingerprint(hashes)
                    same.append(own), n.append(len(hashes)), sieve.append(word), parts.append(bits)
                made = [pa.array(same, pa.binary()), pa.array(n, pa.int64()), pa.array(sieve, pa.int64()), pa.array(parts, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([column(part, "row"), column(part, "id"), *made], ["row", "id", "same", "n", "sieve", "parts"])

    return rows.mapInArrow(run, NODES)


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, sieve): a row for each table; the bucket's number holds the table's and the bits under its mask."""

    def under_masks(part: Column, number: Column) -> Column:
        table = number.cast("long") * len(MASKS)
        return F.array(*[F.shiftleft(table + k, PART_BITS).bitwiseOR(part.bitwiseAND(F.lit(mask))) for k, mask in enumerate(MASKS)])

    return nodes.select("node", "n", "sieve", F.explode(F.flatten(F.transform("parts", under_masks))).alias("bucket"))


def _sifted(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) that can be similar, as often as they meet: their sizes allow it, and so does the word that no table uses."""
    apart = F.bit_count(F.col("a.sieve").bitwiseXOR(F.col("b.sieve")))
    sizes = F.least("a.n", "b.n") >= SIMILARITY * F.greatest("a.n", "b.n")
    found = pairs.where(sizes & (apart <= SIFTED))
    return found.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).where("a <> b")


def _confirmed(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs whose texts are similar. Texts are (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            a, b = column(batch, "a").to_pylist(), column(batch, "b").to_pylist()
            keep = []
            for k, node in enumerate(a):
                if node != last:
                    last, left = node, shingles(column(batch, "a_text")[k].as_py() or "")[0]
                keep.append(jaccard(left, shingles(column(batch, "b_text")[k].as_py() or "")[0]) >= SIMILARITY)
            chosen = [k for k, good in enumerate(keep) if good]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for k in chosen], pa.int64()) for x in (a, b)], ["a", "b"])
            give_back()

    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")).hint("merge"), "b")
    both = right.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")).hint("merge"), "a")
    return table_of(both.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long"), f"similar-{name}")


def _rooted(links: DataFrame) -> DataFrame:
    """Links (a, b) of every node that is linked to another to its root."""
    return components(links).select(F.col("node").alias("a"), F.col("root").alias("b"))


def _named(rows: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    """Rows with the root of a node, which is its own if it has no link."""
    known = roots.select(F.col("a").alias(node), F.col("b").alias(root))
    return rows.join(known.hint("merge"), node, "left").withColumn(root, F.coalesce(root, node))


def _star_roots(buckets: DataFrame, texts: DataFrame) -> DataFrame:
    """Links to their roots of nodes that are linked to the hub of a bucket; the hub that most nodes meet is tried first."""
    stars = _sifted(buckets.select(F.struct("node", "n", "sieve").alias("a"), F.col("hub").alias("b")))
    stars = table_of(stars.distinct(), "similar-stars")
    met = stars.groupBy("a").agg(F.count(F.lit(1)).alias("met"))
    first = stars.join(met.hint("merge"), "a").groupBy("b").agg(F.max(F.struct("met", "a")).alias("most")).select(F.col("most.a").alias("a"), "b")
    first = table_of(first, "similar-first")
    roots = _rooted(_confirmed(first, texts, "first-links"))
    left = _named(_named(stars, roots, "a", "a_root"), roots, "b", "b_root").where("a_root <> b_root")
    left = left.select("a", "b").join(first.hint("merge"), ["a", "b"], "left_anti")
    return _rooted(roots.unionByName(_confirmed(table_of(left, "similar-left"), texts, "star-links")))


def rarest(hashes: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """The shingles by which a text meets others: a fifth of them and one more, in the order of their hashes, usual ones last."""
    known = np.isin(hashes, usual)
    return np.concatenate([hashes[~known], hashes[known]])[: len(hashes) // 5 + 1]


def _shown(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(chief, usual): the shingles of a few nodes of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in parts_of(batch, "text", 2 << 20):
                items = [shingles(text.as_py())[0].view(np.int64) for text in own]
                yield pa.RecordBatch.from_arrays([column(part, "chief"), pa.array(items, pa.list_(pa.int64()))], ["chief", "items"])

    few = members.groupBy("chief", F.pmod(F.xxhash64("node"), F.lit(SHOWN)).alias("class")).agg(F.min("node").alias("node"))
    made = few.join(texts.hint("merge"), "node").select("chief", "text").mapInArrow(run, "chief long, items array<long>")
    return table_of(made.groupBy("chief").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("usual")), "similar-usual")


def _met_in_clusters(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of a node outside its cluster's group and one of another group that can share 4/9 of all their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in parts_of(batch, "text", 2 << 20):
                usual = column(part, "usual")
                items = [rarest(shingles(text.as_py())[0], usual[k].values.to_numpy().view(np.uint64)).view(np.int64) for k, text in enumerate(own)]
                lengths = [len(x) for x in items]
                wide = part.select(names).take(pa.array(np.repeat(np.arange(len(items)), lengths)))
                places = np.concatenate([np.arange(x) for x in lengths])
                yield pa.RecordBatch.from_arrays([*wide.columns, pa.array(np.concatenate(items)), pa.array(places)], [*names, "item", "place"])

    names = ["chief", "node", "n", "sieve", "root"]
    both = members.join(texts.hint("merge"), "node").join(_shown(members, texts).hint("merge"), "chief")
    rows = table_of(both.select(*names, "text", "usual").mapInArrow(run, "chief long, node long, n long, sieve long, root long, item long, place long"), "similar-rarest")
    shared = (F.col("a.chief") == F.col("b.chief")) & (F.col("a.item") == F.col("b.item")) & (F.col("a.root") != F.col("b.root"))
    least = 4 * (F.col("a.n") + F.col("b.n"))
    enough = (9 * (F.col("a.n") - F.col("a.place")) >= least) & (9 * (F.col("b.n") - F.col("b.place")) >= least)
    return _sifted(rows.where("root <> chief").alias("a").join(rows.alias("b").hint("merge"), shared & enough))


def _rest_links(named: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between groups that meet in a bucket. Rows are (bucket, node, n, sieve, root)."""
    groups = named.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("own"))
    groups = groups.groupBy("bucket").agg(F.sum("own").alias("size"), F.max(F.struct("own", "root")).alias("most")).where("size > most.own")
    groups = groups.select("bucket", "size", (F.col("size") - F.col("most.own")).alias("outside"), F.col("most.root").alias("chief"))
    mixed = table_of(named.join(groups.hint("merge"), "bucket"), "similar-mixed")
    direct = F.col("outside") * F.col("size") <= DIRECT
    few = mixed.where(direct)
    met = few.where("root <> chief").alias("a").join(few.alias("b").hint("merge"), F.col("a.bucket").eqNullSafe(F.col("b.bucket")) & (F.col("a.root") != F.col("b.root")))
    members = table_of(mixed.where(~direct).select("chief", "node", "n", "sieve", "root").distinct(), "similar-crowded")
    pairs = _sifted(met)
    if not members.isEmpty():
        pairs = pairs.unionByName(_met_in_clusters(members, texts))
    return _confirmed(table_of(pairs.distinct(), "similar-rest"), texts, "rest-links")


def _groups(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of all nodes that are linked to another."""
    buckets = _buckets(nodes)
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n", "sieve")).alias("hub")).where("size > 1")
    shared = table_of(buckets.join(sizes.hint("merge"), "bucket").drop("size"), "similar-buckets")
    roots = _star_roots(shared, texts)
    named = table_of(_named(shared.drop("hub"), roots, "node", "root"), "similar-named")
    return components(roots.unionByName(_rest_links(named, texts)))


def _classes(df: DataFrame, id_col: str, text_col: str, row: str) -> DataFrame:
    """(row, id, component, first) of written rows that have numbers: first is the smallest id of the component with its row, null ids last."""
    slim = df.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = table_of(_fingerprinted(slim), "similar-rows")
    nodes = rows.groupBy("same").agg(F.min("row").alias("node"), F.first("n").alias("n"), F.first("sieve").alias("sieve"), F.first("parts").alias("parts"))
    nodes = table_of(nodes, "similar-nodes")
    texts = slim.select(F.col("row").alias("node"), "text")
    roots = _groups(nodes.where("n > 0"), texts)
    known = nodes.select("same", "node").join(roots.hint("merge"), "node", "left").select("same", F.coalesce("root", "node").alias("component"))
    return rows.select("row", "id", "same").join(known, "same").select("row", "id", "component")


def _firsts(classes: DataFrame) -> DataFrame:
    """(component, first): the row and id that stand for it."""
    return classes.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))


def _numbered(df: DataFrame, row: str) -> DataFrame:
    return table_of(df.withColumn(row, F.monotonically_increasing_id()), "similar-input")  # the numbers hold once they are written


def similar_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id and component_id, the smallest id reachable over links of texts with a similarity of 0.8 or more.

    Null and blank texts are alike and like no others. Equal rows and null ids are kept, and a component of null ids only
    has none; other columns are not read; no rows give none.
    """
    classes = table_of(_classes(_numbered(df.select(id_col, text_col), "_row"), id_col, text_col, "_row"), "similar-classes")
    firsts = _firsts(classes).select("component", F.col("first.id").alias("component_id"))
    return classes.join(firsts, "component").select(F.col("id").alias(id_col), "component_id")


def first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of similar texts, the one with the smallest id, with all its columns.

    Of rows that share that id one stays, and a component of null ids only keeps one. Blank and null texts are one component.
    """
    row = free_name(df, "row")
    wide = _numbered(df, row)
    chosen = _firsts(_classes(wide, id_col, text_col, row)).select(F.col("first.row").alias(row))
    return wide.join(chosen.hint("merge"), row, "left_semi").select(*df.columns)
