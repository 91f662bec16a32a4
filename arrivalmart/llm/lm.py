"""A language model of words in an Elias-Fano n-gram trie, learned from a corpus and used to score texts.

The model is an interpolated trigram model with one discount. The lowest order is p1(w) = (c + 1/2) / (N + (V + 1) / 2), one
unknown word included; above it, p(w | h) = max(c(h w) - D, 0) / c(h) + back(h) * p(w | h'), over all n-grams of the
corpus, those seen once too, and back(h) is what they leave over.

Words are known by 63 bits of the XXH64 of their bytes; a word's id is the rank of its hash in the vocabulary, an Elias-Fano sequence that is cut
by the hash. N-grams are counted in each task first, and sent on as packed blocks, one for each part of the trie. A part holds the
n-grams whose first two words hash to it, so no part is hot because of one frequent word. It is a trie: first words, then second
words, then third words; pointers from a level to the next are monotone, and the words below a context are numbered relative
to that context's base, so each level is one monotone sequence, searched for a successor. Probabilities are quantised to 16
bits of their logarithm, back-off weights kept in 32. The parts are files in the shared folder, mapped into memory by the tasks that score.
"""

from __future__ import annotations

import functools
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalmart.llm.eliasfano import EliasFano, read_arrays, write_arrays
from arrivalmart.llm.texts import coded_words, column, parts_of, spread_ranges, table_of
from arrivalmart.sources.workspace import hadoop_files, new_folder

END = "\n"  # stands after the last word; no word holds it
DISCOUNT = 0.75
PER_PART = 2_000_000  # tokens of the corpus for each part of the trie
PER_RANGE = 500_000  # words for each part of the vocabulary
CHUNK = 8 << 20  # bytes of text that a task holds as arrays at once
STEPS = 4096  # of a quantised logarithm, for each power of ten; 16 bits reach down to 1e-15
NO_WORD = (1 << 32) - 1


def quantised(p: np.ndarray) -> np.ndarray:
    """Steps of the logarithm, rounded to the smaller probability, so that what sums to one sums to no more."""
    return np.clip(np.ceil(-np.log10(np.maximum(p, 1e-15)) * STEPS), 0, 65535).astype(np.uint16)


RESTORED = 10.0 ** (np.arange(1 << 16, dtype=np.float64) / -STEPS)


def restored(steps: np.ndarray) -> np.ndarray:
    return RESTORED[steps]


def by_part(part: np.ndarray) -> np.ndarray:
    """Places in the order of their parts, those of a part in their own order; numbers of 16 bits are sorted by counting."""
    return np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")


def shortened(weights: np.ndarray) -> np.ndarray:
    """Back-off weights in 32 bits, rounded down. They stand in every probability, several at once, so they are kept finer than these."""
    found = weights.astype(np.float32)
    return np.where(found > weights, np.nextafter(found, np.float32(0)), found)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers, byte by byte, compressed: the high bytes are mostly equal."""
    head = np.array([len(a) for a in arrays], dtype="<u4").tobytes()
    body = b"".join(a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def unpack(data: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    lengths, at, found = raw[: 4 * n].view("<u4").tolist(), 4 * n, []
    for length in lengths:
        found.append(np.ascontiguousarray(raw[at : at + 4 * length].reshape(4, length).T).view("<u4").ravel())
        at += 4 * length
    return found


def mixed(pairs: np.ndarray) -> np.ndarray:
    """A hash of pairs of ids, as numbers of 64 bits."""
    x = pairs.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def hashes_of(words: list[str]) -> np.ndarray:
    """63 bits of each word's hash."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)) >> np.uint64(1)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts as codes, each text closed by the end; the hashes that the codes stand for; where texts begin, with the end."""
    codes, distinct, offsets = coded_words(pc.ascii_lower(texts))
    hashes = hashes_of([*distinct.to_pylist(), END])
    ends = offsets + np.arange(len(offsets))
    tokens, word = np.full(len(codes) + len(texts), len(distinct), dtype=np.int64), np.ones(len(codes) + len(texts), dtype=bool)
    word[ends[1:] - 1] = False
    tokens[word] = codes
    return tokens, hashes, ends


@dataclass(frozen=True)
class Layout:
    """Where the files of a model are, and the totals that all tasks need."""

    folder: str
    ranges: int  # parts of the vocabulary, a power of two
    bases: tuple[int, ...]  # the id of the first word of each, and the number of words
    tokens: int
    parts: int

    @property
    def words(self) -> int:
        return self.bases[-1]

    def range_of(self, hashes: np.ndarray) -> np.ndarray:
        bits = self.ranges.bit_length() - 1
        return (hashes >> np.uint64(63 - bits)).astype(np.int64)

    def path(self, kind: str, number: int) -> str:
        return f"{self.folder}/{kind}-{number:06d}.bin"


class Vocabulary:
    """Ids, counts and weights of the shorter context of words, from the files of a layout."""

    def __init__(self, layout: Layout, with_weights: bool):
        self.layout = layout
        self.parts = [read_arrays(layout.path("words", k)) if layout.bases[k] < layout.bases[k + 1] else None for k in range(layout.ranges)]
        self.found = [EliasFano(p, "hash") if p else None for p in self.parts]
        self.counts = [EliasFano(p, "count") if p else None for p in self.parts]
        self.weights = [read_arrays(layout.path("weights", k))["left"] if p and with_weights else None for k, p in enumerate(self.parts)]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each hash, -1 if it has none."""
        found, own = np.full(len(hashes), -1, dtype=np.int64), self.layout.range_of(hashes)
        for k in np.unique(own).tolist():
            if self.found[k] is not None:
                rows = np.flatnonzero(own == k)
                at, equal = self.found[k].successor(hashes[rows])
                found[rows[equal]] = at[equal] + self.layout.bases[k]
        return found

    def _by_range(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        own = np.searchsorted(np.array(self.layout.bases[1:]), ids, side="right")
        for k in np.unique(own[ids >= 0]).tolist():
            rows = np.flatnonzero((own == k) & (ids >= 0))
            yield k, rows, ids[rows] - self.layout.bases[k]

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        """How often each word is in the corpus; 0 for an id of -1."""
        found = np.zeros(len(ids), dtype=np.int64)
        for k, rows, at in self._by_range(ids):
            sums = self.counts[k]
            found[rows] = (sums.get(at + 1) - sums.get(at)).astype(np.int64)
        return found

    def weights_of(self, ids: np.ndarray) -> np.ndarray:
        """What each word as a context leaves to the shorter one; all of it for an id of -1."""
        found = np.ones(len(ids))
        for k, rows, at in self._by_range(ids):
            found[rows] = self.weights[k][at]
        return found


class Part:
    """One part of the trie: pairs below their first words, third words below their pairs."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.first, self.second, self.third = (EliasFano(arrays, n) for n in ("first", "second", "third"))
        self.bases = EliasFano(arrays, "second-base"), EliasFano(arrays, "third-base")
        self.pointers = EliasFano(arrays, "second-pointer"), EliasFano(arrays, "third-pointer")

    def _below(self, level: EliasFano, k: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of a word among the successors of a context, and whether it is there."""
        at, equal = level.successor(self.bases[k].get(context) + word.astype(np.uint64))
        return at, equal & (at < self.pointers[k].get(context + 1).astype(np.int64))

    def pairs(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The place of each pair, -1 if it has none."""
        found = np.full(len(u), -1, dtype=np.int64)
        root, known = self.first.successor(u.astype(np.uint64))
        rows = np.flatnonzero(known)
        at, equal = self._below(self.second, 0, root[rows], v[rows])
        found[rows[equal]] = at[equal]
        return found

    def triples(self, pair: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The place of each third word below a pair that has a place, -1 if it has none."""
        at, equal = self._below(self.third, 1, pair, w)
        return np.where(equal, at, -1)

    @staticmethod
    def build(u: np.ndarray, v: np.ndarray, p2: np.ndarray, left: np.ndarray, children: np.ndarray, w: np.ndarray, p3: np.ndarray) -> dict:
        """Arrays of pairs sorted by (u, v), and of third words sorted below them; `left` is what a pair leaves to the shorter context."""
        roots, begins = np.unique(u, return_index=True)
        arrays = EliasFano.arrays(roots, "first")
        arrays |= Part._level("second", np.append(begins, len(u)), v)
        arrays |= Part._level("third", np.append(0, np.cumsum(children)), w)
        return arrays | {"p2": quantised(p2), "left": shortened(left), "p3": quantised(p3)}

    @staticmethod
    def _level(name: str, pointers: np.ndarray, words: np.ndarray) -> dict:
        """Words sorted below each context, made one monotone sequence: each context's base is above all before it."""
        sizes = np.diff(pointers)
        # A context's words reach from its base to its highest word.
        last = np.where(sizes > 0, words[np.maximum(pointers[1:] - 1, 0)] + 1 if len(words) else 0, 0).astype(np.uint64)
        bases = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(last)))
        values = words.astype(np.uint64) + np.repeat(bases[:-1], sizes)
        found = EliasFano.arrays(values, name) | EliasFano.arrays(bases, f"{name}-base")
        return found | EliasFano.arrays(pointers, f"{name}-pointer")


@functools.lru_cache(maxsize=8)
def vocabulary_of(layout: Layout, with_weights: bool = False) -> Vocabulary:
    return Vocabulary(layout, with_weights)


@functools.lru_cache(maxsize=512)
def part_of(layout: Layout, number: int) -> Part:
    return Part(read_arrays(layout.path("part", number)))


def held_out(id_col: str) -> Column:
    """Whether a document is kept out of the corpus: crc32 of its id as text leaves 1, divided by 5. A null id isn't kept out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))


def _word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, own in parts_of(batch, text_col, CHUNK):
                tokens, hashes, _ = tokens_of(own)
                counts = np.bincount(tokens, minlength=len(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["hash", "n"])

    return texts.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _shared_uri(df: DataFrame, name: str) -> str:
    files, path = hadoop_files(df.sparkSession, new_folder(df.sparkSession, name))
    uri = files.makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """The rows of each key, of batches that are sorted by it."""
    last, held = None, []
    for batch in batches:
        keys = column(batch, key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if last is not None and keys[a] != last:
                yield last, held
                held = []
            last = int(keys[a])
            held.append(batch.slice(a, b - a))
    if last is not None:
        yield last, held


def _values(held: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([column(b, name).to_numpy() for b in held])


def _by_key(rows: DataFrame, parts: int, key: str, *then: str) -> DataFrame:
    return rows.repartition(max(1, parts), key).sortWithinPartitions(key, *then)


def _write_words(counts: DataFrame, folder: str) -> Layout:
    """The vocabulary as files, one for each range of hashes, and the layout without parts of the trie."""
    words, tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = max(0, (max(1, words) - 1) // PER_RANGE).bit_length()
    layout = Layout(folder, 1 << bits, (0,) * ((1 << bits) + 1), tokens, max(1, -(-tokens // PER_PART)))
    own = F.shiftright("hash", 63 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _runs(batches, "range"):
            hashes, counts = _values(held, "hash"), _values(held, "n")
            sums = np.concatenate(([0], np.cumsum(counts)))
            write_arrays(layout.path("words", number), EliasFano.arrays(hashes, "hash") | EliasFano.arrays(sums, "count"))
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(hashes)])], ["range", "n"])

    ranged = counts.select("hash", "n", own.alias("range"))
    sizes = dict(_by_key(ranged, layout.ranges, "range", "hash").mapInArrow(run, "range long, n long").collect())
    bases = np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(layout.ranges)])))
    return Layout(folder, layout.ranges, tuple(bases.tolist()), tokens, layout.parts)


def _ngram_blocks(texts: DataFrame, text_col: str, layout: Layout) -> DataFrame:
    """(part, block): the counted n-grams of a task's texts, those of each part of the trie packed in one block.

    A block has pairs (u, v) sorted, how many third words follow each, and those words with their counts; NO_WORD is the
    third word of the last pair of a text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(layout)
        for batch in batches:
            for _, own in parts_of(batch, text_col, CHUNK):
                tokens, hashes, offsets = tokens_of(own)
                ids = words.ids(hashes)[tokens]
                ends = offsets[1:] - 1
                inside = np.ones(len(ids), dtype=bool)
                inside[ends] = False
                at = np.flatnonzero(inside)  # where a pair begins
                if not len(at):
                    continue
                pairs = ids[at].astype(np.uint64) << np.uint64(32) | ids[at + 1].astype(np.uint64)
                third = np.append(ids, 0)[at + 2]
                third[~inside[at + 1]] = NO_WORD
                distinct, number = np.unique(pairs, return_inverse=True)
                triples, counts = np.unique(number.astype(np.uint64) << np.uint64(32) | third.astype(np.uint64), return_counts=True)
                pair = (triples >> np.uint64(32)).astype(np.int64)
                children = np.bincount(pair, minlength=len(distinct))
                part = (mixed(distinct) % np.uint64(layout.parts)).astype(np.int64)
                # Pairs by part, in their order within a part, and their triples with them.
                order = by_part(part)
                spread = spread_ranges((np.cumsum(children) - children)[order], children[order])
                w, c = (triples & np.uint64(NO_WORD))[spread], counts[spread]
                distinct, children, part = distinct[order], children[order], part[order]
                cuts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
                below = np.concatenate(([0], np.cumsum(children)))
                numbers, blocks = [], []
                for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                    u = (distinct[a:b] >> np.uint64(32)).astype(np.int64)
                    x, y = below[a], below[b]
                    numbers.append(int(part[a]))
                    blocks.append(pack(np.diff(u, prepend=0), distinct[a:b] & np.uint64(NO_WORD), children[a:b], w[x:y], c[x:y]))
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blocks, pa.binary())], ["part", "block"])

    return texts.mapInArrow(run, "part long, block binary")


def _merge_blocks(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, and all triples as the number of their pair, third word and count, both sorted."""
    pairs, owners, words, counts = [], [], [], []
    for block in packed or [pack(*[np.zeros(0)] * 5)]:
        steps, v, children, w, c = unpack(block, 5)
        own = np.cumsum(steps, dtype=np.uint64) << np.uint64(32) | v.astype(np.uint64)
        pairs.append(own)
        owners.append(np.repeat(own, children))
        words.append(w)
        counts.append(c)
    distinct = np.unique(np.concatenate(pairs))
    number = np.searchsorted(distinct, np.concatenate(owners)).astype(np.uint64)
    keys = number << np.uint64(32) | np.concatenate(words).astype(np.uint64)
    order = np.argsort(keys)
    keys, found = keys[order], np.concatenate(counts)[order].astype(np.int64)
    firsts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    keys = keys[firsts]
    sums = np.add.reduceat(found, firsts) if len(keys) else found
    return distinct, (keys >> np.uint64(32)).astype(np.int64), keys & np.uint64(NO_WORD), sums


def _write_parts(blocks: DataFrame, layout: Layout) -> DataFrame:
    """Writes the parts of the trie; gives (word, taken): the discounted counts of the pairs of a part, by their first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(layout)
        for number, held in _runs(batches, "part"):
            blocks = [b.as_py() for batch in held for b in column(batch, "block") if b.is_valid]
            distinct, pair, w, c = _merge_blocks(blocks)
            total = np.bincount(pair, weights=c, minlength=len(distinct))
            u, v = (distinct >> np.uint64(32)).astype(np.int64), (distinct & np.uint64(NO_WORD)).astype(np.int64)
            roots, root = np.unique(u, return_inverse=True)
            p2 = (total - DISCOUNT) / words.counts_of(roots)[root]
            inside = w != np.uint64(NO_WORD)
            own = pair[inside]
            p3 = (c[inside] - DISCOUNT) / total[own]
            children = np.bincount(own, minlength=len(u))
            left = (total - np.bincount(own, weights=c[inside] - DISCOUNT, minlength=len(u))) / total
            write_arrays(layout.path("part", number), Part.build(u, v, p2, left, children, w[inside], p3))
            taken = np.bincount(root, weights=total - DISCOUNT, minlength=len(roots))
            yield pa.RecordBatch.from_arrays([pa.array(roots), pa.array(taken)], ["word", "taken"])

    # A row without a block for each part, so that every part has its file.
    every = blocks.sparkSession.range(layout.parts).select(F.col("id").alias("part"), F.lit(None).cast("binary").alias("block"))
    return _by_key(blocks.unionByName(every), layout.parts, "part").mapInArrow(run, "word long, taken double")


def _write_weights(takings: DataFrame, layout: Layout) -> None:
    """For each part of the vocabulary, what each word as a context leaves to the shorter one."""
    bases = layout.bases
    own = F.lit(0).cast("long")
    for base in bases[1:-1]:
        own = own + (F.col("word") >= base).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _runs(batches, "range"):
            counts = vocabulary_of(layout).counts_of(np.arange(bases[number], bases[number + 1]))
            taken = np.zeros(len(counts))
            for batch in held:
                taken[column(batch, "word").to_numpy() - bases[number]] += column(batch, "taken").to_numpy()
            write_arrays(layout.path("weights", number), {"left": shortened((counts - taken) / counts)})
            yield pa.RecordBatch.from_arrays([pa.array([number])], ["range"])

    summed = takings.groupBy("word").agg(F.sum("taken").alias("taken")).withColumn("range", own)
    # A row that takes nothing for each range, so that every range has its file.
    starts = [(base, 0.0, k) for k, base in enumerate(bases[:-1]) if base < bases[k + 1]]
    if starts:
        more = takings.sparkSession.createDataFrame(starts, "word long, taken double, range long")
        _by_key(summed.unionByName(more), layout.ranges, "range").mapInArrow(run, "range long").collect()


def learn(corpus: DataFrame, text_col: str = "text") -> Layout:
    """The model of all texts of a corpus. Null texts are empty, an empty text is its end alone; repeated rows count again."""
    texts = corpus.select(text_col)
    folder = posixpath.join(_shared_uri(corpus, "trie"), "levels")
    layout = _write_words(table_of(_word_counts(texts, text_col), "trie-words"), folder)
    takings = table_of(_write_parts(_ngram_blocks(texts, text_col, layout), layout), "trie-taken")
    _write_weights(takings, layout)
    return layout


def score_texts(tokens: np.ndarray, hashes: np.ndarray, offsets: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: tokens that are in the corpus, base score, and the model's score, both log10."""
    words = vocabulary_of(layout, True)
    ids = words.ids(hashes)
    counts = words.counts_of(ids)
    p1 = (counts + 0.5) / (layout.tokens + 0.5 * (layout.words + 1))
    weights, p, own = words.weights_of(ids), p1[tokens].copy(), ids[tokens]
    starts = offsets[:-1]
    base = np.add.reduceat(np.log10(p1)[tokens], starts)
    known = np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts)
    first = np.zeros(len(tokens), dtype=bool)
    first[starts] = True
    second = np.flatnonzero(~first)  # tokens with a word before them in their text
    pairs = np.where((own[second - 1] >= 0) & (own[second] >= 0), own[second - 1] << 32 | own[second], -1).astype(np.int64)
    distinct, number = np.unique(pairs, return_inverse=True)
    place, part = np.full(len(distinct), -1, dtype=np.int64), np.full(len(distinct), -1, dtype=np.int64)
    a2, left = np.zeros(len(distinct)), np.ones(len(distinct))
    real = np.flatnonzero(distinct >= 0)
    part[real] = (mixed(distinct[real].view(np.uint64)) % np.uint64(layout.parts)).astype(np.int64)
    grouped = real[by_part(part[real])]
    for rows in np.split(grouped, np.flatnonzero(np.diff(part[grouped])) + 1) if len(grouped) else ():
        trie = part_of(layout, int(part[rows[0]]))
        at = trie.pairs(distinct[rows] >> 32, distinct[rows] & NO_WORD)
        hit = at >= 0
        place[rows[hit]] = at[hit]
        a2[rows[hit]] = restored(trie.arrays["p2"][at[hit]])
        left[rows[hit]] = trie.arrays["left"][at[hit]]
    p[second] = a2[number] + weights[tokens[second - 1]] * p[second]
    # The pair that ends before a token is the one at the place before, if that is in the same text.
    pair_at = np.full(len(tokens), -1, dtype=np.int64)
    pair_at[second] = number
    context = np.where(first, -1, np.concatenate(([-1], pair_at[:-1])))
    third = np.flatnonzero(context >= 0)
    third = third[place[context[third]] >= 0]
    pair = context[third]
    a3 = np.zeros(len(third))
    asked = np.flatnonzero(own[third] >= 0)
    # By part, and by pair within it: neighbours in the trie are then asked for one after the other.
    turn = np.empty(len(distinct), dtype=np.int64)
    turn[grouped] = np.arange(len(grouped))
    asked = asked[np.argsort(turn[pair[asked]])]
    for rows in np.split(asked, np.flatnonzero(np.diff(part[pair[asked]])) + 1) if len(asked) else ():
        trie = part_of(layout, int(part[pair[rows[0]]]))
        at = trie.triples(place[pair[rows]], own[third[rows]])
        hit = at >= 0
        a3[rows[hit]] = restored(trie.arrays["p3"][at[hit]])
    p[third] = a3 + left[pair] * p[third]
    return known, base, np.add.reduceat(np.log10(p), starts)


def score(df: DataFrame, layout: Layout, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows' id, n_tokens, n_known, base_score and score. Null texts are empty: their end alone is scored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, text_col, CHUNK):
                tokens, hashes, offsets = tokens_of(texts)
                known, base, own = score_texts(tokens, hashes, offsets, layout)
                yield pa.RecordBatch.from_arrays(
                    [column(part, id_col), *map(pa.array, (np.diff(offsets), known, base, own))],
                    [id_col, "n_tokens", "n_known", "base_score", "score"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, n_known long, base_score double, score double")


def score_held_out(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all rows by a model of those that aren't held out, with held_out and train_tokens. No rows give none."""
    rows = df.select(id_col, text_col)
    layout = learn(rows.where(~held_out(id_col)), text_col)
    scored = score(rows, layout, id_col, text_col)
    return scored.withColumns({"held_out": held_out(id_col), "train_tokens": F.lit(layout.tokens).cast("long")})
