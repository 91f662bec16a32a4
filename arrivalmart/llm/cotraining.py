"""Quality by co-training: a classifier of what a text holds and one of what is known about its page teach each other.

Each view has a logistic regression. In each round, each labels the rows of a pool, all unlabelled documents, that it is surest
about, and these labels are added to what the other learns from. The two are then calibrated on labelled rows that neither
has learned from, and their log-odds added, less the prior that both contain. The features of the pool are written once; each
round scores them where they are, counts the scores in fine bins, and takes its shares of the whole pool from these counts. Only the
labelled rows that are fitted on, given or taught, are a bounded sample, chosen by a hash of the id. Every document is scored, over its whole text, in one pass that moves no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from arrivalmart.llm.texts import bytes_of, coded_words, column, free_name, parts_of, table_of

# Rows to fit on, at most: labelled ones, and ones that a view has been taught in a round.
LABELLED = 4_000
TAUGHT = 1_000
BINS = 60_000  # of the scores of a pool, from -30 to 30
ROUNDS = 4
SURE = 0.05  # the share of the pool that a view labels in a round
GRAMS = 512  # buckets of three bytes
BUCKETS = 64  # of values of each metadata column
RIDGE = 100.0  # on standardised features
KEPT_FROM = 0.5
CHUNK = 2 << 20  # bytes of text that a task holds as arrays at once
META = ("lang", "source", "n_chars")


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of the values of each text."""
    ends = np.concatenate((np.zeros(1), np.cumsum(values, dtype=np.float64)))
    return ends[offsets[1:]] - ends[offsets[:-1]]


def _gram_codes(data: np.ndarray) -> np.ndarray:
    """The bucket of the three bytes from each place on; the last two places of a text reach into the next and are left out by the caller."""
    wide = data.astype(np.uint32)
    wide = np.concatenate((wide, np.zeros(2, dtype=np.uint32)))
    mixed = (wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA77)) ^ (wide[2:] * np.uint32(0xC2B2AE3D))
    return (mixed >> np.uint32(23)).astype(np.int64)


def _gram_places(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a place begins three bytes of its text, and how many each text has."""
    inside = np.ones(size, dtype=bool)
    ends, lengths = offsets[1:], np.diff(offsets)
    inside[ends[lengths > 0] - 1] = False
    inside[ends[lengths > 1] - 2] = False
    return inside, np.maximum(lengths - 2, 1)


def dense_features(texts: pa.Array) -> np.ndarray:
    """Measures of each text: size, word length, variety of words, compressed size, signs, digits, capitals, bytes beyond ASCII."""
    data, offsets = bytes_of(texts)
    size = np.maximum(np.diff(offsets), 1)
    codes, distinct, words = coded_words(texts)
    n_words = np.maximum(np.diff(words), 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(words))
    own = np.unique(owner * max(1, len(distinct)) + codes)
    variety = np.bincount(own // max(1, len(distinct)), minlength=len(texts))
    letters = np.zeros((5, 256))
    letters[0, [ord(c) for c in "#*$%&|<>"]] = 1
    letters[1, 0x30:0x3A] = 1
    letters[2, 0x41:0x5B] = 1
    letters[3, 0x80:] = 1
    letters[4, [ord(c) for c in ".,;:!?"]] = 1
    compressor = zstandard.ZstdCompressor(level=1)
    packed = np.array([len(compressor.compress(data[a:b])) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)], dtype=float)
    shares = [_sums(kind[data], offsets) for kind in letters]
    return np.stack(
        [
            np.log1p(np.diff(words)),
            size / n_words,
            variety / n_words,
            (packed - 10) / size,
            shares[0] / n_words,
            shares[1] / size,
            shares[2] / size,
            shares[3] / size,
            shares[4] / n_words,
        ],
        axis=1,
    )


def gram_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many byte triples of each whole text are in each bucket, and how many it has; a long text is counted slice by slice."""
    data, offsets = bytes_of(texts)
    inside, totals = _gram_places(offsets, len(data))
    found = np.zeros(len(texts) * GRAMS, dtype=np.int64)
    for at in range(0, len(data), CHUNK):
        own = inside[at : at + CHUNK]
        codes = _gram_codes(data[at : at + CHUNK + 2])[: len(own)]
        owner = np.searchsorted(offsets, np.arange(at, at + len(own)), side="right") - 1 if len(texts) > 1 else 0
        found += np.bincount((owner * GRAMS + codes)[own], minlength=len(found))
    return found.reshape(len(texts), GRAMS), totals


def joined_features(dense: np.ndarray, grams: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Dense measures and the shares of hashed byte triples."""
    return np.concatenate((dense, np.sqrt(grams / totals[:, None])), axis=1)


def text_features(texts: pa.Array) -> np.ndarray:
    """The features of each whole text."""
    return joined_features(dense_features(texts), *gram_counts(texts))


def packed_counts(row: np.ndarray) -> bytes:
    """Counts by the least width that holds all of them, the width first."""
    width = next(w for w in (1, 2, 4, 8) if row.max() < 1 << 8 * w)
    return bytes([width]) + row.astype(f"<u{width}").tobytes()


def unpacked_counts(packed: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, dtype=f"<u{p[0]}", offset=1).astype(np.float64) for p in packed])


def meta_features(batch: pa.RecordBatch, columns: tuple[str, ...]) -> np.ndarray:
    """Each column's value as one of some buckets, numbers by their magnitude too; null is a value, a missing column has none."""
    found = []
    for name in columns:
        hot = np.zeros((batch.num_rows, BUCKETS))
        size = np.zeros((batch.num_rows, 2))
        if name in batch.schema.names:
            values = column(batch, name)
            if pa.types.is_integer(values.type) or pa.types.is_floating(values.type):
                numbers = pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(float)
                numbers = np.log1p(np.abs(np.nan_to_num(numbers)))
                size = np.stack([numbers, numbers**2 / 10], axis=1)
                hot[np.arange(len(hot)), np.minimum(2 * numbers, BUCKETS - 1).astype(int)] = 1
            else:
                coded = values.cast(pa.string()).dictionary_encode(null_encoding="encode")
                buckets = np.array([zlib.crc32(repr(v).encode()) % BUCKETS for v in coded.dictionary.to_pylist()], dtype=int)
                hot[np.arange(len(hot)), buckets[coded.indices.to_numpy()]] = 1
        found += [hot, size]
    return np.concatenate(found, axis=1)


@dataclass
class Logistic:
    """A ridge logistic regression over standardised features, fitted by Newton steps, with a Platt calibration after it."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    slope: float = 1.0
    shift: float = 0.0

    @staticmethod
    def _newton(x: np.ndarray, y: np.ndarray, ridge: float, steps: int) -> np.ndarray:
        wide = np.concatenate((x, np.ones((len(x), 1))), axis=1)
        weights, penalty = np.zeros(wide.shape[1]), np.full(wide.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(wide @ weights, -30, 30)))
            curve = np.maximum(p * (1 - p), 1e-4)
            slope = wide.T @ (p - y) + penalty * weights
            weights = weights - np.linalg.solve((wide * curve[:, None]).T @ wide + np.diag(penalty), slope)
        return weights

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.scale[self.scale < 1e-5] = 1.0
        self.weights = self._newton((x - self.mean) / self.scale, y, RIDGE, 6)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        own = self.weights[:-1] / self.scale
        return x @ own + (self.weights[-1] - self.mean @ own)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt's scaling on rows that weren't learned from, with his softened targets."""
        soft = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        self.slope, self.shift = self._newton(np.clip(self.raw(x), -30, 30)[:, None], soft, 1e-3, 20).tolist()

    def log_odds(self, raw: np.ndarray) -> np.ndarray:
        return self.slope * np.clip(raw, -30, 30) + self.shift


@dataclass
class Model:
    """Both views; without them every text has the prior."""

    prior: float
    text: Logistic | None = None
    meta: Logistic | None = None
    columns: tuple[str, ...] = META

    def scores(self, batch: pa.RecordBatch, texts: pa.Array) -> np.ndarray:
        """The probability of good quality of every row."""
        if self.text is None or self.meta is None:
            return np.full(batch.num_rows, 1 / (1 + math.exp(-self.prior)))
        both = self.text.log_odds(self.text.raw(text_features(texts))) + self.meta.log_odds(self.meta.raw(meta_features(batch, self.columns))) - self.prior
        return 1 / (1 + np.exp(-np.clip(both, -30, 30)))



@dataclass
class Lesson:
    """What one view labels in a round: rows scored below `low` are bad, above `high` good."""

    teacher: int
    view: Logistic
    low: int  # bins
    high: int

    def labels(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        bins = bins_of(self.view.raw(views[self.teacher]))
        return np.where(bins < self.low, 0, np.where(bins > self.high, 1, -1))


def bins_of(raw: np.ndarray) -> np.ndarray:
    return np.floor((np.clip(raw, -30, 29.999999) + 30) * (BINS / 60)).astype(np.int64)


def untaught(views: tuple[np.ndarray, np.ndarray], lessons: list[Lesson], teacher: int) -> np.ndarray:
    """Rows that this teacher has not labelled yet."""
    waiting = np.ones(len(views[0]), dtype=bool)
    for lesson in lessons:
        if lesson.teacher == teacher:
            waiting &= lesson.labels(views) < 0
    return waiting


class LocalPool:
    """Unlabelled rows as arrays."""

    def __init__(self, text: np.ndarray, meta: np.ndarray):
        self.views, self.size = (text, meta), len(text)

    def counts(self, lessons: list[Lesson], teacher: int, view: Logistic) -> np.ndarray:
        """How many rows that wait for this teacher have scores in each bin."""
        return np.bincount(bins_of(view.raw(self.views[teacher])[untaught(self.views, lessons, teacher)]), minlength=BINS)

    def taught(self, lessons: list[Lesson], lesson: Lesson) -> tuple[np.ndarray, np.ndarray]:
        """The other view of the rows of a lesson, and their labels."""
        rows = np.flatnonzero(untaught(self.views, lessons, lesson.teacher) & (lesson.labels(self.views) >= 0))
        return self.views[1 - lesson.teacher][rows], lesson.labels(self.views)[rows]


STORED = "dense binary, grams binary, n_grams long"
SCORED = 4096  # rows of the pool that a task holds as arrays at once


def arrays_of(rows: pa.RecordBatch | pa.Table, columns: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Both views of stored rows: dense measures, counts of triples, and the metadata as they are."""
    dense = np.frombuffer(b"".join(rows["dense"].to_pylist()), dtype="<f8").reshape(rows.num_rows, -1)
    batch = rows.combine_chunks().to_batches()[0] if isinstance(rows, pa.Table) else rows
    return joined_features(dense, unpacked_counts(rows["grams"].to_pylist()), rows["n_grams"].to_numpy()), meta_features(batch, columns)


def slices_of(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SCORED):
            part = batch.slice(at, SCORED)
            yield part, arrays_of(part, columns)


class TablePool:
    """Unlabelled rows as a written table (_id, STORED, metadata); only counts of bins and a bounded sample of taught rows reach the driver."""

    def __init__(self, rows: DataFrame, columns: tuple[str, ...]):
        self.rows, self.size, self.columns = rows, rows.count(), columns

    def counts(self, lessons: list[Lesson], teacher: int, view: Logistic) -> np.ndarray:
        columns = self.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(BINS, dtype=np.int64)
            for _, views in slices_of(batches, columns):
                found += LocalPool(*views).counts(lessons, teacher, view)
            own = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(found[own])], ["bin", "n"])

        counted = self.rows.drop("_id").mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
        found = np.zeros(BINS, dtype=np.int64)
        found[counted["bin"].to_numpy()] = counted["n"].to_numpy()
        return found

    def taught(self, lessons: list[Lesson], lesson: Lesson) -> tuple[np.ndarray, np.ndarray]:
        columns = self.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, views in slices_of(batches, columns):
                labels = lesson.labels(views)
                own = np.flatnonzero(untaught(views, lessons, lesson.teacher) & (labels >= 0))
                other = [row.tobytes() for row in views[1 - lesson.teacher][own].astype("<f8")]
                yield pa.RecordBatch.from_arrays([column(part, "_id").take(pa.array(own)), pa.array(labels[own]), pa.array(other, pa.binary())], ["_id", "label", "other"])

        kind = self.rows.schema["_id"].dataType.simpleString()
        rows = self.rows.mapInArrow(run, f"_id {kind}, label long, other binary")
        found = rows.orderBy(F.xxhash64("_id"), "_id").limit(TAUGHT).select("label", "other").toArrow()
        other = [np.frombuffer(b, dtype="<f8") for b in found["other"].to_pylist()]
        return (np.stack(other) if other else np.zeros((0, 0))), found["label"].to_numpy()


def co_train(
    text: np.ndarray, meta: np.ndarray, labels: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS, pool: LocalPool | TablePool | None = None
) -> Model:
    """Views of the same rows; labels 0, 1, or -1 for the pool, if none is given. Labelled rows whose fold is 0, a fifth, are kept for the calibration."""
    known = labels >= 0
    held, learn = np.flatnonzero(known & (fold == 0)), np.flatnonzero(known & (fold > 0))
    good = labels[known].mean() if known.any() else 1.0
    prior = math.log((good * known.sum() + 1) / ((1 - good) * known.sum() + 1))
    if min(np.bincount(labels[learn], minlength=2)[:2]) < 2 or min(np.bincount(labels[held], minlength=2)[:2]) < 2:
        return Model(prior)
    pool = pool or LocalPool(text[~known], meta[~known])
    views, lessons = (text, meta), []
    more: tuple[list, list] = ([], [])  # what each view has been taught, round by round

    def fitted(k: int) -> Logistic:
        x = np.concatenate([views[k][learn], *[own for own, _ in more[k] if len(own)]])
        return Logistic().fit(x, np.concatenate([labels[learn], *[own for _, own in more[k]]]).astype(float))

    for _ in range(rounds):
        for k in (0, 1):
            if not pool.size:
                continue
            view = fitted(k)
            counts = pool.counts(lessons, k, view)
            if not counts.sum():
                continue
            # As many of either kind as the labelled rows have, to a bin, if the view is on that side about them.
            low, high = (max(1, round(SURE * pool.size * share)) for share in (1 - good, good))
            below = min(int(np.searchsorted(np.cumsum(counts), low)) + 1, BINS // 2)
            above = max(BINS - 2 - int(np.searchsorted(np.cumsum(counts[::-1]), high)), BINS // 2 - 1)
            lesson = Lesson(k, view, below, above)
            more[1 - k].append(pool.taught(lessons, lesson))
            lessons.append(lesson)
    model = Model(prior, fitted(0), fitted(1))
    for view, x in ((model.text, text), (model.meta, meta)):
        view.calibrate(x[held], labels[held].astype(float))
    return model


def spare_rows(rows: DataFrame) -> DataFrame:
    """Of rows (_id, _hash, _row) all but one of each id, that with the least hash stays: (_row) of the others."""
    least = rows.groupBy("_id").agg(F.min(F.struct("_hash", "_row")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.select("_id", "_row").join(least, "_id").where("_row <> least._row").select("_row")


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", columns: tuple[str, ...] = META) -> Model:
    """A model from at most LABELLED labelled documents and all others, one row of each id. Labels that are null or not 0 or 1 don't count; of several the lowest does.

    Rows are written once as small whole numbers, about half a KB each. Which of them are spare or labelled is found from their ids alone, and the pool is what is left.
    """
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_id IS NOT NULL AND _label IN (0, 1)")
    own = table_of(own.groupBy("_id").agg(F.min("_label").alias("_label")), "labels-known")
    held = [c for c in columns if c in df.columns]
    meta = {c: f"_meta{k}" for k, c in enumerate(held)}  # the id or the text may be metadata too
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(m) for c, m in meta.items()]).where("_id IS NOT NULL")
    rows = rows.withColumns({"_hash": F.xxhash64("_text", *meta.values()), "_row": F.monotonically_increasing_id()})
    kept = ["_id", "_hash", "_row", *meta.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, "_text", CHUNK):
                grams, totals = gram_counts(texts)
                dense = [row.tobytes() for row in dense_features(texts).astype("<f8")]
                packed = [pa.array(dense, pa.binary()), pa.array([packed_counts(row) for row in grams], pa.binary()), pa.array(totals)]
                yield pa.RecordBatch.from_arrays([*[column(part, n) for n in kept], *packed], [*kept, "dense", "grams", "n_grams"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    every = table_of(rows.mapInArrow(run, f"{kinds}, {STORED}"), "features")
    slim = every.select("_id", "_hash", "_row")
    spare = table_of(spare_rows(slim), "spare")
    single = slim.select("_id", "_row").join(spare, "_row", "left_anti")
    labelled = table_of(single.join(own, "_id").select("_row", "_id", "_label"), "labelled")
    chosen = F.broadcast(labelled.orderBy(F.xxhash64("_id"), "_id").limit(LABELLED).select("_row", "_label"))  # LABELLED rows at most
    named = [F.col(m).alias(c) for c, m in meta.items()]
    stored = ["dense", "grams", "n_grams"]
    found = every.join(chosen, "_row").select("_label", F.col("_id").alias("_own"), *stored, *named).toArrow()
    if not found.num_rows:
        return Model(math.log(1.0), columns=columns)
    ids = np.array([zlib.crc32(str(i).encode()) for i in found["_own"].to_pylist()])
    text, seen = arrays_of(found, columns)
    out = spare.unionByName(labelled.select("_row")).hint("merge")  # grows with the labels, so it is never broadcast
    pool = TablePool(table_of(every.join(out, "_row", "left_anti").select("_id", *stored, *named), "pool"), columns)
    # Rows come in any order: they are put in one, so that the model is the same each time.
    order = np.lexsort((text[:, 0], ids))
    model = co_train(text[order], seen[order], found["_label"].to_numpy()[order].astype(int), ids[order] % 5, pool=pool)
    model.columns = columns
    return model


def with_quality(df: DataFrame, model: Model, text_col: str = "text", name: str = "p_quality") -> DataFrame:
    """All rows and columns, and the probability of good quality. A null text is scored as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, text_col, CHUNK):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(part, texts))], [*part.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, DoubleType())]))


def score_all(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, p_quality and kept. Null ids and equal rows are kept; without enough labels of both kinds all rows have the prior."""
    model = fit(df, labels, id_col, text_col)
    needed = list(dict.fromkeys([id_col, text_col, *[c for c in META if c in df.columns]]))
    scored = with_quality(df.select(*needed), model, text_col)
    return scored.select(id_col, "p_quality", (F.col("p_quality") >= KEPT_FROM).alias("kept"))


def kept_rows(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with all their columns whose probability of good quality is KEPT_FROM or more."""
    name = free_name(df, "p_quality")
    return with_quality(df, model, text_col, name).where(F.col(name) >= KEPT_FROM).select(*df.columns)
