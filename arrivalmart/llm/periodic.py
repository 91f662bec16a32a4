"""Periodic runs of words by seed and extend on diagonals.

A run of period q is a maximal stretch of words in which words q apart are identical, q being its smallest period, and which is at least
max(6, 4 q) words long. On the diagonal of lag q it is a stretch of matches of at least 5 words for q = 1 and 3 q words for any other.
Lags are taken by powers of two: those from m to 2 m - 1 are sought with k-grams of k = 3 m words, the least that such a run must overlap
itself by (5 words for lag 1). As k is q or more, a k-gram at the start of a run occurs next exactly q words later, or the run had a
smaller period. So only neighbouring occurrences of a k-gram in a document are paired, never all of them, and the lag of every pair that
is found is the smallest period of the stretch around it.

k-grams are indexed exactly, without hashes: the number of a k-gram follows from the numbers of its two halves, and k-grams that occur
once in their document are left out of all longer ones, which leaves little of ordinary prose. Seeds are extended in both directions on
their diagonal; a table of how far each lag is covered skips the seeds inside a stretch that is already known.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivalmart.llm.texts import coded_words, column, parts_of

LEAST_WORDS = 6
LEAST_PERIODS = 4
CHUNK = 4 << 20  # bytes of text that a task holds as arrays at once, or one text

# From the ids and sizes of documents to (first, period): words from `first` on become the `period` words there, over and over. A period of 0 leaves a document as it is.
Plan = Callable[[list, np.ndarray], tuple[np.ndarray, np.ndarray]]


def as_it_is(ids: list, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """No words are replaced."""
    return np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)


def planted(ids: list, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeats in the documents whose crc32 of the id as text is divisible by 10; a null id has none."""
    first, period = as_it_is(ids, sizes)
    for k, (own, n) in enumerate(zip(ids, sizes.tolist(), strict=True)):
        h = 1 if own is None else zlib.crc32(str(own).encode())
        if h % 10 == 0 and n:
            g = h // 10
            first[k] = g % n
            period[k] = 1 + (n - g % n) // (3 + g % 8)
    return first, period


def replaced(offsets: np.ndarray, first: np.ndarray, period: np.ndarray) -> np.ndarray:
    """For each place the place whose word stands there once the plan is carried out."""
    source = np.arange(offsets[-1])
    for k in np.flatnonzero(period).tolist():
        a, b = offsets[k] + first[k], offsets[k + 1]
        source[a:b] = a + np.arange(b - a) % period[k]
    return source


def _numbered(keys: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers by place of the keys that occur more than once, -1 elsewhere, and the places that have one."""
    _, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[number] > 1
    found = np.full(size, -1, dtype=np.int64)
    found[places[again]] = number[again]
    return found, places[again]


def _joined(left: np.ndarray, places: np.ndarray, right: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the grams at places whose second part begins `step` further, and the places that have both parts.

    Numbers differ between documents. A gram of two parts in two documents stands where the first ends and nowhere else, so it is left out
    as one that occurs once.
    """
    places = places[places + step < len(right)]
    places = places[right[places + step] >= 0]
    return left[places] * np.int64(len(left)) + right[places + step], places


def _neighbours(keys: np.ndarray, places: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of neighbouring occurrences of equal keys whose lag is from low to high; places rise."""
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    lags = np.diff(places)
    own = np.flatnonzero((keys[1:] == keys[:-1]) & (lags >= low) & (lags <= high))
    return places[own], lags[own]


def seeds(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of neighbouring occurrences of the k-grams of each class of lags."""
    size = len(words)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    distinct = int(words.max(initial=0)) + 1
    # Level m: the numbers of m-grams by place, and the places that have one.
    one = _numbered(owner * np.int64(distinct) + words, np.arange(size), size)
    found, m, own = [], 1, one
    while len(own[1]):
        twice = _numbered(*_joined(own[0], own[1], own[0], m), size)
        if m == 1:
            four = _numbered(*_joined(twice[0], twice[1], twice[0], 2), size)
            found.append(_neighbours(*_joined(four[0], four[1], one[0], 4), 1, 1))
        else:
            found.append(_neighbours(*_joined(twice[0], twice[1], own[0], 2 * m), m, 2 * m - 1))
        own, m = twice, 2 * m
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([p for p, _ in found]), np.concatenate([lag for _, lag in found])


def _equal_from(a: np.ndarray, b: np.ndarray) -> int:
    """How many values are equal from the start on, read in steps that double."""
    at, step, most = 0, 32, min(len(a), len(b))
    while at < most:
        differ = a[at : min(at + step, most)] != b[at : min(at + step, most)]
        if differ.any():
            return at + int(np.argmax(differ))
        at, step = min(at + step, most), 2 * step
    return most


def find_runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of documents whose words lie between their offsets, by start, then period."""
    places, lags = seeds(words, offsets)
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    ends = offsets[np.searchsorted(offsets, places, side="right")]
    begins = offsets[np.searchsorted(offsets, places, side="right") - 1]
    runs, at, covered, last = [], 0, -1, 0
    while at < len(places):
        place, lag = int(places[at]), int(lags[at])
        if lag != last:
            covered, last = -1, lag
        if place < covered:
            # Skip to the first seed of this lag beyond what is covered.
            stop = int(np.searchsorted(lags, lag, side="right"))
            at += int(np.searchsorted(places[at:stop], covered))
            continue
        a, b = int(begins[at]), int(ends[at])
        covered = place + _equal_from(words[place : b - lag], words[place + lag : b])
        start = place - _equal_from(words[a:place][::-1], words[a + lag : place + lag][::-1])
        if covered - start + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            runs.append((start, covered - start + lag, lag))
        at += 1
    found = np.array(sorted((s, q, n) for s, n, q in runs), dtype=np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 2], found[:, 1]


def repeats(size: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The places that some run contains after its first period."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:-1]) > 0


def strongest(length: np.ndarray, period: np.ndarray) -> int:
    """Which of the runs, sorted by start and period, repeats most often: greatest exact length / period, the first of equal ones."""
    share = length / period
    near = np.flatnonzero(share >= share.max() * (1 - 1e-12)).tolist()
    return max(near, key=lambda k: (Fraction(int(length[k]), int(period[k])), -k))


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
COLUMNS = "n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, strongest int, collapsed string"


def with_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = as_it_is) -> DataFrame:
    """Every row's id, n_words, its runs by start and period, the position of the strongest one among them, and the collapsed text.

    Runs count in words from 0. strongest counts from 1 and is null without runs. The collapsed text holds, joined by one space, the words that
    no run contains after its first period. Null and empty texts have no words and an empty collapsed text. Null ids and equal rows are kept, each with
    its own runs; other columns are not read; no rows give none. `plan` replaces words before runs are sought.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, text_col, CHUNK):
                ids = column(part, id_col)
                codes, values, offsets = coded_words(texts)
                words = codes[replaced(offsets, *plan(ids.to_pylist(), np.diff(offsets)))]
                start, length, period = find_runs(words, offsets)
                kept = ~repeats(len(words), start, length, period)
                before = np.concatenate(([0], np.cumsum(kept)))
                joined = pa.ListArray.from_arrays(pa.array(before[offsets], pa.int32()), values.take(pa.array(words[kept])))
                cuts = np.searchsorted(start, offsets)
                best = [strongest(length[a:b], period[a:b]) + 1 if a < b else None for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
                local = start - offsets[np.searchsorted(offsets, start, side="right") - 1]
                found = pa.StructArray.from_arrays([pa.array(local), pa.array(length), pa.array(period)], fields=list(RUNS.value_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found),
                        pa.array(best, pa.int32()),
                        pc.binary_join(joined, " "),
                    ],
                    [id_col, "n_words", "runs", "strongest", "collapsed"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {COLUMNS}")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of :func:`with_runs`: n_runs, the strongest run, and the digests of all runs and of the collapsed text."""

    def best(name: str) -> Column:
        return F.element_at("runs", F.col("strongest"))[name]

    line = "concat(r.start, ',', r.length, ',', r.period, '\n')"
    return found.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        *[best(name).alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * element_at(runs, strongest).length DIV element_at(runs, strongest).period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join(transform(runs, r -> {line}), '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
