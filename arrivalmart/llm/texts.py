"""Small helpers over Arrow columns of text, and over work tables in the shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from arrivalmart.sources.workspace import kept, new_folder


def table_of(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back, which cuts the lineage.

    Whatever reads it later survives the loss of an executor without running the plan behind it again.
    """
    return kept(df, new_folder(df.sparkSession, name))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one made from it, that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with null as empty."""
    texts = column(batch, name)
    return pc.fill_null(texts, "") if texts.null_count else texts


def give_back() -> None:
    """Return memory that is no longer used to the system: a worker lives on after its task, beside those of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def parts_of(batch: pa.RecordBatch, text: str, most: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch with their texts, about `most` bytes of text each, or one row, so that what is made of them is bounded."""
    texts = texts_of(batch, text)
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(ends // most)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
        yield batch.slice(a, b - a), texts.slice(a, b - a)
    give_back()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and where each text's words begin; one more offset at the end."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    offsets = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    # White space at either end gives empty strings, which are no words.
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        before = np.zeros(len(full) + 1, dtype=np.int64)
        np.cumsum(full, out=before[1:])
        offsets, words = before[offsets], words.filter(pa.array(full))
    return words, offsets


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words as codes into their distinct values, those values, and the offsets of the texts."""
    words, offsets = words_of(texts)
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, offsets


def spread_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins among them, with the end."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, (offsets - offsets[0]).astype(np.int64)
