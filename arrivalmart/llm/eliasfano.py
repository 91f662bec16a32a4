"""Monotone sequences in compressed form, and files of arrays that are read by memory mapping."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np
from pyarrow import fs

# The place of the r-th set bit of a byte.
_PLACES = np.zeros((256, 8), dtype=np.int64)
for _byte in range(256):
    _set = [k for k in range(8) if _byte >> k & 1]
    _PLACES[_byte, : len(_set)] = _set
# Ones, high bits, and the lower half of every two, four and eight bits, in all bytes of a word.
_ONE, _HIGH, _HALF2, _HALF4, _HALF8 = (np.uint64(x * 0x0101010101010101) for x in (0x01, 0x80, 0x55, 0x33, 0x0F))


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of named arrays. It appears whole or not at all, so a task may be run again at any time."""
    files, path = fs.FileSystem.from_uri(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    at, entries = 0, {}
    for name, array in arrays.items():
        entries[name] = (array.dtype.str, len(array), at)
        at += -(-array.nbytes // 8) * 8
    head = json.dumps(entries).encode()
    head += b" " * (-len(head) % 8)
    part = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(np.uint64(len(head)).tobytes() + head)
        for array in arrays.values():
            out.write(array.tobytes() + b"\0" * (-array.nbytes % 8))
    files.move(part, path)


def read_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory where the folder is mounted; else read from its store."""
    files, path = fs.FileSystem.from_uri(uri)
    if isinstance(files, fs.LocalFileSystem):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
    else:
        with files.open_input_file(path) as file:
            raw = np.frombuffer(file.read_buffer(), dtype=np.uint8)
    head = int(raw[:8].view(np.uint64)[0])
    found = {}
    for name, (kind, length, at) in json.loads(raw[8 : 8 + head].tobytes()).items():
        begin = 8 + head + at
        found[name] = raw[begin : begin + length * np.dtype(kind).itemsize].view(kind)
    return found


def _select(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """The place of the nth set bit, from 0, in each 64-bit word; all bytes of a word are counted at once."""
    one, two, four, eight = (np.uint64(k) for k in (1, 2, 4, 8))
    nth = nth.astype(np.uint64)
    sums = words - (words >> one & _HALF2)
    sums = (sums & _HALF4) + (sums >> two & _HALF4)
    sums = (sums + (sums >> four) & _HALF8) * _ONE  # set bits up to and with each byte
    byte = np.bitwise_count((nth * _ONE | _HIGH) - sums & _HIGH).astype(np.uint64)  # bytes whose sum is nth or less
    shift = byte * eight
    before = sums << eight >> shift & np.uint64(0xFF)
    return (shift + _PLACES[(words >> shift & np.uint64(0xFF)).astype(np.int64), (nth - before).astype(np.int64)].astype(np.uint64)).astype(np.int64)


class EliasFano:
    """A monotone sequence of numbers below 2**63: low bits as they are, high bits as gaps in unary."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.head = arrays[f"{name}.head"]
        self.n, self.width = int(self.head[0]), int(self.head[1])
        self.low, self.high, self.ones = (arrays[f"{name}.{part}"] for part in ("low", "high", "ones"))

    @staticmethod
    def arrays(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        most = int(values[-1]) if n else 0
        width = max(0, (most // max(n, 1)).bit_length() - 1)
        shift = np.uint64(width)
        at = (values >> shift).astype(np.int64) + np.arange(n)
        size = (most >> width) + n + 1  # a zero ends every run
        words = -(-size // 64) + 2
        high = np.zeros(words * 8, dtype=np.uint8)
        if n:
            byte, bit = at // 8, np.left_shift(np.uint8(1), (at % 8).astype(np.uint8))
            firsts = np.flatnonzero(np.concatenate(([True], byte[1:] != byte[:-1])))
            high[byte[firsts]] = np.bitwise_or.reduceat(bit, firsts)
        high = high.view(np.uint64)
        ones = np.zeros(words + 1, dtype=np.uint64)
        np.cumsum(np.bitwise_count(high), out=ones[1:])
        low = np.zeros(-(-n * width // 64) + 2, dtype=np.uint64)
        if width:
            own = values & np.uint64((1 << width) - 1)
            begin = np.arange(n, dtype=np.uint64) * shift
            word, bit = (begin // np.uint64(64)).astype(np.int64), begin % np.uint64(64)
            firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            low[word[firsts]] = np.bitwise_or.reduceat(own << bit, firsts)
            over = np.flatnonzero(bit + shift > 64)  # at most one number of a word reaches into the next
            low[word[over] + 1] |= own[over] >> (np.uint64(64) - bit[over])
        head = np.array([n, width, words], dtype=np.uint64)
        return {f"{name}.head": head, f"{name}.low": low, f"{name}.high": high, f"{name}.ones": ones}

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), dtype=np.uint64)
        begin = at.astype(np.uint64) * np.uint64(self.width)
        word, bit = (begin >> np.uint64(6)).astype(np.int64), begin & np.uint64(63)
        # A shift by 64 has no meaning, so the next word is shifted in two steps.
        value = self.low[word] >> bit | self.low[word + 1] << np.uint64(1) << (np.uint64(63) - bit)
        return value & np.uint64((1 << self.width) - 1)

    def _zero(self, nth: np.ndarray) -> np.ndarray:
        """The place of the nth zero of the high bits."""
        zeros = self._zeros
        word = np.searchsorted(zeros, nth, side="right") - 1
        return word * 64 + _select(~self.high[word], nth - zeros[word])

    @property
    def _zeros(self) -> np.ndarray:
        if not hasattr(self, "_zero_counts"):
            self._zero_counts = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)
        return self._zero_counts

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at some places."""
        at = np.asarray(at, dtype=np.int64)
        if not len(at):
            return np.zeros(0, dtype=np.uint64)
        ones = self.ones.view(np.int64)
        word = np.searchsorted(ones, at, side="right") - 1
        place = word * 64 + _select(self.high[word], at - ones[word])
        return (place - at).astype(np.uint64) << np.uint64(self.width) | self._low(at)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first number that is not below each value, and whether it equals it."""
        values = np.asarray(values, dtype=np.uint64)
        found, equal = np.full(len(values), self.n, dtype=np.int64), np.zeros(len(values), dtype=bool)
        if not self.n or not len(values):
            return found, equal
        runs = int(self._zeros[-1]) - 1
        high = (values >> np.uint64(self.width)).astype(np.int64)
        inside = np.flatnonzero(high < runs)
        h = high[inside]
        begin = np.where(h > 0, self._zero(np.maximum(h - 1, 0)) + 1 - h, 0)
        end = begin + self._run(begin + h, h)
        want = values[inside] & np.uint64((1 << self.width) - 1)
        # A binary search among the low bits of the run that has these high bits.
        lower, upper = begin.copy(), end.copy()
        open_ = np.flatnonzero(lower < upper)
        while len(open_):
            middle = (lower[open_] + upper[open_]) // 2
            less = self._low(middle) < want[open_]
            lower[open_[less]] = middle[less] + 1
            upper[open_[~less]] = middle[~less]
            open_ = open_[lower[open_] < upper[open_]]
        found[inside] = lower
        held = np.flatnonzero(lower < end)
        equal[inside[held]] = self._low(lower[held]) == want[held]
        return found, equal

    def _run(self, place: np.ndarray, h: np.ndarray) -> np.ndarray:
        """How many set bits follow one another from each place of the high bits, where the run of h begins."""
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        window = self.high[word] >> bit | self.high[word + 1] << np.uint64(1) << (np.uint64(63) - bit)
        unset = ~window
        run = np.bitwise_count((unset & (~unset + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        longer = np.flatnonzero(run == 64)
        run[longer] = self._zero(h[longer]) - place[longer]
        return run
