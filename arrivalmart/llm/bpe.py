"""BPE encoding and decoding by an index from each pair of symbols to all its positions.

The words of a batch are pooled: every distinct piece of text between two separators is laid out once in
one long list of symbols, a pair occurrence index maps each adjacent pair that has a merge rank to all its
positions in that list, and the active ranks are applied in ascending order to all pieces at once. A merge
touches the two pairs beside it, so only their lists change. The ids of a text are then gathered from
those of its pieces. A vocabulary is read from a file of the tokenizers library; nothing is trained.

Whole texts are encoded: no normalisation or pattern of the vocabulary reaches over white space, so the
ids of a text are those of its words, one after the other.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from arrivalmart.llm.texts import bytes_of, coded_words, column, parts_of, spread_ranges

# Above every symbol, so that two symbols make one number; and a rank above every rank.
BASE = 1 << 20
NO_RANK = 1 << 40
LETTER, DIGIT, OTHER = 1, 2, 3


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = {b: chr(b) for b in printing}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Symbols, merges, separators and special strings of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in said["added_tokens"]}
        by_id = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.symbols = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        # A pair of symbols as one number, sorted, with its rank; looked up for whole arrays at once.
        pairs = np.array([self.ids[a] * BASE + self.ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pair_keys, self.pair_ranks = pairs[order], order
        self.left, self.right = pairs // BASE, pairs % BASE
        self.merged = np.array([self.ids[a + b] for a, b in merges], dtype=np.int32)
        # Kinds of bytes of a lower-case word that is cut without the pattern: letters, digits, other signs.
        self.kinds = np.full(256, OTHER, dtype=np.uint8)
        self.kinds[[*range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = LETTER
        self.kinds[0x30:0x3A] = DIGIT
        self.first = np.array([self.ids[x] for x in byte_letters()], dtype=np.int32)
        self.last = np.array([self.ids[x + end] for x in byte_letters()], dtype=np.int32)
        self.lower = any(s["type"] == "Lowercase" for s in said["normalizer"]["normalizers"])
        # The library's own tables of Unicode: Python's are of another version.
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of symbols, NO_RANK where they don't merge."""
        keys = left.astype(np.int64) * BASE + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def cut_by_library(self, text: str) -> list[str]:
        """The pieces of one word or part of a word without special strings."""
        normal = self.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces_of(self, words: list[str]) -> list[str]:
        """The pieces of all words that are merged on their own, a newline after each word.

        A special string is one piece; no other piece equals it, since it holds letters and signs.
        """
        found: list[str] = []
        for word in words:
            if self.cut is None or "<" not in word or not self.cut.search(word):
                found += self.cut_by_library(word)
            else:
                for part in self.cut.split(word):
                    found += [part] if part in self.special else self.cut_by_library(part) if part else []
            found.append("\n")
        return found

    def plain(self, words: pa.StringArray) -> np.ndarray:
        """Which words are of ASCII and Latin-1 letters, digits and signs, without those that begin a special string or 's."""
        data, offsets = bytes_of(words)
        lead = np.concatenate(([0], data[:-1]))
        odd = (data == 0x27) | (data == 0x3C) | (data == 0xC3) & (np.concatenate((data[1:], [0])) < 0x80)
        odd |= (data >= 0x80) & (data != 0xC3) & ((lead != 0xC3) | (data == 0x97) | (data == 0xB7))
        before = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(odd, out=before[1:])
        return before[offsets[1:]] == before[offsets[:-1]]

    def cut_plain(self, words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """The pieces of plain words, and the number of each one's word: runs of letters, digits one by one, runs of signs."""
        data, offsets = bytes_of(pc.utf8_lower(words) if self.lower else words)
        kinds = self.kinds[data]
        begins = np.concatenate(([True], kinds[1:] != kinds[:-1])) | (kinds == DIGIT) if len(data) else np.zeros(0, dtype=bool)
        begins[offsets[:-1]] = True
        at = np.flatnonzero(begins)
        word = np.searchsorted(offsets, at, side="right") - 1
        ends = np.append(at, len(data)).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data)), word


class PairIndex:
    """All positions of every pair that has a rank, over the symbols of many pieces laid end to end."""

    def __init__(self, symbols: np.ndarray, begins: np.ndarray, vocabulary: Vocabulary):
        size = len(symbols)
        self.vocabulary, self.symbols, self.begins = vocabulary, symbols, begins
        self.after = np.arange(1, size + 1, dtype=np.int64)  # the next symbol in the piece, -1 at its end
        self.before = np.arange(-1, size - 1, dtype=np.int64)
        self.after[begins[1:] - 1] = -1
        self.before[begins[:-1]] = -1
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.redo: list[np.ndarray] = []
        inside = np.flatnonzero(self.after >= 0)
        self._add(vocabulary.ranks_of(symbols[inside], symbols[inside + 1]), inside)

    def _add(self, ranks: np.ndarray, at: np.ndarray) -> None:
        """Put positions into the lists of their ranks; a rank with a new list becomes active."""
        has = ranks < NO_RANK
        if not has.all():
            ranks, at = ranks[has], at[has]
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            groups = zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True)
        else:
            groups = zip(ranks.tolist(), [at] * len(ranks), strict=True)
        for rank, own in groups:
            if rank in self.lists:
                self.lists[rank].append(own)
            else:
                self.lists[rank] = [own]
                heapq.heappush(self.active, rank)

    def run(self) -> None:
        while self.active:
            rank = heapq.heappop(self.active)
            self._apply(rank, self.lists.pop(rank))

    def _apply(self, rank: int, found: list[np.ndarray]) -> None:
        """Merge every position that still holds the pair, and list the pairs beside it anew."""
        voc, symbols, after, before = self.vocabulary, self.symbols, self.after, self.before
        left, right, whole = int(voc.left[rank]), int(voc.right[rank]), voc.merged[rank]
        at = found[0] if len(found) == 1 else np.concatenate(found)
        then = after[at]
        good = (then >= 0) & (symbols[at] == left) & (symbols[then] == right)
        if not good.all():
            at, then = at[good], then[good]
        if not len(at):
            return
        if len(found) > 1 or left == right:
            at = np.unique(at)
            then = after[at]
        if left == right and len(at) > 1:
            # Of a run of overlapping pairs every other one is merged, from the left.
            chained = np.concatenate(([False], then[:-1] == at[1:]))
            place = np.arange(len(at))
            start = np.maximum.accumulate(np.where(chained, 0, place))
            keep = (place - start) % 2 == 0
            at, then = at[keep], then[keep]
        follow = after[then]
        symbols[at], symbols[then], after[at] = whole, -1, follow
        has = follow >= 0
        before[follow[has]] = at[has]
        ahead = np.full(len(at), NO_RANK)
        ahead[has] = voc.ranks_of(symbols[at[has]], symbols[follow[has]])
        back = before[at]
        had = back >= 0
        behind = np.full(len(at), NO_RANK)
        behind[had] = voc.ranks_of(symbols[back[had]], symbols[at[had]])
        if len(at) > 1:
            lower = np.minimum(ahead, behind) < rank
            if (voc.ranks_of(np.array([whole]), np.array([left])) < rank).any():
                lower[:] = True
            if lower.any():
                # A new pair outranks this one before all of the piece's positions are merged: merge that piece alone.
                own = np.searchsorted(self.begins, at, side="right") - 1
                pieces, first, times = np.unique(own, return_index=True, return_counts=True)
                self.redo.append(pieces[(times > 1) & np.logical_or.reduceat(lower, first)])
        self._add(np.concatenate((ahead, behind)), np.concatenate((at, back)))


def merge_alone(raw: bytes, vocabulary: Vocabulary) -> list[int]:
    """One piece, one merge at a time: the lowest rank, and of its positions the leftmost."""
    symbols = [int(vocabulary.first[b]) for b in raw[:-1]] + [int(vocabulary.last[raw[-1]])]
    while len(symbols) > 1:
        ranks = vocabulary.ranks_of(np.array(symbols[:-1]), np.array(symbols[1:]))
        at = int(np.argmin(ranks))
        if ranks[at] >= NO_RANK:
            break
        symbols[at : at + 2] = [int(vocabulary.merged[ranks[at]])]
    return symbols


def merge_all(pieces: pa.StringArray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces in order, and how many each has; all are merged together by one index."""
    if not len(pieces):
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    letters, begins = bytes_of(pieces)
    symbols = vocabulary.first[letters]
    symbols[begins[1:] - 1] = vocabulary.last[letters[begins[1:] - 1]]
    index = PairIndex(symbols, begins, vocabulary)
    index.run()
    alive = symbols >= 0
    special = np.flatnonzero(pc.is_in(pieces, pa.array(list(vocabulary.special), pa.string())).to_numpy(zero_copy_only=False))
    for n in sorted({*special.tolist(), *(np.concatenate(index.redo).tolist() if index.redo else ())}):
        piece = pieces[n].as_py()
        ids = [vocabulary.special[piece]] if piece in vocabulary.special else merge_alone(piece.encode(), vocabulary)
        a, b = begins[n], begins[n + 1]
        alive[a:b] = np.arange(b - a) < len(ids)
        symbols[a : a + len(ids)] = ids
    return symbols[alive], np.add.reduceat(alive, begins[:-1], dtype=np.int64)


class Coder:
    """Ids of whole columns of texts."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)

    def _words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words, and where each word's begin and how many it has."""
        plain = self.vocabulary.plain(words)
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        pieces, word = self.vocabulary.cut_plain(words.filter(pa.array(plain)))
        cut = pa.array(self.vocabulary.pieces_of(words.filter(pa.array(~plain)).to_pylist()), pa.string())
        ends = pc.equal(cut, "\n").to_numpy(zero_copy_only=False)
        own = (np.cumsum(ends) - ends)[~ends] + int(plain.sum())
        coded = pa.concat_arrays([pieces, cut.filter(pa.array(~ends))]).dictionary_encode()
        flat, lengths = merge_all(coded.dictionary, self.vocabulary)
        codes = coded.indices.to_numpy()
        each = lengths[codes]
        ids = flat[spread_ranges((np.cumsum(lengths) - lengths)[codes], each)]
        per_word = np.bincount(np.concatenate((word, own)), weights=each, minlength=len(words)).astype(np.int64)
        starts, counts = np.empty(len(words), dtype=np.int64), np.empty(len(words), dtype=np.int64)
        starts[order], counts[order] = np.cumsum(per_word) - per_word, per_word
        return ids, starts, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in order, and where each text's ids begin, with the end."""
        codes, distinct, offsets = coded_words(texts)
        flat, starts, lengths = self._words(distinct)
        each = lengths[codes]
        ends = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(each, out=ends[1:])
        return flat[spread_ranges(starts[codes], each)].astype(np.uint32), ends[offsets]


_CODERS: dict[str, Coder] = {}


def coder_of(path: str) -> Coder:
    """One coder for each Python worker, kept from batch to batch."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The symbols joined by spaces, which is how a vocabulary without a decoder is decoded."""
    symbols = vocabulary.symbols
    return " ".join([symbols[i] for i in ids.tolist()])


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every row: id, ids array<int>, decoded.

    A null text is empty, an empty text has no ids and decodes to an empty one. Rows are not moved; equal rows and null ids are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for batch in batches:
            for part, texts in parts_of(batch, text_col):
                flat, offsets = coder.encode(texts)
                decoded = [decode(flat[a:b], coder.vocabulary) for a, b in zip(offsets, offsets[1:], strict=False)]
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([column(part, id_col), ids, pa.array(decoded, pa.string())], [id_col, "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digest_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As encode_texts, with digests in place of ids and text, which then never leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for batch in batches:
            for part, texts in parts_of(batch, text_col):
                flat, offsets = coder.encode(texts)
                each = [flat[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, id_col),
                        pa.array(np.diff(offsets)),
                        pa.array([hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in each], pa.string()),
                        pa.array([hashlib.sha256(decode(ids, coder.vocabulary).encode()).hexdigest() for ids in each], pa.string()),
                    ],
                    [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
