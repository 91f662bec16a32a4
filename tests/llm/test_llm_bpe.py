import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import ODD_TEXTS, documents, empty, sha
from tokenizers import Tokenizer

from arrivalmart.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_padding()
    found.no_truncation()
    return found


def test_ids_equal_the_library(library):
    draw = random.Random(5)
    signs = "aAbBeEtThHiInNrRsS '´`<|>.!?0 9éÉüñß日́  ×÷Σσςİ\n\t😀\x1c\x85ŉﬁ¼Ⅷ²"
    texts = [t or "" for t in ODD_TEXTS] + ["".join(draw.choice(signs) for _ in range(draw.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(draw.choice("etaoinshrdlu ") for _ in range(80)) for _ in range(500)] + ["a" * 3000, "ab" * 2000]
    flat, offsets = bpe.coder_of(PATH).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert flat[offsets[k] : offsets[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("plane", range(17))
def test_every_code_point_equals_the_library(library, plane):
    """Each alone, after and before a letter, and between a letter and a mark; lone surrogates are no text."""
    coder = bpe.coder_of(PATH)
    for begin in range(plane << 16, (plane + 1) << 16, 1 << 13):
        signs = [chr(c) for c in range(begin, begin + (1 << 13)) if not 0xD800 <= c < 0xE000]
        texts = [" ".join((c, f"a{c}", f"{c}a", f"a{c}\u0301")) for c in signs]
        flat, offsets = coder.encode(pa.array(texts, pa.string()))
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        wrong = [hex(ord(c)) for k, c in enumerate(signs) if flat[offsets[k] : offsets[k + 1]].tolist() != expected[k]]
        assert not wrong


def test_pieces_merged_together_equal_pieces_merged_alone():
    draw = random.Random(1)
    voc = bpe.Vocabulary(PATH)
    pieces = ["".join(draw.choice("thenaing") for _ in range(draw.randint(1, 30))) for _ in range(800)]
    flat, lengths = bpe.merge_all(pa.array(pieces, pa.string()), voc)
    ends = np.cumsum(lengths)
    for piece, end, n in zip(pieces, ends, lengths, strict=True):
        assert flat[end - n : end].tolist() == bpe.merge_alone(piece.encode(), voc)


def test_rows_of_every_kind(spark, library):
    docs = documents(spark)
    got = sorted(map(tuple, bpe.digest_texts(docs, PATH).collect()), key=str)
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((r.doc_id, len(ids), __import__("hashlib").sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha(decoded)))
    assert got == sorted(expected, key=str)
    whole = {r.doc_id: r for r in bpe.encode_texts(docs, PATH).where("doc_id IN (1, 5, 13)").collect()}
    for k, r in whole.items():
        assert r.ids == library.encode(ODD_TEXTS[k], add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert bpe.digest_texts(empty(spark), PATH).count() == 0
