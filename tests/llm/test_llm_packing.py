from collections import Counter, defaultdict

import public_tokenizers
import pytest
from brute import documents, empty, pieces
from tokenizers import Tokenizer

from arrivalmart.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("histogram", [{}, {2048: 3}, {1: 5000}, {1000: 7, 1100: 2, 5: 9}, {k: k % 7 for k in range(1, 2049)}, {1024: 10**12, 3: 10**9}])
def test_a_plan_places_every_rank_once_and_fills_no_sequence_twice(histogram):
    histogram = {k: n for k, n in histogram.items() if n}
    plan = packing.plan_places(histogram)
    ranks = defaultdict(list)
    for length, a, b, _, _ in plan:
        ranks[length].append((a, b))
    for length, n in histogram.items():
        own = sorted(ranks[length])
        assert own[0][0] == 0 and own[-1][1] == n and all(x[1] == y[0] for x, y in zip(own, own[1:], strict=False))
    if sum(histogram.values()) < 10**5:
        room = defaultdict(list)
        for length, a, b, first, offset in plan:
            for k in range(b - a):
                room[first + k].append((offset, length))
        for own in room.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= packing.ROOM
    assert len(plan) < 20_000


def test_every_id_lies_in_one_place(spark):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    docs = documents(spark)
    found = packing.pack(docs, PATH).collect()
    expected = Counter()
    for r in docs.collect():
        expected.update((r.doc_id, *p) for p in pieces(library.encode(r.text or "", add_special_tokens=False).ids))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == expected
    at = defaultdict(int)
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 2048 and sorted(at) == list(range(len(at)))
    assert packing.pack(empty(spark), PATH).count() == 0


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = packing.pack(docs, PATH).groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert (2048 - sums).sum() < 0.01 * sums.sum()
