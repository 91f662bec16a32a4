import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from brute import ODD_TEXTS, documents, empty, sha, words

from arrivalmart.llm import periodic, queries


def plain_runs(own):
    """All runs by trying every period over the whole document."""
    found, n = {}, len(own)
    for q in range(1, n // 4 + 1):
        start = 0
        for i in range(n - q + 1):
            if i == n - q or own[i] != own[i + q]:
                length = i - start + q
                if i > start and length >= max(6, 4 * q):
                    # A stretch of a smaller period is found under that one.
                    if not any(all(own[x] == own[x + d] for x in range(start, start + length - d)) for d in range(1, q)):
                        found[start, q] = length
                start = i + 1
    return [(s, length, q) for (s, q), length in sorted(found.items())]


def plain_replaced(doc_id, own):
    if doc_id is None or not own:
        return own
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return own
    g, n = h // 10, len(own)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    own = plain_replaced(doc_id, words(text))
    runs = plain_runs(own)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(own) if i not in dropped)),
    )


def runs_of(*docs):
    """Runs of documents of small numbers, as the operator finds them in one go."""
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
    start, length, period = periodic.find_runs(np.array([w for d in docs for w in d], dtype=np.int64), offsets)
    found = [[] for _ in docs]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        k = int(np.searchsorted(offsets, s, side="right")) - 1
        found[k].append((s - int(offsets[k]), n, q))
    return found


def test_random_words_of_small_alphabets_equal_the_plain_runs():
    for seed in range(400):
        draw = random.Random(seed)
        docs = []
        for _ in range(draw.randint(1, 5)):
            own = [draw.randrange(draw.randint(1, 4)) for _ in range(draw.randint(0, 60))]
            if draw.random() < 0.7:
                unit = [draw.randrange(3) for _ in range(draw.randint(1, 17))]
                at = draw.randint(0, len(own))
                own[at:at] = (unit * 6)[: draw.randint(0, 6 * len(unit))]
            docs.append(own)
        assert runs_of(*docs) == [plain_runs(d) for d in docs], seed


def test_units_whose_short_grams_all_repeat_within_one_period():
    # Every gram of up to 4 words occurs twice in a unit, so its next occurrence is not a period away.
    for unit in ([0, 0, 0, 1, 0, 0, 0, 1, 1], [0, 1] * 9 + [2], [0] * 15 + [1] + [0] * 14 + [1], [0, 1, 1, 0, 1, 0, 0, 1] * 2 + [0]):
        for times in (4, 5, 9):
            own = [7, 8, *(unit * times), 9, 7]
            assert runs_of(own) == [plain_runs(own)]


@pytest.mark.parametrize("own", [[], [1], [1] * 5, [1] * 6, [1] * 7, [1, 2] * 3, [1, 2] * 4, [1, 2, 3] * 4, ([1, 2, 3] * 4)[:-1], [1] * 6 + [2] * 6, [1] * 10_000])
def test_lengths_at_the_border(own):
    assert runs_of(own, own, [*own, 5]) == [plain_runs(own), plain_runs(own), plain_runs([*own, 5])] if len(own) < 100 else runs_of(own) == [[(0, 10_000, 1)]]


def test_no_run_crosses_documents():
    assert runs_of([1, 1, 1], [1, 1, 1], [], [1] * 6, [2, 3] * 2, [2, 3] * 2) == [[], [], [], [(0, 6, 1)], [], []]


def test_rows_equal_the_plain_rows(spark):
    texts = [*ODD_TEXTS[:14], *ODD_TEXTS[15:], "go go go go go go stop", "a b " * 50 + "c " * 7 + "a b " * 50, " ".join(f"w{k % 61}" for k in range(900))]
    texts += [" ".join(random.Random(k).choices("abcdefg", k=80)) for k in range(60)]
    docs = documents(spark, texts)
    found = periodic.digest(periodic.with_runs(docs, plan=periodic.planted)).drop("n_words")
    expected = [plain_row(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found.collect()), key=lambda r: str(key(r))) == sorted(expected, key=lambda r: str(key(r)))
    assert any(r[1] for r in expected) and not all(r[1] for r in expected)


def test_general_form(spark):
    rows = spark.createDataFrame([(1, "x go go go go go go y"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in periodic.with_runs(rows).collect()}
    assert found[1].runs == [(1, 6, 1)] and found[1].strongest == 1 and found[1].collapsed == "x go y" and found[1].n_words == 8
    assert found[2].runs == [] and found[2].strongest is None and found[2].collapsed == ""
    assert periodic.digest(periodic.with_runs(empty(spark))).count() == 0


def test_a_very_long_text_takes_one_pass():
    unit = list(range(5_000))
    own = [9_999, *(unit * 60), 9_998]
    assert runs_of(own) == [[(1, 300_000, 5_000)]]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.QUERIES["op13_periodic_runs"](spark, folder).drop("n_words").collect()
    assert len(found) == len(texts)
    short = [r for r in found if len(words(texts[r.doc_id])) <= 700]
    assert sorted(map(tuple, short)) == sorted(plain_row(r.doc_id, texts[r.doc_id]) for r in short) != []
