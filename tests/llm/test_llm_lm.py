import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import documents, empty, lower, words

from arrivalmart.llm import eliasfano, lm

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("n", "most"), [(0, 1), (1, 1), (1, 10**12), (5, 3), (1000, 50), (1000, 1000), (5000, 10**7), (300, 2**62), (20_000, 10**6)])
def test_elias_fano(tmp_path, n, most):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, most, n).astype(np.uint64))
    uri = f"file://{tmp_path}/x/levels.bin"
    eliasfano.write_arrays(uri, eliasfano.EliasFano.arrays(values, "own"))
    found = eliasfano.EliasFano(eliasfano.read_arrays(uri), "own")
    assert (found.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, draw.integers(0, most + 5, 500).astype(np.uint64), np.array([0, most, most + 99], dtype=np.uint64)])
    at, equal = found.successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


class Plain:
    """The same model over dictionaries, its probabilities not quantised."""

    def __init__(self, texts):
        self.uni, self.two, self.three = Counter(), Counter(), Counter()
        for t in texts:
            own = [*words(lower(t)), lm.END]
            self.uni.update(own)
            self.two.update(zip(own, own[1:]))
            self.three.update(zip(own, own[1:], own[2:]))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.left2, self.left3 = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
        for (u, _), c in self.two.items():
            self.left2[u] -= (c - lm.DISCOUNT) / self.uni[u]
        for (u, v, _), c in self.three.items():
            self.left3[u, v] -= (c - lm.DISCOUNT) / self.two[u, v]

    def p(self, w, v=None, u=None):
        p = (self.uni[w] + 0.5) / (self.n + 0.5 * (self.v + 1))
        if v is not None:
            c = self.two[v, w]
            p = (c - lm.DISCOUNT if c else 0) / max(self.uni[v], 1) + self.left2[v] * p
        if u is not None and self.two[u, v]:
            c = self.three[u, v, w]
            p = (c - lm.DISCOUNT if c else 0) / self.two[u, v] + self.left3[u, v] * p
        return p

    def score(self, text):
        own = [*words(lower(text)), lm.END]
        before = [None, None, *own]
        return sum(math.log10(self.p(w, before[k + 1], before[k])) for k, w in enumerate(own))

    def base(self, text):
        return sum(math.log10(self.p(w)) for w in [*words(lower(text)), lm.END])


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def check(docs):
    rows = docs.collect()
    model = Plain([r.text for r in rows if not held(r.doc_id)])
    found = sorted(map(tuple, lm.score_held_out(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=str)
    expected = []
    for r in rows:
        own = [*words(lower(r.text)), lm.END]
        expected.append((r.doc_id, held(r.doc_id), len(own), sum(model.uni[w] > 0 for w in own), model.n, model.base(r.text), model.score(r.text)))
    for got, want in zip(found, sorted(expected, key=str), strict=True):
        assert got[:5] == want[:5]
        assert got[5] == pytest.approx(want[5], rel=1e-9, abs=1e-9)
        # Each token's probability is quantised downwards, by a step of the logarithm at most.
        assert want[6] - got[2] / lm.STEPS - 1e-6 <= got[6] <= want[6] + 1e-6
    return model


def test_rows_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(lm, "PER_RANGE", 50)
    monkeypatch.setattr(lm, "PER_PART", 500)
    check(documents(spark))


def test_documents_and_that_probabilities_sum_to_one(spark):
    model = check(spark.read.parquet(f"{SF}/documents.parquet"))
    unknown = 1  # the words that the corpus lacks share one place
    for v, u in ((None, None), ("the", None), ("of", "of"), *[(b, a) for (a, b), c in model.two.items() if c > 2][:5]):
        assert sum(model.p(w, v, u) for w in model.uni) + unknown * model.p("no such word", v, u) == pytest.approx(1)


def test_the_model_beats_the_base_on_held_out_documents(spark):
    scored = lm.score_held_out(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    assert scored.selectExpr("sum(score) > 0.97 * sum(base_score)").first()[0]


def test_a_passage_of_one_training_document_is_known(spark):
    """Its pairs and triples are seen once each; a held-out copy is scored by them, not by the frequencies of its words."""
    passage = " ".join(f"w{k}" for k in range(200))
    train, copy = next(k for k in range(99) if not held(k)), next(k for k in range(99) if held(k))
    rows = [(train, passage), (copy, passage), *[(k, "other words here") for k in range(100, 140) if not held(k)]]
    found = {r.doc_id: r for r in lm.score_held_out(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # After its first word, each has a quarter of its pair's count and more: D is 3/4.
    assert found[copy].score > 200 * np.log10(1 / 4) + found[copy].base_score / 200
    assert found[copy].base_score < 1.2 * found[copy].score


def test_no_rows_and_nothing_to_learn_from(spark):
    assert lm.score_held_out(empty(spark)).count() == 0
    only = spark.createDataFrame([(k, "a b") for k in range(40) if held(k)], "doc_id long, text string")
    first = lm.score_held_out(only).first()
    assert (first.train_tokens, first.n_known, first.base_score, first.score) == (0, 0, 0.0, 0.0)


def test_blocks_pack_and_unpack():
    arrays = [np.arange(5), np.zeros(0, dtype=int), np.array([2**32 - 1, 0])]
    assert [a.tolist() for a in lm.unpack(lm.pack(*arrays), 3)] == [a.tolist() for a in arrays]


def test_lookups_in_a_part_go_forward(monkeypatch):
    rng = np.random.default_rng(3)
    part = rng.integers(0, 9, 500)
    order = lm.by_part(part)
    assert (np.diff(part[order]) >= 0).all() and all((np.diff(order[part[order] == k]) > 0).all() for k in range(9))
    assert (lm.by_part(part + (1 << 16)) == order).all() and not len(lm.by_part(part[:0]))
    steps = rng.integers(0, 1 << 16, 100).astype(np.uint16)
    assert (lm.restored(steps) == 10.0 ** (steps.astype(np.float64) / -lm.STEPS)).all()


def test_third_words_are_asked_by_pair(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 12, 60)) for _ in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    layout, seen, found = lm.learn(docs), [], lm.Part.triples
    monkeypatch.setattr(lm.Part, "triples", lambda part, pair, w: seen.append(pair) or found(part, pair, w))
    lm.score_texts(*lm.tokens_of(pa.array(texts)), layout)
    assert seen and all((np.diff(places) >= 0).all() for places in seen)
