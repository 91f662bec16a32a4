import math
import random

import numpy as np
import pytest

from arrivalmart.llm import permutation, queries

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank string, v string, ids int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", "y", 3) for i, v in rows], SCHEMA)


def takes_part(i, v):
    return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, k=20):
    good = [(i, np.array(v, dtype=np.float32).astype(float).tolist()) for i, v in rows if takes_part(i, v)]
    asked = {}
    for i, v in good:
        if i % 20 == 0:
            asked.setdefault(i, v)
    found = {}
    for q, w in asked.items():
        own = sorted((-math.fsum(a * b for a, b in zip(w, v, strict=False)), i) for i, v in good if i != q)[:k]
        found[q] = [(i, -s) for s, i in own]
    return found


def run(spark, data, **sizes):
    found = permutation.nearest_rows(table(spark, data), "vec_id % 20 = 0", **sizes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    by_query = {}
    for r in sorted(map(tuple, found.collect())):
        by_query.setdefault(r[0], []).append((r[2], r[3]))
        assert r[1] == len(by_query[r[0]])
    return by_query


def recall(found, expected):
    hit = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in own}) for q, own in expected.items())
    return hit / max(1, sum(map(len, expected.values())))


@pytest.mark.parametrize("sizes", [{}, {"rows": 40, "queries_at_once": 3}])
def test_small_tables_are_searched_whole(spark, sizes):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(8)]) for i in range(170)]
    rows += [(i, [0.25] * 8) for i in range(300, 345)]  # many equal ones, three of them queries
    rows += [(400, None), (401, []), (402, [float("nan")] + [0.0] * 7), (403, [None] + [0.0] * 7), (440, [float("inf")] + [0.0] * 7), (460, [0.0] * 8), (None, [0.1] * 8)]
    rows += [(480, [0.5, 0.5]), (481, [0.5, 0.5, 0.0])]
    assert run(spark, rows, **sizes) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, -1.0])], [(0, [1.0]), (1, [0.5]), (20, [-0.5])], [(5, [1.0])], [(20 * k, [0.0, 0.0]) for k in range(30)], [(k, [0.5, 0.5]) for k in range(90)]])
def test_few_rows_and_ties(spark, rows):
    assert run(spark, rows) == {q: own for q, own in brute(rows).items() if own}


def test_repeated_rows_are_candidates_and_asked_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.25, 0.5])]
    assert run(spark, rows) == {0: [(1, 0.5), (1, 0.5), (2, 0.25)]}
    assert run(spark, [(20, [1.0, 2.0])] * 3 + [(k, [0.5, 0.5]) for k in range(1, 20)] * 2)[20] == [(k, 1.5) for k in range(1, 11) for _ in (0, 1)]


def test_huge_and_tiny_vectors(spark):
    rows = [(0, [3e38, 3e38]), (1, [1e38, -1e38]), (2, [1e-38, 1e-38]), (20, [1e-38, 0.0]), (3, [2e38, 1.0])]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("kind", ["even", "groups", "unequal lengths"])
def test_recall(spark, kind, monkeypatch):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3_000, 32))
    if kind == "groups":
        x = 0.4 * x + draw.normal(size=(12, 32))[draw.integers(0, 12, len(x))]
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "unequal lengths":
        x *= draw.uniform(0.2, 3, (len(x), 1))
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    monkeypatch.setattr(permutation, "LEAST", 1)
    found = run(spark, rows, rows=1_000)
    expected = brute(rows)
    assert set(found) == set(expected) and all(len(own) == 20 for own in found.values())
    assert recall(found, expected) >= 0.9
    scores = dict(enumerate(x.astype(np.float32).astype(float)))
    assert all(abs(s - scores[q] @ scores[i]) < 1e-12 for q, own in found.items() for i, s in own)


def test_footrule_of_the_files_is_that_of_the_orders():
    draw = np.random.default_rng(7)
    x = draw.normal(size=(50, 6))
    index = permutation.Index(6, 1.0, float(np.linalg.norm(x, axis=1).max()), x[:9], 1.0)
    block = permutation.Block(index, x, [[]] * 50, [[]] * 50)
    lifted = np.concatenate((x, np.sqrt(np.maximum(index.longest**2 - (x**2).sum(1), 0))[:, None]), axis=1)
    orders = [sorted(range(9), key=lambda p: np.linalg.norm(lifted[p] - v)) for v in lifted]
    for q in range(50):
        asked = np.append(x[q], 0) * index.longest / np.linalg.norm(x[q])
        own = sorted(range(9), key=lambda p: np.linalg.norm(lifted[p] - asked))
        plain = [sum(abs(own.index(p) - o.index(p)) for p in range(9)) for o in orders]
        assert block.footrule(index.positions(x[q : q + 1], True)[0]).tolist() == plain


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = {}
    for r in queries.QUERIES["op12_permutation_index"](spark, folder).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(found, brute(rows)) >= 0.9
