import random

import numpy as np
import pytest

from arrivalmart.llm import bitslice

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank string"


def brute(rows, k=20):
    good = [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    found = set()
    for q, w in dict([(i, v) for i, v in good if i % 20 == 0]).items():
        own = sorted((-int(w @ v), i) for i, v in good if i != q)[:k]
        found |= {(q, n, i, -s) for n, (s, i) in enumerate(own, 1)}
    return found


def run(spark, data, **sizes):
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in data], SCHEMA)
    found = bitslice.top_rows(table, "vec_id % 20 = 0", **sizes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("sizes", [{}, {"rows": 40, "queries_at_once": 3}])
def test_equal_to_brute_force(spark, sizes):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(8)]) for i in range(230)]
    rows += [(i, [0.25] * 8) for i in range(300, 345)]
    rows += [(400, None), (401, []), (402, [float("nan")] + [0.0] * 7), (403, [None] + [0.0] * 7), (440, [float("inf")] + [0.0] * 7), (None, [0.1] * 8)]
    assert run(spark, rows, **sizes) == sorted(brute(rows))


@pytest.mark.parametrize("rows", [[], [(0, [1.0, -1.0])], [(0, [1.0]), (1, [0.5]), (20, [-0.5])], [(5, [1.0])], [(20 * k, [0.0, 0.0]) for k in range(30)]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == sorted(brute(rows))


def test_repeated_rows_are_candidates_and_asked_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5])]
    assert run(spark, rows) == [(0, 1, 1, 64 * 32), (0, 2, 1, 64 * 32)]


def test_whole_block_against_products():
    for seed in range(60):
        draw = np.random.default_rng(seed)
        n, d, k = int(draw.integers(1, 200)), int(draw.integers(1, 9)), int(draw.integers(1, 25))
        values, weights, ids = draw.integers(-40, 40, (n, d)), draw.integers(-40, 40, d), draw.permutation(n)
        own, score = bitslice.SlicedBlock(ids, values).top(weights, k)
        best = np.lexsort((ids, -(values @ weights)))[:k]
        order = np.lexsort((own, -score))
        assert own[order].tolist() == ids[best].tolist() and score[order].tolist() == (values @ weights)[best].tolist()


def test_unequal_lengths_count_as_zeros(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.5]), (2, [0.5, 0.25, 4.0]), (3, [0.0, 0.0, 9.0]), (20, [0.0, 1.0, 1.0]), (21, [-0.5, -0.5, -0.5, 1.0])]
    width = max(len(v) for _, v in rows)
    padded = [(i, v + [0.0] * (width - len(v))) for i, v in rows]
    expected = sorted(brute(padded))
    assert run(spark, rows) == expected
    assert run(spark, rows, rows=2, queries_at_once=1) == expected


def test_large_components(spark):
    """Up to a length of 2 to the 31 every score is exact; longer vectors take no part, as rows or as queries."""
    rows = [(0, [3e7, -1.0]), (1, [3e7, 1e6]), (2, [-3e7, 2.0]), (20, [1e7, 1e7]), (21, [1.0, 1.0])]
    beyond = [(3, [4e7, 0.0]), (40, [3e38, 1.0]), (60, [2.0**25, 0.0])]
    assert run(spark, rows + beyond) == sorted(brute(rows))


def test_a_repeated_query_is_asked_for_its_first_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, [0.25, 0.0])]
    assert run(spark, rows) == [(0, 1, 1, 32 * 16)]
