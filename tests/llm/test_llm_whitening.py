import random

import numpy as np
import pytest

from arrivalmart.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, dims string, whitened string, n double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c", 0.5) for i, v in rows], SCHEMA)


def plain(rows, weights="one", components=4):
    """The contract by numpy over all rows, whole numbers in Python."""
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dims = max((len(v) for _, v in good), default=0)
    whole = [(i, tuple([int(np.floor(256 * c)) for c in v] + [0] * (dims - len(v)))) for i, v in good]
    copies = {}
    for _, x in whole:
        copies[x] = copies.get(x, 0) + 1
    each = list(copies)
    weight = [copies[x] if weights == "copies" else 1 for x in each]
    n = sum(weight)
    sums = [sum(w * x[k] for x, w in zip(each, weight, strict=True)) for k in range(dims)]
    centred = np.array([[x[k] - sums[k] / n for k in range(dims)] for x in each]).reshape(len(each), dims)
    cov = (centred * np.array(weight)[:, None]).T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    found = []
    for i, x in whole:
        for c in range(min(components, dims)):
            e, axis = values[-1 - c], vectors[:, -1 - c]
            w = (np.array(x) - np.array(sums) / n) @ axis / np.sqrt(e)
            found.append((i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), abs(w), e / np.trace(cov)))
    return found


def check(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[3], r[1], round(r[4], 6))
    found = sorted([(r[0], r.component, r.n, int(r.deviation), abs(r.whitened), r.explained) for r in found], key=key)
    expected = sorted(expected, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert np.allclose([r[4:] for r in found], [r[4:] for r in expected], atol=1e-9)


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_equal_to_the_plain_version(spark, weights):
    draw = random.Random(3)
    scale = [0.5, 0.4, 0.3, 0.2, 0.1, 0.05]
    rows = [(i, [draw.gauss(0.7, s) for s in scale]) for i in range(300)]
    rows += [(i, [0.25, -0.5, 0.125, 0.0, 1.0, -1.0]) for i in range(300, 450)]  # a third of all
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]
    rows += [(500, None), (501, [None] * 6), (502, [float("nan")] * 6), (503, [float("-inf")] + [0.0] * 5)]
    rows += [(504, []), (505, [0.0] * 6), (506, [0.5, 0.25]), (507, [-0.0] * 6)]
    found = whitening.whiten(table(spark, rows), weights=weights)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = found.collect()
    check(found, plain(rows, weights))
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_signs_are_the_same_for_all_rows(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(400, 5)) * [1.0, 0.5, 0.25, 0.2, 0.1]
    found = whitening.whiten(table(spark, [(k, v.tolist()) for k, v in enumerate(x)])).collect()
    whitened = np.zeros((400, 4))
    for r in found:
        whitened[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(np.cov(whitened.T, bias=True), np.eye(4), atol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, []), (2, [])], [(1, [0.5]), (2, [0.5])], [(None, [1.0, 2.0]), (3, [1.0, 2.0])]])
def test_without_variance(spark, rows):
    found = whitening.whiten(table(spark, rows)).collect()
    width = max((len(v) for _, v in rows if v), default=0)
    assert len(found) == width * sum(v is not None for _, v in rows)
    assert all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in found)


def test_fewer_dimensions_and_components_without_variance(spark):
    found = whitening.whiten(table(spark, [(1, [0.5, 1.0]), (2, [-0.5, 1.0]), (3, [0.25, 1.0])])).collect()
    assert sorted((r.vec_id, r.component) for r in found) == [(i, c) for i in (1, 2, 3) for c in (1, 2)]
    assert all((r.whitened is None) == (r.component == 2) and r.explained == 2 - r.component and r.identity_error < 1e-9 for r in found)


def test_huge_numbers_are_exact(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 0.0]), (3, [2.0**40, 0.0])]
    found = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows)).collect()}
    x = {1: [2**63 - 1, 256], 2: [-(2**63), 0], 3: [2**48, 0]}
    sums = [sum(v[k] for v in x.values()) for k in (0, 1)]
    exact = {i: sum((3 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}
    assert found == {i: d if d < 10**38 else None for i, d in exact.items()} and None in found.values()


def test_packed_vectors_come_back():
    draw = random.Random(1)
    for _ in range(300):
        row = np.array([draw.choice([0, 0, 1, -1, 127, -128, 128, -129, 32767, -32768, 32768, 2**31, -(2**63), 2**63 - 1]) for _ in range(draw.randint(0, 6))], dtype=np.int64)
        assert whitening.unpacked([whitening.packed(row)], 6)[0].tolist() == row.tolist() + [0] * (6 - len(row))


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = queries.QUERIES["op11_whitening"](spark, folder)
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(found.collect(), plain(rows))
