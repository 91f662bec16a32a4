import random

import pytest
from brute import documents, empty, fingerprint, groups

from arrivalmart.llm import components, simhash

SF = "/root/testdata/sf0.001"


def near(prints, radius=3):
    own = sorted(set(prints))
    return [(a, b) for k, a in enumerate(own) for b in own[:k] if (a ^ b).bit_count() <= radius]


def test_every_pair_within_the_radius_shares_a_key():
    masks, draw = simhash.covering_masks(), random.Random(2)
    assert len(masks) == 15
    for _ in range(5000):
        x = draw.getrandbits(64)
        y = x ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3)))
        assert any(x & m == y & m for m in masks)


def test_refined_masks_still_cover_and_end_small():
    draw, masks = random.Random(3), [simhash.covering_masks()[4]]
    for _ in range(simhash.REFINEMENTS):
        mask = masks[-1]
        finer = simhash.refined_masks(mask)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(300):
            y = sum(1 << b for b in draw.sample(free, min(3, len(free))))
            assert any(y & m == 0 for m in finer)
        masks.append(finer[0])
    assert 64 - max(m.bit_count() for m in masks) <= 12


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "x y z " * 40_000, "Größe ÉTÉ a b"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == fingerprint(text)


@pytest.mark.parametrize("most", [2, 512])
def test_links_connect_what_is_linked(spark, most):
    """With two fingerprints a bucket at most, dense buckets go through every refinement."""
    draw, prints = random.Random(4), []
    for _ in range(6):
        center = draw.getrandbits(64)
        prints += [center ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for _ in range(15)]
    prints += [draw.getrandbits(64) for _ in range(40)] + [0, 7, (1 << 64) - 1]
    prints = sorted(set(prints))
    table = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.find_links(spark, table, most=most).collect()]
    same = lambda links: {n: g for n, g in groups(links, prints).items()}
    assert same(found) == same(near(prints))


def check(docs, found):
    prints = {(r.doc_id, r.text): fingerprint(r.text) for r in docs.collect()}
    roots = groups(near(prints.values()), set(prints.values()))
    least = {}
    for (doc_id, _), p in prints.items():
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    expected = sorted(((r.doc_id, f"{prints[r.doc_id, r.text]:016x}", least.get(roots[prints[r.doc_id, r.text]])) for r in docs.collect()), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_rows_of_every_kind(spark):
    docs = documents(spark)
    check(docs, simhash.link_texts(docs))
    assert simhash.link_texts(empty(spark)).count() == 0
    assert simhash.first_of_each(empty(spark)).count() == 0


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, simhash.link_texts(docs))


def test_first_of_each_group_stays(spark):
    docs = documents(spark)
    left = simhash.first_of_each(docs)
    known = {(r.doc_id, r.component_id) for r in simhash.link_texts(docs).collect()}
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c in known if c is not None})
    nobody = docs.selectExpr("CAST(NULL AS LONG) AS doc_id", *[c for c in docs.columns if c != "doc_id"])
    assert simhash.first_of_each(nobody).count() == len({fingerprint(r.text) for r in docs.collect()} - {None})


@pytest.mark.parametrize("kind", ["path", "hub", "random", "none"])
def test_components(spark, kind):
    draw = random.Random(6)
    links = {
        "path": [(k, k + 1) for k in range(60)],
        "hub": [(0, k) for k in range(1, 200)] + [(300, 5)],
        "random": [(draw.randrange(150), draw.randrange(150)) for _ in range(110)],
        "none": [],
    }[kind]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [(a, b) for a, b in links if a != b]
    assert found == groups(links, {n for link in links for n in link})
