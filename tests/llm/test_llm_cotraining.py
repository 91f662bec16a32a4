import numpy as np
import pytest
from brute import documents, empty
from pyspark.sql import functions as F

from arrivalmart.llm import cotraining

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_labels(tables):
    """Fitted without the labels of the odd ids: nearly all good documents of these stay, and most bad ones go."""
    docs, labels = tables
    model = cotraining.fit(docs, labels.where("doc_id % 2 = 0"))
    scored = cotraining.with_quality(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = [(r.quality, r.p_quality >= cotraining.KEPT_FROM) for r in scored.collect()]
    good, bad = [kept for q, kept in rows if q == 1], [kept for q, kept in rows if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


def test_the_same_model_each_time(tables):
    docs, labels = tables
    one, two = (cotraining.fit(docs.repartition(n), labels) for n in (1, 3))
    assert np.allclose(one.text.weights, two.text.weights) and one.prior == two.prior


@pytest.mark.parametrize("labels", [[], [(6, 1, 0)], [(None, 1, 0), (3, None, 0), (4, 7, 0)], [(6, 1, 0), (6, 0, 0), (9, 0, 0)]])
def test_too_few_labels_leave_all_rows_at_the_prior(spark, labels):
    docs = documents(spark)
    found = cotraining.score_all(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found.columns == ["doc_id", "p_quality", "kept"] and found.count() == docs.count()
    assert found.select("p_quality").distinct().count() == 1


def test_rows_of_every_kind(spark, tables):
    model = cotraining.fit(*tables)
    docs = documents(spark)
    kept = cotraining.kept_rows(docs, model)
    scored = cotraining.with_quality(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == scored.where(F.col("p_quality") >= cotraining.KEPT_FROM).count()
    assert all(0 <= r.p_quality <= 1 for r in scored.collect()) and scored.count() == docs.count()
    assert cotraining.kept_rows(empty(spark), model).count() == 0
    assert cotraining.score_all(empty(spark), tables[1]).count() == 0
    few = docs.select("doc_id", "text")
    assert cotraining.score_all(few, tables[1]).count() == docs.count()


def test_views_teach_each_other():
    """Only the second view sees the difference in the labelled rows of one half; pseudo-labels carry it to the first."""
    draw = np.random.default_rng(1)
    truth = draw.integers(0, 2, 400)
    text = np.stack([truth + draw.normal(0, 0.3, 400), draw.normal(0, 1, 400)], axis=1)
    meta = np.stack([truth + draw.normal(0, 0.3, 400), draw.normal(0, 1, 400)], axis=1)
    labels = np.where(np.arange(400) < 60, truth, -1)
    model = cotraining.co_train(text, meta, labels, np.arange(400) % 5)
    for view, x in ((model.text, text), (model.meta, meta)):
        assert ((view.raw(x) > 0) == truth).mean() > 0.85


def test_all_unlabelled_documents_are_the_pool(spark, tables, monkeypatch):
    """Every unlabelled id is in the pool once, and a pool in a table teaches as one in arrays does."""
    docs, labels = tables
    pools = []
    monkeypatch.setattr(cotraining.TablePool, "__init__", lambda self, *made, plain=cotraining.TablePool.__init__: (plain(self, *made), pools.append(self))[0])
    docs = docs.where("doc_id % 3 = 0")
    one = docs.orderBy("doc_id").limit(1)
    repeated = docs.unionByName(one.crossJoin(spark.range(200)).drop("id"))
    first, second = cotraining.fit(docs, labels), cotraining.fit(repeated, labels)
    unlabelled = docs.join(labels.where("quality IN (0, 1)"), "doc_id", "left_anti").select("doc_id").distinct()
    assert [p.size for p in pools] == [unlabelled.count()] * 2
    assert np.allclose(first.text.weights, second.text.weights) and first.prior == second.prior
    rows = pools[0].rows.toArrow()
    local = cotraining.LocalPool(*cotraining.arrays_of(rows, cotraining.META))
    monkeypatch.setattr(cotraining, "TAUGHT", 10**6)
    counts = pools[0].counts([], 0, first.text)
    assert (counts == local.counts([], 0, first.text)).all() and counts.sum() == local.size
    lesson = cotraining.Lesson(0, first.text, 29_000, 31_000)
    for before in ([], [cotraining.Lesson(0, first.text, 28_000, 40_000)]):
        (x, y), (other, label) = pools[0].taught(before, lesson), local.taught(before, lesson)
        assert sorted(y) == sorted(label) and np.isclose(x.sum(), other.sum()) and 0 < len(y) < local.size


def test_triples_of_long_texts_are_counted_in_slices(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["", "a", "ab", "abcabcabc" * 40, "é😀" * 30, "xyz" * 100])
    whole, totals = cotraining.gram_counts(texts)
    assert totals.tolist() == [max(len(t.as_py().encode()) - 2, 1) for t in texts]
    assert whole.sum(axis=1).tolist() == [max(len(t.as_py().encode()) - 2, 0) for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(cotraining, "CHUNK", size)
        assert (cotraining.gram_counts(texts)[0] == whole).all()
    rows = np.array([[0, 1, 255], [0, 0, 256], [1 << 16, 0, 3]])
    assert cotraining.unpacked_counts([cotraining.packed_counts(r) for r in rows]).tolist() == rows.tolist()
