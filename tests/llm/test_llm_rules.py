import pytest
from brute import ODD_TEXTS, documents, empty, measures
from pyspark.sql import functions as F

from arrivalmart.llm import rules

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.fixture(scope="module")
def ledgers(spark):
    more = ["a b c a b c x y", "a a a a a", "x y z\nx y z", "# * $ % & | < >", "A B C D " * 20]
    texts = [*ODD_TEXTS, *more]
    return texts, rules.with_ledger(documents(spark, texts))


def test_measures_equal_brute_force(ledgers):
    texts, found = ledgers
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in found.where("doc_id IS NOT NULL").collect()}
    assert got == {k: measures(t) for k, t in enumerate(texts)}
    assert found.count() == len(texts) + 3


def test_plan_is_native(ledgers):
    plan = ledgers[1]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_policies_read_the_same_bits(ledgers):
    found = ledgers[1].withColumns({"base": rules.passes(F.col("failed_bits"), "base"), "now": rules.passes(F.col("failed_bits"), rules.CURRENT)})
    for r in found.collect():
        assert r.base == (not (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words))
        assert r.now <= r.base


def test_ablations_equal_counts(ledgers):
    bits = [r.failed_bits for r in ledgers[1].collect()]
    mask = rules.mask_of("2")
    got = {r.rule: (r.rejected, r.rejected_alone, r.kept, r.kept_without) for r in rules.ablations(ledgers[1]).collect()}
    for bit, rule in enumerate(rules.RULES):
        own = 1 << bit
        expected = (
            sum(b & own > 0 for b in bits),
            sum(b & mask == own for b in bits),
            sum(b & mask == 0 for b in bits),
            sum(b & mask & ~own == 0 for b in bits),
        )
        assert got[rule.name] == expected


def test_kept_rows_have_all_columns_and_no_rows_give_none(spark):
    docs = documents(spark, ["ordinary words " + " ".join(f"w{k}" for k in range(60)), None])
    kept = rules.kept_rows(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [0]
    assert rules.kept_rows(empty(spark)).count() == 0 == rules.with_ledger(empty(spark)).count()
