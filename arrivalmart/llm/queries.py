"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalmart.llm import bitslice, bpe, cotraining, extraction, licenses, lm, packing, periodic, permutation, pii, rules, simhash, whitening

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.with_ledger(table(spark, sf_dir, "documents"))
    return found.withColumns(
        {
            "base_failed": ~rules.passes(F.col("failed_bits"), "base"),
            "kept": rules.passes(F.col("failed_bits"), rules.CURRENT),
        }
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link_texts(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_rows(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op10_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_held_out(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # A deviation beyond 64 bits is null here and whole in the further column.
    return found.withColumns({"deviation_exact": F.col("deviation"), "deviation": F.col("deviation").try_cast("bigint")})


def op12_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest_rows(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.with_runs(table(spark, sf_dir, "documents"), plan=periodic.planted))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_packing": op3_packing,
    "op4_cotraining": op4_cotraining,
    "op5_bpe": op5_bpe,
    "op6_licenses": op6_licenses,
    "op7_html": op7_html,
    "op8_topk": op8_topk,
    "op9_pii": op9_pii,
    "op10_ngram_trie": op10_ngram_trie,
    "op11_whitening": op11_whitening,
    "op12_permutation_index": op12_permutation_index,
    "op13_periodic_runs": op13_periodic_runs,
}
