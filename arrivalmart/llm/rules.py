"""Quality rules as a ledger of bits: every rule is evaluated once, policies are applied to the bits.

The ledger keeps, for each row, the measurements and one number whose bit b is set if rule b fails. A policy is
a mask of rules; a row is kept if none of the policy's bits is set. What a policy would keep without one of its
rules comes from the counts of bit patterns, of which there are two to the number of rules at most, whatever
the number of rows. Only functions of Spark are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """A rule fails where the condition on the measurements holds."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 100 * m["n_symbols"] > 30 * m["n_words"]),
    Rule("repeated_lines", lambda m: 100 * m["n_dup_lines"] > 60 * m["n_lines"]),
    Rule("capitals", lambda m: 100 * m["n_capitals"] > 60 * m["word_chars"]),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 25 * m["n_words"])),
)
# The policies by version; a version is never changed, a new one is added.
BASE_RULES = ("few_words", "repeated_windows")
POLICIES = {
    "base": BASE_RULES,
    "2": (*BASE_RULES, "symbols", "repeated_lines", "capitals", "word_length"),
}
CURRENT = "2"


def mask_of(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    names = POLICIES[policy]
    return sum(1 << bit for bit, rule in enumerate(rules) if rule.name in names)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def covered_words(words: Column) -> Column:
    """How many words lie in windows of three that are found twice or more, the first included.

    Windows are compared by 64-bit hashes of their three words: two different windows of a text of n words count
    as equal with a chance below n * n / 2**65. Positions are sorted by hash, so a text costs n log n.
    """

    def among(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(sorted_: Column) -> Column:
            def twice(x: Column, k: Column) -> Column:
                same = F.get(sorted_, k - 1)["h"] == x["h"], F.get(sorted_, k + 1)["h"] == x["h"]
                return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

            return F.array_sort(F.transform(F.filter(sorted_, twice), lambda x: x["i"]))

        def width(at: Column) -> Column:
            own = F.transform(at, lambda i, k: F.coalesce(F.least(F.lit(3), i - F.get(at, k - 1)), F.lit(3)))
            return F.aggregate(own, F.lit(0).cast("long"), lambda total, n: total + n)

        return bound(bound(placed, repeated), width)

    def of(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(among(hashes))

    windows = F.transform(
        F.slice(words, F.lit(1), F.size(words) - 2),
        lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(bound(windows, of))


def ledger(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Measurements and failed bits of a text as one struct. A null text has no words, as an empty one."""
    body = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(body, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK}+"))

    def kept_chars(wanted: str) -> Column:
        return F.char_length(F.regexp_replace(body, f"[^{wanted}]+", "")).cast("long")

    def measured(own: Column) -> Column:
        return F.struct(
            F.size(own).cast("long").alias("n_words"),
            F.char_length(F.array_join(own, "")).cast("long").alias("word_chars"),
            kept_chars("#*$%&|<>").alias("n_symbols"),
            kept_chars("A-Z").alias("n_capitals"),
            covered_words(own).alias("n_repeat_words"),
        )

    def lined(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    def judged(both: Column) -> Column:
        m = {n: both["w"][n] for n in ("n_words", "word_chars", "n_symbols", "n_capitals", "n_repeat_words")}
        m |= {n: both["l"][n] for n in ("n_lines", "n_dup_lines")}
        bits = F.lit(0).cast("long")
        for bit, rule in enumerate(rules):
            bits = bits + F.when(rule.fails(m), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.struct(*[c.alias(n) for n, c in m.items()], bits.alias("failed_bits"))

    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return bound(F.struct(bound(words, measured).alias("w"), bound(lines, lined).alias("l")), judged)


def passes(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def with_ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger of every row: id, measurements, failed_bits. Null ids and equal rows are kept; other columns are not read."""
    return df.select(F.col(id_col), ledger(F.col(text_col)).alias("ledger")).select(id_col, "ledger.*")


def kept_rows(df: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows that a policy keeps, with all their columns."""
    return df.where(passes(ledger(F.col(text_col))["failed_bits"], policy))


def ablations(ledgers: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: rows it rejects, rows only it rejects, and rows kept with and without it."""
    mask = F.lit(mask_of(policy)).cast("long")
    patterns = ledgers.groupBy(F.col("failed_bits").bitwiseAND(mask).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    own = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << b).cast("long").alias("bit")) for b, r in enumerate(RULES) if r.name in POLICIES[policy]]
    bits, bit, n = F.col("bits"), F.col("own.bit"), F.col("n")

    def rows(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(F.lit(0))).cast("long")

    return (
        patterns.withColumn("own", F.explode(F.array(*own)))
        .groupBy(F.lit(policy).alias("policy"), F.col("own.rule").alias("rule"))
        .agg(
            rows(bits.bitwiseAND(bit) != 0).alias("rejected"),
            rows(bits == bit).alias("rejected_alone"),
            rows(bits == 0).alias("kept"),
            rows(bits.bitwiseAND(F.bitwise_not(bit)) == 0).alias("kept_without"),
        )
    )
