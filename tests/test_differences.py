import random
from collections import Counter

import pytest
from helpers import D, plan_of, scanned_rows
from pyspark.sql import functions as F

from arrivalmart.operators import differences
from arrivalmart.operators.quality import QualityError

SCHEMA = "k long, a string, b string"


def plain(left, right):
    mine, other = Counter(left), Counter(right)
    return {(*row, mine[row], other[row]) for row in mine | other if mine[row] != other[row]}


def found(spark, left, right, schema=SCHEMA, **sizes):
    rows = differences.differing_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "k", **sizes).collect()
    assert len(rows) == len(set(rows))
    return set(map(tuple, rows))


@pytest.mark.parametrize("sizes", [{}, {"finer": 2, "few": 3}, {"finer": 3, "few": 0}, {"finer": 4, "few": 0, "most": 2}])
def test_random_losses_and_doubles_are_named_exactly(spark, sizes):
    for seed in range(1, 2 + (len(sizes) == 2)):
        draw = random.Random(seed)
        left = [(draw.choice([draw.randint(-50, 900), None]) if k % 9 == 0 else k, draw.choice(["x", None]), draw.choice(["x", None])) for k in range(200)]
        left += draw.sample(left, 10)
        right = [r for r in left if draw.random() > 0.03]
        right += draw.sample(right, 4) + [(draw.randint(0, 2000), "new", None)]
        draw.shuffle(right)
        assert found(spark, left, right, **sizes) == plain(left, right)


def test_equal_and_empty_tables(spark):
    rows = [(1, "x", None), (1, None, "x"), (None, None, None)]
    assert found(spark, rows, rows[::-1]) == set() == found(spark, [], [])
    assert found(spark, rows, []) == plain(rows, []) and found(spark, [], rows) == plain([], rows)


def test_a_null_in_another_column_is_another_row(spark):
    assert found(spark, [(1, "x", None)], [(1, None, "x")]) == {(1, "x", None, 1, 0), (1, None, "x", 0, 1)}


def test_weights_stand_for_rows(spark):
    left = spark.createDataFrame([(D(2016, 1, d), "x") for d in (1, 1, 2, 3, 3)], "day date, a string")
    right = spark.createDataFrame([(2, D(2016, 1, 1), "x"), (1, D(2016, 1, 2), "x"), (3, D(2016, 1, 3), "x"), (4, None, "x")], "n long, day date, a string")
    rows = differences.differing_rows(left, right, "day", (None, "n"), few=0)
    assert set(map(tuple, rows.collect())) == {(D(2016, 1, 3), "x", 2, 3), (None, "x", 0, 4)}


def test_other_columns_and_keys_without_order_are_refused(spark):
    one = spark.createDataFrame([(1, "x", "y")], SCHEMA)
    with pytest.raises(QualityError, match="differ in their columns"):
        differences.differing_rows(one, one.drop("b"), "k")
    with pytest.raises(QualityError, match="whole number or a date"):
        differences.differing_rows(one, one, "a")
    wide = spark.createDataFrame([(-(2**63), "x", "y"), (2**63 - 1, "x", "y")], SCHEMA)
    with pytest.raises(QualityError, match="too wide"):
        differences.differing_rows(wide, wide, "k")


def test_each_step_reads_less_of_clustered_files(spark, tmp_path, monkeypatch):
    n = 200_000
    rows = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    paths = [str(tmp_path / name) for name in ("left", "right")]
    lost, doubled = (17, 120_001, 120_002), (55_555,)
    changed = rows.where(~F.col("k").isin(*lost)).unionAll(rows.where(F.col("k").isin(*doubled)))
    for df, path in zip((rows, changed), paths, strict=True):
        df.repartitionByRange(4, "k").sortWithinPartitions("k").write.option("parquet.block.size", 32 << 10).parquet(path)
    read, real = [], differences.Sides.sums

    def recorded(self, *arguments):
        summed = real(self, *arguments)
        read.append(scanned_rows(summed))
        return summed

    monkeypatch.setattr(differences.Sides, "sums", recorded)
    got = differences.differing_rows(*[spark.read.parquet(p) for p in paths], "k", few=0)
    assert {(r.k, r.left_rows, r.right_rows) for r in got.collect()} == {*((k, 1, 0) for k in lost), (55_555, 1, 2)}
    assert read[0] >= 2 * n - 3 and len(read) == 3
    assert read[1] < read[0] / 3 and read[2] <= read[1]
    assert scanned_rows(got) < read[0] / 3


def test_rows_of_equal_cells_are_not_shuffled_for_those_that_differ(spark, monkeypatch):
    monkeypatch.setattr(differences, "SENT", 40)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("a"))
        right = left.where("k % 100 <> 7").unionAll(spark.range(1).selectExpr("CAST(NULL AS BIGINT)", "'x'"))
        rows = differences.differing_rows(left, right, "k", few=0, most=3)
        plan = plan_of(rows)
        assert {(r.k, r.left_rows, r.right_rows) for r in rows.collect()} == {*((k, 1, 0) for k in range(7, 20_000, 100)), (None, 0, 1)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in plan


def test_key_ranges_hold_their_cells():
    for seed in range(200):
        draw = random.Random(seed)
        grid = differences.Grid(draw.randint(-99, 99), draw.randint(1, 9))
        cells = draw.sample(range(500), draw.randint(1, 200))
        ranges = grid.keys(cells)
        assert len(ranges) <= differences.RANGES and ranges == sorted(ranges)
        for c in cells:
            assert any(a <= grid.low + c * grid.width and grid.low + (c + 1) * grid.width - 1 <= b for a, b in ranges)
