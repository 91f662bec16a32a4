import math
from fractions import Fraction

import pytest
from helpers import lookups_of, plan_of
from pyspark.sql import functions as F
from test_fact import random_visits

from arrivalmart.operators import fact, quality, states


def banded(spark, n, seed):
    rows = fact.add_bands(fact.denormalise(random_visits(spark, n, seed), lookups_of(spark).checked()))
    return rows.withColumns({"year": F.col("i94yr"), "month": F.col("i94mon")})


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_merged_months_equal_the_states_of_all_rows(spark):
    rows = banded(spark, 400, 1)
    monthly = states.profile_states(rows, ("year", "month"))
    whole = states.profile_states(rows.drop("month"), ("year",))
    assert as_rows(states.merge_states(monthly, ("year",))) == as_rows(whole.where("field <> 'month'"))
    # Merging in steps, or again, changes nothing.
    assert as_rows(states.merge_states(states.merge_states(monthly, ("year",)))) == as_rows(states.merge_states(monthly))


def test_profile_equals_the_profiles_of_all_rows(spark):
    rows = banded(spark, 300, 2).drop("year", "month")
    found = {r.field: r for r in states.profile(states.merge_states(states.profile_states(rows.withColumn("part", F.col("i94mon")), ("part",)))).collect()}
    number = {r.summary: r for r in quality.numeric_profile(rows).collect()}
    text = {r.summary: r for r in quality.string_profile(rows).collect()}
    missing = {r.checktype: r for r in quality.missing_profile(rows).collect()}
    for c in quality.NUMERIC_COLUMNS:
        assert math.isclose(found[c].mean, number["mean"][c], rel_tol=1e-12) and math.isclose(found[c].stddev, number["stddev"][c], rel_tol=1e-9, abs_tol=1e-12)
        assert (found[c].numbers, found[c].lowest, found[c].highest) == (number["count"][c], number["min"][c], number["max"][c])
    for c in quality.STRING_COLUMNS:
        assert (str(found[c].texts), found[c].text_min, found[c].text_max) == (text["count"][c], text["min"][c], text["max"][c])
    for c in rows.columns:
        assert [found[c][k] for k in quality.CHECKS] == [missing[k][c] for k in quality.CHECKS]
        assert found[c].rows == 300


def test_second_moments_of_large_numbers_close_together_are_exact(spark):
    values = [10**15 + k for k in (0, 1, 1, 7, 3, 12, 5)]
    rows = spark.createDataFrame([(k % 3, v) for k, v in enumerate(values)], "part int, admnum long")
    found = states.profile(states.merge_states(states.profile_states(rows, ("part",)))).first()
    mean = Fraction(sum(values), len(values))
    assert found.mean == float(mean)
    assert math.isclose(found.stddev, math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)), rel_tol=1e-14)


@pytest.mark.parametrize("values", [[], [None, None], [5], [None, -3], [-7, 2]])
def test_few_numbers(spark, values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "part int, admnum long")
    whole = [v for v in values if v is not None]
    found = states.profile(states.merge_states(states.profile_states(rows, ("part",)))).collect()
    if not values:
        assert found == []
        return
    (row,) = found
    assert (row.rows, row.numbers, row.isnull) == (len(values), len(whole), len(values) - len(whole))
    assert row.mean == (sum(whole) / len(whole) if whole else None)
    assert (row.stddev is None) == (len(whole) < 2)
    assert (row.lowest, row.highest) == ((min(whole), max(whole)) if whole else (None, None))


def test_text_numbers_count_as_whole_numbers(spark):
    rows = spark.createDataFrame([("7",), (" 9 ",), ("x",), ("8.9",), (None,)], "admnum string")
    row = states.profile(states.profile_states(rows)).first()
    assert (row.numbers, row.mean, row.lowest, row.highest) == (3, 8.0, 7, 9)


def test_states_take_one_scan(spark):
    rows = banded(spark, 20, 3)
    plan = plan_of(states.profile_states(rows, ("year", "month")))
    assert plan.count("ObjectHashAggregate") == 2 and "SortAggregate" not in plan


def test_squares_of_the_widest_numbers_are_exact(spark):
    low, high = -(1 << 31), (1 << 31) - 1
    rows = spark.createDataFrame([(v,) for v in (low, low, high, 3)], "i94bir int")
    parts = {c: F.expr(f"CAST({p} AS STRING)") for c, p in (("squares", "`state:squares:i94bir`"), ("total", "`state:total:i94bir`"))}
    measures = states.state_measures(rows.schema, ["i94bir"])
    assert "decimal(19" not in str(measures).lower()
    found = rows.agg(*measures).select(*[value.alias(name) for name, value in parts.items()]).first()
    assert found.squares == str(2 * low * low + high * high + 9) and found.total == str(2 * low + high + 3)
