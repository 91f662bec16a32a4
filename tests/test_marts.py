import dataclasses

from helpers import D, as_set, visits
from pyspark.sql import functions as F
from test_quality import banded, star

from arrivalmart.operators import marts


def sample(spark):
    rows = banded(
        spark,
        {"arrdate": D(2016, 6, 6), "i94res": 101},
        {"arrdate": D(2016, 6, 6), "i94res": 101},
        {"arrdate": D(2016, 6, 7), "i94res": 582, "i94port": "SFR", "i94visa": 1},
        {"arrdate": D(2016, 7, 1), "i94mon": 7, "i94port": "MIA", "depdate": D(2016, 7, 30)},
        {"arrdate": D(2016, 7, 1), "i94mon": 7, "i94port": "MIA", "i94res": 9, "i94mode": 2},
        {"arrdate": D(2016, 7, 1), "i94mon": 7, "i94port": "ZZZ", "i94visa": 7},
    )
    return star(spark, rows, months=[(2016, 6), (2016, 7)])


def test_dice_filters_and_default_columns(spark):
    cube = sample(spark)
    whole = marts.dice(cube)
    assert whole.columns == [*marts.SLICE_COLUMNS, "visitorcount"]
    assert whole.agg(F.sum("visitorcount")).first()[0] == 6
    summer = marts.dice(cube, [2016], [6], ["CA"])
    assert as_set(summer, "arrivaldate_id", "port_id", "weekday", "week", "duration_days", "visitorcount") == {
        (D(2016, 6, 6), "1_LOS", "Monday", 23, "0-3", 2),
        (D(2016, 6, 7), "1_SFR", "Tuesday", 23, "invalid", 1),
    }
    assert marts.dice(cube, [2015]).count() == 0
    unknown = marts.dice(cube, states=["unknown"], by=["port_mode", "month"])
    assert as_set(unknown, *unknown.columns) == {("unknown", 7, 1)}


def test_slice_names():
    assert marts.slice_name([2016], [6, 7, 8], ["CA"]) == "states_CA_yrs_2016_mths_6_7_8"
    assert marts.slice_name([2015, 2016], None, ["MI", "AL"]) == "states_MI_AL_yrs_2015_2016_mths_all"
    assert marts.slice_name(None, [1], None) == "states_all_yrs_all_mths_1"


def test_export_replaces_and_reads_back(spark, tmp_path):
    sliced = marts.dice(sample(spark), [2016], [6, 7])
    for _ in range(2):
        path = marts.export_slice(sliced, str(tmp_path), [2016], [6, 7])
    assert path.endswith("states_all_yrs_2016_mths_6_7")
    back = marts.read_slice(spark, path)
    assert back.dtypes == sliced.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, sliced.collect()))


def test_by_port(spark):
    counted = marts.by_port(sample(spark), [2016])
    assert as_set(counted, "port_id", "port_latitude", "visitorcount") == {
        ("1_LOS", 34.0, 2), ("1_SFR", 37.7, 1), ("1_MIA", 25.7, 1), ("2_MIA", 25.7, 1), ("-1_XXX", None, 1),
    }


def test_visatype_counts_list_a_null_type_with_zero(spark):
    rows = visits(spark, {}, {}, {"visatype": None}, {"visatype": "WT"}, {"i94mode": 2})
    counted = marts.visatype_counts(rows)
    assert as_set(counted, "visatype", "visatype_count") == {("B2", 2), ("WT", 1), (None, 0)}
    assert as_set(marts.visatype_counts(rows, 2), "visatype", "visatype_count") == {("B2", 1)}


def test_top_countries_break_ties_by_name(spark):
    cube = sample(spark)
    top = marts.top_countries(cube, None, None, k=1)
    assert as_set(top, *top.columns) == {("ALBANIA", 4, "0-3", 2), ("ALBANIA", 4, "29+", 1), ("ALBANIA", 4, "invalid", 1)}
    three = marts.top_countries(cube, None, None, k=2)
    assert as_set(three, "countryofresidence") == {("ALBANIA",), ("MEXICO",)}
    assert as_set(marts.top_countries(cube, ["CA"], [6], k=5), "countryofresidence", "visitorcount") == {
        ("ALBANIA", 2), ("MEXICO", 1),
    }


def test_purpose_by_weekday(spark):
    cube = sample(spark)
    long = marts.purpose_by_weekday(cube, None, [6, 7])
    assert as_set(long, *long.columns) == {
        ("Pleasure", "Monday", 2), ("Business", "Tuesday", 1), ("Pleasure", "Friday", 2), (None, "Friday", 1),
    }
    wide = marts.purpose_by_weekday(cube, None, [6, 7], pivot=True)
    assert wide.columns == ["visitpurpose", *marts.WEEKDAYS]
    assert as_set(wide, "visitpurpose", "Monday", "Friday") == {
        ("Pleasure", 2, 2), ("Business", None, None), (None, None, 1),
    }


def test_city_mode_month(spark):
    cube = sample(spark)
    two = marts.city_mode_month(cube, None, k=2)
    assert as_set(two, *two.columns) == {
        ("Los Angeles", "CA", "Air", 6, 2), ("Miami", "FL", "Air", 7, 1), ("Miami", "FL", "Sea", 7, 1),
    }


def test_equal_city_names_of_two_states_stay_apart(spark):
    cube = sample(spark)
    named = cube.port.withColumn("port_city", F.when(F.col("port_city").isNotNull(), F.lit("Springfield")))
    found = marts.city_mode_month(dataclasses.replace(cube, port=named), None, k=1)
    assert as_set(found, *found.columns) == {("Springfield", "CA", "Air", 6, 3)}


def test_export_keeps_line_breaks_quotes_and_backslashes(spark, tmp_path):
    odd = 'a "quoted"\nline\r\\n, \\b'
    sliced = marts.dice(sample(spark), [2016], [6]).withColumn("port_place", F.lit(odd))
    back = marts.read_slice(spark, marts.export_slice(sliced, str(tmp_path)))
    assert {r.port_place for r in back.collect()} == {odd} and back.count() == sliced.count()
