from dataclasses import replace

import pytest
from helpers import D, PORTS, as_set, lookups_of, plan_of, ports, visits
from pyspark.sql import functions as F

from arrivalmart.functions.bands import AGE, DURATION
from arrivalmart.operators import dimensions, fact, marts, quality
from arrivalmart.operators.quality import QualityError
from arrivalmart.sources import staging


def banded(spark, *changes, port_rows=PORTS):
    return fact.add_bands(fact.denormalise(visits(spark, *changes), lookups_of(spark, port_rows)))


def star(spark, rows, months=((2016, 6),), port_rows=PORTS):
    return marts.Star(
        fact=fact.build_fact(rows),
        port=dimensions.port_dim(ports(spark, port_rows)),
        age=dimensions.band_dim(spark, AGE),
        duration=dimensions.band_dim(spark, DURATION),
        date=dimensions.date_dim(dimensions.months_table(spark, months)),
    ).checked()


def test_guards(spark):
    rows = visits(spark, {}, {})
    assert quality.require_rows(rows, "visits") is rows
    with pytest.raises(QualityError, match="no rows in visits"):
        quality.require_rows(rows.where("cicid > 9"), "visits")
    assert quality.require_unique(rows, ["cicid"], "visits") is rows
    with pytest.raises(QualityError, match="more than one row per i94yr"):
        quality.require_unique(rows, ["i94yr"], "visits")
    nulls = spark.sql("SELECT CAST(NULL AS INT) AS code FROM range(2)")
    assert quality.require_unique(nulls, ["code"], "countries") is nulls
    report = quality.guard_report({"some": rows, "none": rows.where("cicid > 9")})
    assert as_set(report, "table_name", "row_count", "ok") == {("some", 2, True), ("none", 0, False)}


def test_missing_profile_by_type(spark):
    rows = spark.createDataFrame(
        [(float("nan"), -1, "", None), (-1.0, None, "unknown", D(2016, 1, 1)), (None, 5, " -1", None), (1.0, 6, "abc", None)],
        "d double, i int, s string, t date",
    )
    profile = quality.missing_profile(rows)
    assert profile.columns == ["d", "i", "s", "t", "checktype", "totalrows"]
    assert [tuple(r) for r in profile.collect()] == [
        (1, 0, 0, 0, "isnan", 4),
        (1, 1, 0, 3, "isnull", 4),
        (0, 0, 1, 0, "emptystring", 4),
        (0, 0, 1, 0, "unknownstring", 4),
        (1, 1, 1, 0, "nan_as_-1", 4),
    ]
    assert {f.dataType.simpleString() for f in profile.schema if f.name in "dist"} == {"bigint"}


def test_profiles_by_month(spark):
    rows = banded(spark, {"i94mon": 1}, {"i94mon": 1, "airline": "unknown"}, {"i94mon": 2})
    keyed = rows.withColumnsRenamed({"i94mon": "month"})
    profile = quality.missing_profile(keyed, ["month"])
    assert profile.count() == 10
    unknown = profile.where("checktype = 'unknownstring'")
    assert as_set(unknown, "month", "airline", "totalrows") == {(1, 1, 2), (2, 0, 1)}


def test_numeric_profile_reads_text_as_numbers(spark):
    rows = spark.createDataFrame([("10", 1), ("9", 3), ("x", None)], "admnum string, age_id int")
    profile = quality.numeric_profile(rows, ["admnum", "age_id"])
    assert [r.summary for r in profile.collect()] == ["count", "mean", "stddev", "min", "max"]
    got = {r.summary: (r.admnum, r.age_id) for r in profile.collect()}
    assert got["count"] == (2.0, 2.0) and got["mean"] == (9.5, 2.0)
    assert got["min"] == (9.0, 1.0) and got["max"] == (10.0, 3.0)
    assert got["stddev"][1] == pytest.approx(2**0.5)


def test_string_profile(spark):
    profile = quality.string_profile(banded(spark, {"airline": "B"}, {"airline": "A"}, {"gender": None}))
    got = {r.summary: (r.airline, r.gender) for r in profile.collect()}
    assert got == {"count": ("3", "2"), "min": ("A", "F"), "max": ("B", "F")}
    assert profile.columns == ["summary", *quality.STRING_COLUMNS]


def test_profile_scans_once(spark, tmp_path):
    path = str(tmp_path / "visits")
    visits(spark, {}).write.parquet(path)
    rows = fact.add_bands(fact.denormalise(spark.read.parquet(path), lookups_of(spark)))
    assert plan_of(quality.missing_profile(rows)).count("FileScan parquet") == 1


def test_reconcile(spark):
    rows = banded(spark, {}, {}, {"gender": None}, {"arrdate": None})
    report = quality.reconcile(rows, fact.build_fact(rows))
    assert as_set(report, *report.columns) == {(4, 3, 4, 25.0, True)}
    assert quality.raise_on_failure(report, "rows") is report


def test_reconcile_fails_on_a_broken_count(spark):
    rows = banded(spark, {}, {"gender": None})
    broken = fact.build_fact(rows).withColumn("visitorcount", F.col("visitorcount") * 2)
    with pytest.raises(QualityError, match="rows failed"):
        quality.raise_on_failure(quality.reconcile(rows, broken), "rows")
    empty = quality.reconcile(rows, broken.where("year = 0"))
    assert as_set(empty, "rows_in", "visitors", "matches") == {(2, 0, False)}
    months = quality.reconcile(
        rows.select(F.col("i94mon").alias("month")), broken.withColumn("month", F.lit(7)), ["month"]
    )
    assert as_set(months, "month", "rows_in", "visitors", "matches") == {(6, 2, 0, False), (7, 0, 4, False)}


def test_reconcile_bands_checks_every_band(spark):
    banded_by = ((DURATION, "duration_days"), (AGE, "i94bir"))
    rows = banded(spark, {}, {"depdate": None, "i94bir": -1}, {"i94bir": 1, "depdate": D(2016, 6, 20)})
    built = fact.build_fact(rows)
    report = quality.reconcile_bands(rows, built, banded_by)
    assert report.count() == 21 == report.where("matches").count()
    for bands, _ in banded_by:
        moved = built.withColumn(bands.fact_column, F.lit(77))
        bad = quality.reconcile_bands(rows, moved, banded_by).where("NOT matches")
        columns = ("band_name", "band_id", "rows_before", "visitors_after")
        assert (bands.name, 77, 0, 3) in as_set(bad, *columns)
        assert as_set(bad, "band_name") == {(bands.name,)}


def test_row_check_matches(spark):
    rows = banded(spark, {}, {"i94port": "ZZZ"}, {"i94mode": 0}, {"depdate": None, "i94bir": None})
    report = quality.row_check(staging.row_manifest(rows), star(spark, rows))
    assert as_set(report, *report.columns) == {(2016, 6, 4, 4, True)}


def test_row_check_reports_orphans_and_doubles(spark):
    rows = banded(spark, {}, {"i94port": "ZZZ"})
    manifest = staging.row_manifest(rows)

    def check(other):
        return as_set(quality.row_check(manifest, other), "sas_rowcount", "sumvisitorcount", "matches")

    without_xxx = [p for p in PORTS if p[0] != "XXX"]
    assert check(star(spark, rows, port_rows=without_xxx)) == {(2, 1, False)}
    assert check(star(spark, rows, months=[(2016, 7)])) == {(2, None, False)}
    good = star(spark, rows)
    assert check(replace(good, date=good.date.unionAll(good.date))) == {(2, 4, False)}
    undated = banded(spark, {}, {"arrdate": None})
    assert check(star(spark, undated)) == {(2, 1, False)}
    nothing = replace(good, fact=good.fact.withColumn("month", F.lit(7)))
    assert check(nothing) == {(2, None, False), (None, 2, False)}
