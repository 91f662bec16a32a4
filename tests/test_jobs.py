import glob

import pytest
from helpers import PORTS, as_set, lookups_of, plan_of, visits
from pyspark.sql import functions as F
from test_fact import random_visits
from test_warehouse import table

from arrivalmart.operators import marts
from arrivalmart.operators.quality import QualityError
from arrivalmart.plans import jobs
from arrivalmart.sources import lookups, staging, warehouse
from arrivalmart.sources.workspace import shared_folder
from driver_binding.queries import raw_records

MONTHS = [(2016, 1), (2016, 2), (2016, 3)]


@pytest.fixture()
def paths(tmp_path):
    made = jobs.Paths.under(str(tmp_path / "mart"))
    folder = tmp_path / "mart" / "lookups"
    folder.mkdir(parents=True)
    ports = [",".join(lookups.PORT_COLUMNS)]
    for code, lat, lng, place, city, county, state, name, iso, country in PORTS:
        cells = (code, lat, lng, f'"{place}"', city, county, state, name, iso, country)
        ports.append(",".join("" if c is None else str(c) for c in cells))
    (folder / "ports.csv").write_text("\n".join(ports) + "\n")
    (folder / "states.csv").write_text("state_id,state_name\nCA,California\nFL,Florida\n")
    (folder / "countries.csv").write_text("code|i94ctry\n101|ALBANIA\n582|MEXICO\n")
    return made


def stage(spark, paths, rows):
    staging.write_staged(rows, paths.staged)
    staging.write_manifest(staging.row_manifest(rows), paths.manifest)


def dated(spark, n, seed):
    """Random visits whose arrival lies in their month, so that every one has a date member."""
    arrival = F.make_date("i94yr", "i94mon", F.lit(5))
    return random_visits(spark, n, seed).withColumn("arrdate", arrival)


def test_load_check_extract(spark, paths):
    rows = dated(spark, 300, seed=1)
    stage(spark, paths, rows)
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    report = jobs.check_rows(spark, paths, MONTHS)
    assert report.where("matches").count() == 3
    star = jobs.read_star(spark, paths)
    assert star.fact.agg(F.sum("visitorcount")).first()[0] == 300
    assert star.date.count() == 31 + 29 + 31
    path = jobs.extract_slice(spark, paths, [2016], [1, 2], ["CA", "unknown"])
    assert path.endswith("states_CA_unknown_yrs_2016_mths_1_2")
    sliced = marts.dice(star, [2016], [1, 2], ["CA", "unknown"])
    assert sorted(map(str, marts.read_slice(spark, path).collect())) == sorted(map(str, sliced.collect()))
    for log in ("checknulls", "intfields", "stringfields", "reconcile", "rowcheck"):
        assert glob.glob(f"{paths.logs}/{log}/year=2016/month=2/*.csv")
    whole = marts.dice(star, by=["year"])
    assert as_set(whole, "year", "visitorcount") == {(2016, 300)}


def test_loading_again_and_month_by_month_gives_the_same_fact(spark, paths):
    stage(spark, paths, dated(spark, 200, seed=2))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    once = table(spark, paths.visit_fact)
    for months in (MONTHS[:1], MONTHS[1:]):
        jobs.load_months(spark, paths, months)
    assert table(spark, paths.visit_fact) == once
    assert warehouse.read_date_dim(spark, paths.date).count() == 91
    assert jobs.check_rows(spark, paths, MONTHS).where("matches").count() == 3


def test_corrected_month_replaces_the_old_one(spark, paths):
    stage(spark, paths, dated(spark, 200, seed=3))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    corrected = visits(spark, {"i94mon": 2}, {"i94mon": 2}).withColumn("arrdate", F.lit("2016-02-03").cast("date"))
    stage(spark, paths, corrected)
    jobs.load_months(spark, paths, [(2016, 2)])
    held = warehouse.read_fact(spark, paths.visit_fact, [(2016, 2)])
    assert as_set(held, "arrivalstate_abbr", "visitorcount") == {("CA", 2)}
    assert jobs.check_rows(spark, paths, MONTHS).where("matches").count() == 3


def test_unknown_month_is_loaded_like_any_other(spark, paths):
    stage(spark, paths, visits(spark, {"i94yr": -1, "i94mon": -1}, {"i94yr": -1, "i94mon": -1}))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, [(-1, -1)])
    fact = warehouse.read_fact(spark, paths.visit_fact, [(-1, -1)])
    assert fact.agg(F.sum("visitorcount")).first()[0] == 2


def test_failed_load_leaves_the_warehouse_alone(spark, paths, monkeypatch):
    stage(spark, paths, dated(spark, 100, seed=4))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    before = table(spark, paths.visit_fact)
    with pytest.raises(QualityError, match="asked for months"):
        jobs.load_months(spark, paths, [*MONTHS, (2016, 4)])
    real = jobs.fact.build_fact
    monkeypatch.setattr(
        jobs.fact, "build_fact", lambda df: real(df).withColumn("visitorcount", F.col("visitorcount") + 1)
    )
    with pytest.raises(QualityError, match="row reconciliation"):
        jobs.load_months(spark, paths, MONTHS)
    monkeypatch.setattr(jobs.fact, "build_fact", lambda df: real(df).withColumn("age_id", F.lit(3)))
    with pytest.raises(QualityError, match="band reconciliation"):
        jobs.load_months(spark, paths, MONTHS)
    assert table(spark, paths.visit_fact) == before


def test_row_check_names_the_month_that_differs(spark, paths):
    rows = dated(spark, 100, seed=5)
    stage(spark, paths, rows)
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    staging.write_manifest(staging.row_manifest(rows.unionAll(rows)).where("sas_data_month = 2"), paths.manifest)
    with pytest.raises(QualityError, match="'month': 2"):
        jobs.check_rows(spark, paths, MONTHS)


def test_doubled_lookup_key_stops_the_load(spark, paths):
    stage(spark, paths, dated(spark, 20, seed=6))
    with open(paths.states, "a") as f:
        f.write("CA,California again\n")
    jobs.build_dimensions(spark, paths)
    with pytest.raises(QualityError, match="states"):
        jobs.load_months(spark, paths, MONTHS)


def test_measures_of_a_load_sort_nothing(spark, paths):
    rows = dated(spark, 20, seed=7).withColumns({"year": F.col("i94yr"), "month": F.col("i94mon")})
    keyed = jobs.fact.add_bands(jobs.fact.denormalise(rows, lookups_of(spark).checked()))
    measured = jobs._measures(keyed, [c for c in keyed.columns if c not in ("year", "month")])
    plan = plan_of(measured)
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
    strings = plan_of(jobs.quality.string_profile(keyed, by=("year", "month")))
    assert "SortAggregate" not in strings and "Sort [" not in strings


def test_row_check_and_load_leave_no_work_folder(spark, paths):
    stage(spark, paths, dated(spark, 50, seed=8))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    jobs.check_rows(spark, paths, MONTHS)
    assert not glob.glob(f"{shared_folder(spark)}/arrivalmart/*")


def test_an_empty_dimension_is_refused(spark, paths):
    stage(spark, paths, dated(spark, 50, seed=9))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    warehouse.write_dim(spark.read.parquet(paths.age).where("false"), paths.port)
    with pytest.raises(QualityError, match="no rows"):
        jobs.read_star(spark, paths)


@pytest.mark.parametrize("layout", [warehouse.CLUSTERED, warehouse.FOLDERS])
def test_slices_of_the_stored_star_reach_the_scan(spark, paths, layout):
    stage(spark, paths, dated(spark, 50, seed=10))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS, store=layout)
    plan = plan_of(marts.dice(jobs.read_star(spark, paths), [2016], [1], ["CA"]))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "arrivalstate_abbr" in line)
    folders = scan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = scan.split("PushedFilters: [")[1].split("]")[0]
    assert "year" in folders and "month" in folders
    assert "arrivalstate_abbr" in (pushed if layout == warehouse.CLUSTERED else folders)


def test_a_load_in_batches_of_months_gives_the_same_star_and_is_published_at_once(spark, paths, monkeypatch):
    rows = dated(spark, 300, seed=5)
    jobs.stage(raw_records(rows), paths, clustered=False)
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    once = table(spark, paths.visit_fact)
    monkeypatch.setattr(staging, "BATCH_ROWS", 1)
    raws = [raw_records(part) for part in staging.month_parts(rows)]
    assert len(raws) == len(MONTHS)
    made, real = [], warehouse.publish
    monkeypatch.setattr(warehouse, "publish", lambda *a: (made.append(sorted(a[-1])), real(*a))[1])
    jobs.stage(raws, paths, clustered=False)
    jobs.load_months(spark, paths, MONTHS)
    assert table(spark, paths.visit_fact) == once and made == [MONTHS]
    assert jobs.check_rows(spark, paths, MONTHS).where("matches").count() == 3
    assert not glob.glob(f"{shared_folder(spark)}/arrivalmart/*")
