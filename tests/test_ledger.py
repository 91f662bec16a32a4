import os

import pytest
from helpers import visits
from pyspark.sql import functions as F
from test_jobs import MONTHS, dated, paths, stage
from test_warehouse import table

from arrivalmart.plans import jobs
from arrivalmart.sources import ledger, staging, warehouse

__all__ = ["paths"]


@pytest.fixture()
def calls(monkeypatch):
    """Months that were read for the ledger, and months that were loaded."""
    made = {"read": [], "loaded": []}
    read, load = ledger.summed_up, jobs.load_months
    monkeypatch.setattr(ledger, "summed_up", lambda s, p, months, layout: (made["read"].append(sorted(months)), read(s, p, months, layout))[1])
    monkeypatch.setattr(jobs, "load_months", lambda s, p, months, *rest: (made["loaded"].append(sorted(months)), load(s, p, months, *rest))[1])
    return made


def test_only_changed_months_are_loaded(spark, paths, calls):
    stage(spark, paths, dated(spark, 120, seed=1))
    jobs.build_dimensions(spark, paths)
    assert jobs.load_changed(spark, paths).changed == MONTHS and calls == {"read": [MONTHS], "loaded": [MONTHS]}
    before = table(spark, paths.visit_fact)

    # Nothing has changed: no file is opened, nothing loaded.
    found = jobs.load_changed(spark, paths)
    assert (found.changed, found.touched, found.gone) == ([], [], []) and len(calls["read"]) == len(calls["loaded"]) == 1

    # The rows of a month in other files, dealt differently: the month is loaded again, and the others aren't read.
    again = staging.read_visits(spark, paths.staged, MONTHS[1:2])
    again = spark.createDataFrame(again.collect(), again.schema).repartition(3)
    staging.write_staged(again, paths.staged)
    assert jobs.load_changed(spark, paths).changed == MONTHS[1:2] and calls["read"][1:] == calls["loaded"][1:] == [MONTHS[1:2]]
    assert table(spark, paths.visit_fact) == before


def test_a_touched_file_is_read_and_not_loaded(spark, paths, calls):
    stage(spark, paths, dated(spark, 60, seed=2))
    jobs.build_dimensions(spark, paths)
    jobs.load_changed(spark, paths)
    folder = f"{paths.staged}/year=2016/month=2"
    for name in os.listdir(folder):
        if name.endswith(".csv"):
            os.utime(f"{folder}/{name}", (1, 1))
    found = jobs.load_changed(spark, paths)
    assert (found.changed, found.touched) == ([], [(2016, 2)]) and calls["read"][1:] == [[(2016, 2)]] and len(calls["loaded"]) == 1
    assert jobs.load_changed(spark, paths).touched == [] and len(calls["read"]) == 2


def test_one_changed_file_reloads_its_month(spark, paths, calls):
    stage(spark, paths, dated(spark, 60, seed=3))
    jobs.build_dimensions(spark, paths)
    jobs.load_changed(spark, paths)
    corrected = visits(spark, {"i94mon": 2}, {"i94mon": 2}).withColumn("arrdate", F.lit("2016-02-03").cast("date"))
    stage(spark, paths, corrected)
    assert jobs.load_changed(spark, paths).changed == [(2016, 2)] and calls["loaded"][1:] == [[(2016, 2)]]
    assert warehouse.read_fact(spark, paths.visit_fact, [(2016, 2)]).agg(F.sum("visitorcount")).first()[0] == 2


def test_a_load_that_fails_is_done_again(spark, paths, calls, monkeypatch):
    stage(spark, paths, dated(spark, 40, seed=4))
    jobs.build_dimensions(spark, paths)
    real = warehouse.write_fact
    monkeypatch.setattr(warehouse, "write_fact", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        jobs.load_changed(spark, paths)
    monkeypatch.setattr(warehouse, "write_fact", real)
    assert jobs.load_changed(spark, paths).changed == MONTHS


def test_a_month_that_is_no_longer_staged_is_named(spark, paths):
    stage(spark, paths, dated(spark, 40, seed=5))
    jobs.build_dimensions(spark, paths)
    jobs.load_changed(spark, paths)
    before = table(spark, paths.visit_fact)
    folder = f"{paths.staged}/year=2016/month=3"
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    found = jobs.load_changed(spark, paths)
    assert (found.changed, found.gone) == ([], [(2016, 3)]) and table(spark, paths.visit_fact) == before


def test_month_folders_of_the_other_layout(spark, tmp_path):
    for month, text in (("2016/01", "a\n1\n2\n"), ("2016/12", "a\n1\n")):
        os.makedirs(tmp_path / month)
        (tmp_path / month / "x.csv").write_text(text)
        (tmp_path / month / "x.txt").write_text("no staged file")
    found = ledger.changes(spark, str(tmp_path), str(tmp_path / "none"), "folders")
    assert found.changed == [(2016, 1), (2016, 12)]
    assert sorted((r.year, r.month, r.size, r.lines) for r in found.rows.collect()) == [(2016, 1, 6, 3), (2016, 12, 4, 2)]


def test_differing_groups_of_a_spoiled_fact_are_named_and_profiles_need_no_visits(spark, paths):
    stage(spark, paths, dated(spark, 150, seed=6))
    jobs.build_dimensions(spark, paths)
    jobs.load_months(spark, paths, MONTHS)
    assert jobs.differing_groups(spark, paths, MONTHS).count() == 0
    whole = {r.field: r for r in jobs.profile_months(spark, paths).collect()}
    assert whole["i94yr"].rows == 150 and whole["i94yr"].mean == 2016
    assert jobs.profile_months(spark, paths, MONTHS[:1], ("month",)).where("month <> 1 OR rows <> numbers AND field = 'i94yr'").count() == 0
    stored = spark.createDataFrame(warehouse.read_fact(spark, paths.visit_fact).collect(), warehouse.FACT_SCHEMA)
    first = stored.where("month = 2").first()
    same = [F.col(c).eqNullSafe(F.lit(first[c])) for c in stored.columns]
    is_first = same[0]
    for test in same[1:]:
        is_first = is_first & test
    spoiled = stored.withColumn("visitorcount", F.when(is_first, F.col("visitorcount") + 5).otherwise(F.col("visitorcount")))
    warehouse.write_fact(spoiled, paths.visit_fact)
    (row,) = jobs.differing_groups(spark, paths, MONTHS).collect()
    assert row.right_rows == row.left_rows + 5 == first.visitorcount + 5 and row.port_id == first.port_id
