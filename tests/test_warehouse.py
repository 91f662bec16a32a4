import os
import shutil

import pytest
from helpers import D, plan_of, scanned_rows
from pyspark.sql import functions as F

from arrivalmart.operators import dimensions
from arrivalmart.sources import warehouse

LAYOUTS = [warehouse.CLUSTERED, warehouse.FOLDERS]


def fact_rows(spark, *rows):
    """(year, month, state, port, visitors) as fact rows."""
    made = [
        (D(2016, 6, 1), port, "Air", 1, "Pleasure", "name", "CA", "California", 6, "F", "MEXICO", n, y, m, s)
        for y, m, s, port, n in rows
    ]
    return spark.createDataFrame(made, warehouse.FACT_SCHEMA)


def table(spark, path):
    rows = warehouse.read_fact(spark, path).collect()
    return sorted((r.year, r.month, r.arrivalstate_abbr, r.port_id, r.visitorcount) for r in rows)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_month_loaded_twice_is_loaded_once(spark, tmp_path, layout):
    path = str(tmp_path / "fact")
    rows = [(2016, 1, "CA", "1_A", 3), (2016, 1, "FL", "1_B", 2), (2016, 2, "CA", "1_A", 1)]
    for _ in range(4):
        warehouse.write_fact(fact_rows(spark, *rows), path, layout=layout)
    assert table(spark, path) == sorted(rows)


def test_reload_drops_states_the_month_no_longer_has(spark, tmp_path):
    path = str(tmp_path / "fact")
    old = [(2016, 1, "CA", "1_A", 3), (2016, 1, "FL", "1_B", 2), (2016, 2, "FL", "1_A", 1)]
    warehouse.write_fact(fact_rows(spark, *old), path)
    warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_C", 9)), path)
    assert table(spark, path) == [(2016, 1, "CA", "1_C", 9), (2016, 2, "FL", "1_A", 1)]


def test_named_month_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_A", 3), (2016, 2, "CA", "1_A", 1)), path)
    warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_A", 4)), path, months=[(2016, 1), (2016, 2)])
    assert table(spark, path) == [(2016, 1, "CA", "1_A", 4)]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("state", ["01", "a/b c%d=e", "é", "x:y"])
def test_state_names_survive(spark, tmp_path, state, layout):
    path = str(tmp_path / "fact")
    rows = [(-1, -1, state, "1_A", 3), (2016, 1, state, "1_A", 3)]
    for _ in range(2):
        warehouse.write_fact(fact_rows(spark, *rows), path, layout=layout)
    assert table(spark, path) == rows


def test_slices_read_their_own_folders_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_A", 3), (2016, 2, "FL", "1_B", 2)), path, layout=warehouse.FOLDERS)
    month = warehouse.read_fact(spark, path, [(2016, 1)])
    assert all("month=1" in f for f in month.inputFiles()) and month.count() == 1
    plan = plan_of(warehouse.read_fact(spark, path).where("year = 2016 AND month = 1 AND arrivalstate_abbr = 'CA'"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(column in filters for column in ("year", "month", "arrivalstate_abbr"))
    assert "DataFilters: []" in plan


def many_rows(spark, n, state):
    """Rows of one month with an own port each hundred, a state given by an expression of the row's number."""
    one = fact_rows(spark, (2016, 1, "CA", "1_A", 1)).first().asDict()
    made = {"countryofresidence": F.sha2(F.col("id").cast("string"), 256), "arrivalstate_abbr": F.expr(state), "port_id": F.expr("concat('1_', id div 100)")}
    return spark.range(0, n, 1, 8).select(*[made.get(c, F.lit(v)).alias(c) for c, v in one.items()])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_state_with_most_rows_is_split_over_files(spark, tmp_path, layout):
    path = str(tmp_path / "fact")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256KB")
    try:
        warehouse.write_fact(many_rows(spark, 60000, "'CA'"), path, layout=layout)
    finally:
        spark.conf.set(size, before)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) > 3
    assert warehouse.read_fact(spark, path).count() == 60000


def test_a_slice_of_the_clustered_layout_reads_only_the_row_groups_it_meets(spark, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.write_fact(many_rows(spark, 60000, "concat('S', lpad(id % 50, 2, '0'))"), path, group_bytes=32 << 10)
    whole = warehouse.read_fact(spark, path)
    assert scanned_rows(whole) == 60000
    for states in (["S07"], ["S07", "S31"], ["none"]):
        some = whole.where(F.col("arrivalstate_abbr").isin(states))
        held = some.count()
        assert held == 1200 * sum(s in ("S07", "S31") for s in states)
        assert held <= scanned_rows(some) <= 4 * held


def test_date_dim_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "date")
    for months in ([(2016, 1), (2016, 2)], [(2016, 2)]):
        warehouse.write_date_dim(dimensions.date_dim(dimensions.months_table(spark, months)), path)
    days = warehouse.read_date_dim(spark, path)
    assert days.count() == 60 == days.select("date_id").distinct().count()
    assert dict(days.dtypes)["month"] == "int"


def test_empty_and_null_states_are_the_unknown_state_and_lose_nobody(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(2016, 1, "CA", "1_A", 3), (2016, 1, "", "1_B", 2), (2016, 1, None, "1_C", 4), (2016, 2, "", "1_D", 5)]
    for _ in range(2):
        warehouse.write_fact(fact_rows(spark, *rows), path)
    assert table(spark, path) == sorted((y, m, s or "unknown", p, n) for y, m, s, p, n in rows)
    warehouse.write_fact(fact_rows(spark, (2016, 1, None, "1_E", 9)), path)
    assert table(spark, path) == [(2016, 1, "unknown", "1_E", 9), (2016, 2, "unknown", "1_D", 5)]


def test_foreign_files_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_A", 3)), path)
    markers = [os.path.join(path, "current", "_marker"), os.path.join(path, "current", "a.b.c.d"), os.path.join(path, "data", "_marker")]
    for marker in markers:
        open(marker, "w").close()
    for n in (4, 5, 6):
        warehouse.write_fact(fact_rows(spark, (2016, 1, "FL", "1_A", n)), path)
    assert warehouse.remove_unnamed(spark, path) == []
    assert all(map(os.path.exists, markers)) and table(spark, path) == [(2016, 1, "FL", "1_A", 6)]


def test_layouts_may_differ_by_month_and_change(spark, tmp_path):
    path = str(tmp_path / "fact")
    months = [(2016, 1, "CA", "1_A", 3), (2016, 1, "FL", "1_A", 1)], [(2016, 2, "CA", "1_B", 5)]
    for layouts in (LAYOUTS, LAYOUTS[::-1]):
        for rows, layout in zip(months, layouts, strict=True):
            warehouse.write_fact(fact_rows(spark, *rows), path, layout=layout)
        assert table(spark, path) == sorted(months[0] + months[1])
        assert warehouse.read_fact(spark, path).columns == [f.name for f in fact_rows(spark, *months[0]).schema]


def test_null_months_and_empty_facts(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert table(spark, path) == []
    rows = [(None, None, "CA", "1_A", 3)]
    for _ in range(2):
        warehouse.write_fact(fact_rows(spark, *rows), path)
    assert warehouse.read_fact(spark, path).count() == 1 == warehouse.read_fact(spark, path, [(None, None)]).count()
    warehouse.write_fact(fact_rows(spark, *rows).where("false"), path, months=[(2016, 1)])
    assert warehouse.read_fact(spark, path, [(2016, 1)]).count() == 0
    with pytest.raises(ValueError, match="layout"):
        warehouse.write_fact(fact_rows(spark, *rows), path, layout="heap")


def test_a_reader_keeps_the_version_it_has_resolved(spark, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_A", 1)), path)
    held = warehouse.read_fact(spark, path)
    warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_A", 2)), path)
    assert [r.visitorcount for r in held.collect()] == [1]
    for n in (3, 4, 5):
        warehouse.write_fact(fact_rows(spark, (2016, 1, "CA", "1_A", n)), path)
    folders = [f for f, _, names in os.walk(path) if any(n.endswith(".parquet") for n in names)]
    assert len(folders) == warehouse.VERSIONS_KEPT and table(spark, path) == [(2016, 1, "CA", "1_A", 5)]


class Killed(Exception):
    pass


class Dying:
    """A file system that dies before its n-th change, or is not reached by it."""

    CHANGES = ("create", "mkdirs", "rename", "delete")

    def __init__(self, files, left):
        self.files, self.left = files, left

    def __getattr__(self, name):
        def change(*arguments):
            if not self.left:
                raise Killed(name)
            self.left -= 1
            return getattr(self.files, name)(*arguments)

        return change if name in self.CHANGES else getattr(self.files, name)


def test_a_load_killed_at_any_step_leaves_each_month_old_or_new(spark, tmp_path, monkeypatch):
    real, step, finished = warehouse.hadoop_files, 0, False
    old = [(2016, 1, "CA", "1_A", 1), (2016, 1, "FL", "1_A", 2), (2016, 2, "FL", "1_B", 3), (2016, 3, "TX", "1_B", 9)]
    new = [(2016, 1, "CA", "1_A", 7), (2016, 2, "NY", "1_B", 8), (2016, 2, "FL", "1_B", 6)]
    old_then = {m: [r for r in old if r[:2] == m] for m in ((2016, 1), (2016, 2), (2016, 3))}
    new_then = {m: [r for r in new if r[:2] == m] for m in old_then}
    before = str(tmp_path / "before")
    for rows in ([(2016, 1, "WA", "1_Z", 99), (2016, 3, "WA", "1_Z", 99)], old):
        warehouse.write_fact(fact_rows(spark, *rows).coalesce(1), before)
    while not finished:
        path = str(tmp_path / f"fact-{step}")
        shutil.copytree(before, path)
        dying = Dying(real(spark, path)[0], step)
        monkeypatch.setattr(warehouse, "hadoop_files", lambda s, p, d=dying: (d, real(s, p)[1]))
        try:
            # The third month is emptied.
            warehouse.write_fact(fact_rows(spark, *new).coalesce(1), path, months=[(2016, 3)])
            finished = True
        except Killed:
            pass
        monkeypatch.setattr(warehouse, "hadoop_files", real)
        found = table(spark, path)
        by_month = {m: [r for r in found if r[:2] == m] for m in old_then}
        for month, rows in by_month.items():
            assert rows in (sorted(old_then[month]), sorted(new_then[month])), (step, month)
        left = {month: rows for month, rows in by_month.items() if rows == sorted(new_then[month])}
        assert list(left) == list(by_month)[: len(left)]
        # Whatever is left over is removed, and the load can be repeated.
        warehouse.remove_unnamed(spark, path)
        assert table(spark, path) == found
        if step % 4 == 0:
            warehouse.write_fact(fact_rows(spark, *new).coalesce(1), path, months=[(2016, 3)])
            assert table(spark, path) == sorted(new)
        step += 1
    assert step > 8


def test_a_load_killed_before_its_files_are_complete_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(2016, 1, "CA", "1_A", 3)]
    warehouse.write_fact(fact_rows(spark, *rows), path)
    broken = fact_rows(spark, (2016, 1, "CA", "1_A", 4)).withColumn("visitorcount", F.expr("raise_error('killed')").cast("bigint"))
    with pytest.raises(Exception, match="killed"):
        warehouse.write_fact(broken, path)
    assert table(spark, path) == rows
    warehouse.remove_unnamed(spark, path)
    assert len(os.listdir(f"{path}/data")) == 1 and table(spark, path) == rows
