"""Queries that join, stage and load in passes, against their DuckDB texts where the tables take several passes."""

import glob

import pytest
from test_entry import ORACLE, QUERIES, SF_DIR, canonical, duck

from arrivalmart.operators import fact
from arrivalmart.sources import staging, workspace
from driver_binding import views

__all__ = ["duck"]


@pytest.mark.parametrize("name", ["load_profiles", "changed_months"])
def test_results_in_passes_equal_the_oracle(spark, duck, name, monkeypatch):
    monkeypatch.setattr(views, "PASS_ROWS", 2_500)
    monkeypatch.setattr(staging, "BATCH_ROWS", 2_500)
    staged, counted = [], []
    write, build = staging.write_staged, fact.build_fact
    monkeypatch.setattr(staging, "write_staged", lambda *a, **b: (staged.append(0), write(*a, **b))[1])
    monkeypatch.setattr(fact, "build_fact", lambda *a: (counted.append(0), build(*a))[1])
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})")
    assert canonical(result.select(*columns).collect()) == canonical(expected.fetchall())
    assert len(staged) > 2 and (name != "load_profiles" or len(counted) > 2)
    kept = glob.glob(f"{workspace.shared_folder(spark)}/arrivalmart/visits-*") + glob.glob(f"{workspace.shared_folder(spark)}/arrivalmart/parsed-*")
    assert not kept
    workspace.sweep(spark)
