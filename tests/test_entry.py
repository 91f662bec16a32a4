"""Every registered query against its DuckDB text, and the shape of its plan."""

import glob
import math
import os
import sys

import duckdb
import pytest
from helpers import plan_of

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from arrivalmart.sources import workspace
from driver_binding import oracle as driver_oracle
from driver_binding import queries as driver_queries

SF_DIR = "/root/testdata/sf0.001"
# The optional operators have tests of their own.
QUERIES, ORACLE = driver_queries.QUERIES, driver_oracle.texts()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows):
    def value(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(value(v) for v in row) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle_and_plan_stays_declarative(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})")
    types = {d[0]: str(d[1]) for d in expected.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema} == types
    assert canonical(result.select(*columns).collect()) == canonical(expected.fetchall())
    plan = plan_of(result)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "Window"):
        assert operator not in plan
    workspace.sweep(spark)
    folder = os.path.join(workspace.shared_folder(spark), "arrivalmart")
    assert not os.path.isdir(folder) or not os.listdir(folder)


def test_flagship(spark):
    assert entry.entry(spark).count() == 5975
