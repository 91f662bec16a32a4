"""Small literal tables for the operator tests."""

import datetime

from arrivalmart.functions.codes import VISIT_FIELDS
from arrivalmart.operators import dimensions
from arrivalmart.sources import lookups

D = datetime.date

VISIT_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in VISIT_FIELDS)
DEFAULT_VISIT = {
    "cicid": 1,
    "i94yr": 2016,
    "i94mon": 6,
    "i94cit": 101,
    "i94res": 101,
    "i94port": "LOS",
    "arrdate": D(2016, 6, 1),
    "i94mode": 1,
    "i94addr": "CA",
    "depdate": D(2016, 6, 6),
    "i94bir": 30,
    "i94visa": 2,
    "matflag": "M",
    "biryear": 1986,
    "gender": "F",
    "insnum": "unknown",
    "airline": "AA",
    "admnum": 10,
    "fltno": "12",
    "visatype": "B2",
}
PORT_SCHEMA = (
    "code string, latitude double, longitude double, place string, city string, "
    "county_name string, state_id string, state_name string, country_code string, country string"
)
PORTS = [
    ("LOS", 34.0, -118.2, "LOS ANGELES, CA", "Los Angeles", "LA", "CA", "California", "US", "United States"),
    ("SFR", 37.7, -122.4, "SAN FRANCISCO, CA", "San Francisco", "SF", "CA", "California", "US", "United States"),
    ("MIA", 25.7, -80.2, "MIAMI, FL", "Miami", "Dade", "FL", "Florida", "US", "United States"),
    ("CLG", 51.0, -114.0, "CALGARY, CANADA", "Calgary", None, None, None, "CA", "Canada"),
    ("XXX", None, None, "NOT REPORTED/UNKNOWN", None, None, None, None, None, None),
]
STATES = [("CA", "California"), ("FL", "Florida")]
COUNTRIES = [(101, "ALBANIA"), (582, "MEXICO")]


def visits(spark, *changes):
    rows = [tuple({**DEFAULT_VISIT, "cicid": i, **c}.values()) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, VISIT_SCHEMA)


def ports(spark, rows=PORTS):
    return spark.createDataFrame(rows, PORT_SCHEMA)


def lookups_of(spark, port_rows=PORTS):
    return lookups.Lookups.of(
        spark,
        dimensions.port_dim(ports(spark, port_rows)),
        spark.createDataFrame(STATES, "state_id string, state_name string"),
        spark.createDataFrame(COUNTRIES, "code int, i94ctry string"),
    )


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan):
    """The file scans of an executed plan, adaptive stages opened."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _scans(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _scans(plan.plan())
    children = plan.children()
    found = [s for k in range(children.size()) for s in _scans(children.apply(k))]
    return [*found, plan] if name == "FileSourceScanExec" else found


def scanned_rows(df):
    """Rows that the file scans of a query give out while it runs, which leaves out row groups and pages that are skipped."""
    df.collect()
    return sum(s.metrics().apply("numOutputRows").value() for s in _scans(df._jdf.queryExecution().executedPlan()))
