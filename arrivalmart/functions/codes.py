"""Fixed values of the visit model: columns, sentinels, mode and purpose codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sentinels that travel through every table.
UNKNOWN = "unknown"
MISSING = -1
UNKNOWN_PORT = "-1_XXX"

# The twenty columns of a cleaned visit, in order, with their Spark types.
VISIT_FIELDS = (
    ("cicid", "bigint"),
    ("i94yr", "int"),
    ("i94mon", "int"),
    ("i94cit", "int"),
    ("i94res", "int"),
    ("i94port", "string"),
    ("arrdate", "date"),
    ("i94mode", "int"),
    ("i94addr", "string"),
    ("depdate", "date"),
    ("i94bir", "int"),
    ("i94visa", "int"),
    ("matflag", "string"),
    ("biryear", "int"),
    ("gender", "string"),
    ("insnum", "string"),
    ("airline", "string"),
    ("admnum", "bigint"),
    ("fltno", "string"),
    ("visatype", "string"),
)
VISIT_COLUMNS = tuple(name for name, _ in VISIT_FIELDS)

# Text that a cast can take. A cast that fails inside try_cast raises and catches an exception, about
# a hundred times the cost of the match, so text of another form is set aside before the cast. Of a
# decimal the whole part counts, so FRACTION is taken off first.
FRACTION = r"\.\d*\s*$"
CASTABLE = {
    "int": r"^\s*[+-]?\d+(\.\d*)?\s*$",
    "bigint": r"^\s*[+-]?\d+(\.\d*)?\s*$",
    "date": r"^\s*\d{4}-\d{1,2}-\d{1,2}",
}

# Mode of arrival and purpose of visit.
MODES = ((1, "Air"), (2, "Sea"), (3, "Land"), (9, "Not reported"), (-1, "unknown"))
PURPOSES = ((1, "Business"), (2, "Pleasure"), (3, "Student"), (-1, "unknown"))


def fixed_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A constant table planned inside the JVM, so no Python worker starts for it."""
    members = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(columns, row, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*members)))
