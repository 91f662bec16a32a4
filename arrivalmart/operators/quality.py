"""Data quality: guards, column profiles and reconciliation from source to fact.

Reports are DataFrames; :func:`raise_on_failure` turns a report with a ``matches`` column into an
error. All measures of a profile come from one aggregate, so one scan serves every report.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivalmart.functions.bands import Bands
from arrivalmart.functions.codes import CASTABLE, FRACTION, MISSING, UNKNOWN

# Check names in report order, and the profiled columns.
CHECKS = ("isnan", "isnull", "emptystring", "unknownstring", "nan_as_-1")
NUMERIC_COLUMNS = (
    "i94yr",
    "i94mon",
    "i94mode",
    "i94bir",
    "biryear",
    "i94visa",
    "admnum",
    "visitduration_id",
    "age_id",
)
STRING_COLUMNS = (
    "i94addr",
    "gender",
    "airline",
    "fltno",
    "visatype",
    "visitpurpose",
    "mode",
    "port_id",
    "arrivalstate",
    "arrivalstate_abbr",
    "firstdeststate",
    "firstdeststate_abbr",
    "citizen_ctry",
    "countryofresidence",
    "insnum",
    "matflag",
)


# A band dimension and the visit column it bands.
Banded = tuple[Bands, str]


HASHED = "hashed"


class QualityError(RuntimeError):
    """A guard or a reconciliation failed."""


# Guards


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The same DataFrame, or an error if it holds no row; reads until the first row only."""
    if df.isEmpty():
        raise QualityError(f"no rows in {name}")
    return df


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The same DataFrame, or an error if a key occurs twice; a null key joins nothing and may."""
    twice = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = twice.where("n > 1").limit(5).collect()
    if found:
        raise QualityError(f"more than one row per {', '.join(keys)} in {name}: {found}")
    return df


def guard_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table and whether it holds any row."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("ok")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def raise_on_failure(report: DataFrame, name: str) -> DataFrame:
    """The same report, or an error that shows some of the rows that do not match."""
    failed = report.where(~F.coalesce(F.col("matches"), F.lit(False))).limit(5).collect()
    if failed:
        raise QualityError(f"{name} failed: {[row.asDict() for row in failed]}")
    return report


# Profiles


# Measures and report cells are SQL text: there are hundreds of them, and one parsed expression costs
# the driver far less than the column calls it stands for.


def _name(column: str) -> str:
    return f"`{column}`"


def _check(check: str, field: T.StructField) -> str | None:
    """Condition counted by a check, or None where the type cannot hold such a value."""
    value = _name(field.name)
    floating = isinstance(field.dataType, (T.FloatType, T.DoubleType))
    text = isinstance(field.dataType, T.StringType)
    if check == "isnan":
        return f"isnan({value})" if floating else None
    if check == "isnull":
        return f"{value} IS NULL"
    if check == "emptystring":
        return f"{value} = ''" if text else None
    if check == "unknownstring":
        return f"{value} = '{UNKNOWN}'" if text else None
    if text:
        # Compared as text: a cast that fails raises and catches an exception on every row.
        # The pattern costs ten times the search for its minus, which few values have.
        return f"contains({value}, '-') AND {value} RLIKE r'^\\s*-0*{-MISSING}(\\.\\d*)?\\s*$'"
    return f"{value} = {MISSING}" if isinstance(field.dataType, T.NumericType) else None


def missing_measures(schema: T.StructType) -> list[Column]:
    tests = {f"{check}:{field.name}": _check(check, field) for check in CHECKS for field in schema}
    return [
        F.count(F.lit(1)).alias("totalrows"),
        *[F.expr(f"count_if({test}) AS {_name(key)}") for key, test in tests.items() if test],
    ]


def whole_number(schema: T.StructType, name: str) -> str:
    """A column as a number, SQL text; text is read as a whole number where it is one."""
    value = _name(name)
    if isinstance(schema[name].dataType, T.StringType):
        fits = f"{value} RLIKE r'{CASTABLE['bigint']}'"
        value = f"try_cast(regexp_replace(CASE WHEN {fits} THEN {value} END, r'{FRACTION}', '') AS BIGINT)"
    return value


def numeric_measures(schema: T.StructType, columns: Iterable[str]) -> list[Column]:
    """Measures of number columns."""
    measures = []
    for name in columns:
        value = whole_number(schema, name)
        parts = {
            "count": f"count({value})",
            "mean": f"avg({value})",
            "stddev": f"stddev_samp({value})",
            "min": f"min({value})",
            "max": f"max({value})",
        }
        measures += [
            F.expr(f"CAST({part} AS DOUBLE) AS {_name(f'numeric:{summary}:{name}')}")
            for summary, part in parts.items()
        ]
    return measures


def hashed() -> Column:
    """A measure that has an aggregate with minima of text hash its groups instead of sorting all its rows.

    Spark hashes groups whose buffers are objects, such as this set of one constant, as long as a task meets no more of them than
    ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold``. The column must be used or kept: one that is
    dropped is left out of the plan, and the sort is back.
    """
    return F.collect_set(F.lit(True)).alias(HASHED)


def string_measures(columns: Iterable[str]) -> list[Column]:
    return [
        F.expr(f"CAST({part}({_name(name)}) AS STRING) AS {_name(f'string:{part}:{name}')}")
        for part in ("count", "min", "max")
        for name in columns
    ]


def band_measures(banded: Iterable[Banded]) -> list[Column]:
    """Rows in the range of each band, counted on the values and not on band ids."""
    return [
        F.count_if(bands.holds(F.col(value), band_id)).alias(f"band:{bands.name}:{band_id}")
        for bands, value in banded
        for band_id, _ in bands.members()
    ]


def _unpivot(
    measured: DataFrame, by: Sequence[str], columns: Sequence[str], rows: Sequence[Sequence[str]]
) -> DataFrame:
    """Turn the measures of each group into report rows; cells are SQL text."""
    cells = ", ".join(cell for row in rows for cell in row)
    names = ", ".join(map(_name, columns))
    return measured.selectExpr(*map(_name, by), f"stack({len(rows)}, {cells}) AS ({names})")


def missing_report(measured: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Five rows per group: a count per column, the check and the number of rows."""
    measures = set(measured.columns)

    def count_of(check: str, name: str) -> str:
        key = f"{check}:{name}"
        return _name(key) if key in measures else "0L"

    rows = [
        [*[count_of(check, name) for name in columns], f"'{check}'", "totalrows"]
        for check in CHECKS
    ]
    return _unpivot(measured, by, [*columns, "checktype", "totalrows"], rows)


def _summary_report(
    measured: DataFrame, kind: str, summaries: Sequence[str], columns: Sequence[str], by: Sequence[str]
) -> DataFrame:
    rows = [
        [f"'{summary}'", *[_name(f"{kind}:{summary}:{name}") for name in columns]]
        for summary in summaries
    ]
    return _unpivot(measured, by, ["summary", *columns], rows)


def numeric_report(
    measured: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, by: Sequence[str] = ()
) -> DataFrame:
    """Five rows per group: count, mean, stddev, min and max of each column."""
    summaries = ("count", "mean", "stddev", "min", "max")
    return _summary_report(measured, "numeric", summaries, columns, by)


def string_report(
    measured: DataFrame, columns: Sequence[str] = STRING_COLUMNS, by: Sequence[str] = ()
) -> DataFrame:
    """Three rows per group: count, min and max of each column."""
    return _summary_report(measured, "string", ("count", "min", "max"), columns, by)


def missing_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of NaN, null, empty, 'unknown' and -1 per column, in one scan."""
    columns = [name for name in df.columns if name not in by]
    schema = T.StructType([df.schema[name] for name in columns])
    return missing_report(df.groupBy(*by).agg(*missing_measures(schema)), columns, by)


def numeric_profile(
    df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, by: Sequence[str] = ()
) -> DataFrame:
    """Count, mean, standard deviation, min and max per column; text is read as a number."""
    return numeric_report(
        df.groupBy(*by).agg(*numeric_measures(df.schema, columns)), columns, by
    )


def string_profile(
    df: DataFrame, columns: Sequence[str] = STRING_COLUMNS, by: Sequence[str] = ()
) -> DataFrame:
    """Count, min and max per text column."""
    measured = df.groupBy(*by).agg(*string_measures(columns), hashed())
    return string_report(measured.where(F.size(HASHED) > 0), columns, by)


# Reconciliation
#
# Both sides are aggregated on their own and only the totals are put together, by a union and a sum
# instead of a join. A group that one side lacks then shows up with zero.


def rows_in(visits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows read; ``visits`` has one row per visit."""
    return visits.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_in"))


def fact_totals(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fact rows and the visitors they stand for."""
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("visitorcount").alias("visitorcount")
    )


def reconcile_totals(before: DataFrame, after: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Compare :func:`rows_in` with :func:`fact_totals`, which may be by more columns than ``by``."""
    both = before.selectExpr(*by, "rows_in", "0L AS fact_rows", "0L AS visitorcount").unionByName(
        after.selectExpr(*by, "0L AS rows_in", "fact_rows", "visitorcount")
    )
    total = both.groupBy(*by).agg(
        F.expr("coalesce(sum(rows_in), 0L) AS rows_in"),
        F.expr("coalesce(sum(fact_rows), 0L) AS fact_rows"),
        F.expr("coalesce(sum(visitorcount), 0L) AS visitors"),
    )
    gone = F.col("rows_in") - F.col("fact_rows")
    return total.select(
        "*",
        F.try_divide(F.lit(100.0) * gone, F.col("rows_in")).alias("reduction_pct"),
        (F.col("rows_in") == F.col("visitors")).alias("matches"),
    )


def reconcile(visits: DataFrame, fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows read against visitors counted in the fact, and how far the fact shrank."""
    return reconcile_totals(rows_in(visits, by), fact_totals(fact, by), by)


def band_totals(fact: DataFrame, banded: Iterable[Banded], by: Sequence[str] = ()) -> DataFrame:
    """:func:`fact_totals` by all band ids at once, small enough to be read once per band."""
    return fact_totals(fact, (*by, *[bands.fact_column for bands, _ in banded]))


def reconcile_band_totals(
    measured: DataFrame, totals: DataFrame, banded: Sequence[Banded], by: Sequence[str] = ()
) -> DataFrame:
    """Compare :func:`band_measures` with :func:`band_totals`."""
    columns = ("band_name", "band_id", "rows_before", "visitors_after")
    before = [
        [f"'{bands.name}'", str(i), _name(f"band:{bands.name}:{i}"), "0L"]
        for bands, _ in banded
        for i, _ in bands.members()
    ]
    after = [
        [f"'{bands.name}'", _name(bands.fact_column), "0L", "visitorcount"] for bands, _ in banded
    ]
    both = _unpivot(measured, by, columns, before).unionByName(
        _unpivot(totals, by, columns, after)
    )
    summed = both.groupBy(*by, "band_name", "band_id").agg(
        F.sum("rows_before").alias("rows_before"), F.sum("visitors_after").alias("visitors_after")
    )
    return summed.withColumn("matches", F.col("rows_before") == F.col("visitors_after"))


def reconcile_bands(visits: DataFrame, fact: DataFrame, banded: Sequence[Banded]) -> DataFrame:
    """Rows in the value range of each band against the visitors the fact files under its id.

    Every band is checked, an empty one with zero on both sides; an id without a band shows up too.
    Visits and fact are read once each, whatever the number of band dimensions.
    """
    measured = visits.agg(*band_measures(banded))
    return reconcile_band_totals(measured, band_totals(fact, banded), banded)


def row_check(manifest: DataFrame, star) -> DataFrame:
    """Per month: rows of the source against visitors that survive all four dimension joins.

    Inner joins on purpose: a fact row without a member in some dimension is missing from the sum,
    and a dimension member that occurs twice counts twice, so both make the month differ.
    """
    fact = star.fact.select(
        "year", "month", "arrivaldate_id", "port_id", "visitduration_id", "age_id", "visitorcount"
    )
    survivors = (
        fact.join(star.age.select("age_id"), "age_id")
        .join(star.duration.select(F.col("duration_id").alias("visitduration_id")), "visitduration_id")
        .join(star.date.select(F.col("date_id").alias("arrivaldate_id")), "arrivaldate_id")
        .join(star.port.select("port_id"), "port_id")
        .groupBy("year", "month")
        .agg(F.sum("visitorcount").alias("sumvisitorcount"))
    )
    source = manifest.select(
        F.col("sas_data_year").alias("year"),
        F.col("sas_data_month").alias("month"),
        F.col("sas_data_rowcount").alias("sas_rowcount"),
    )
    matches = F.coalesce(F.col("sas_rowcount") == F.col("sumvisitorcount"), F.lit(False))
    return source.join(survivors, ["year", "month"], "full_outer").select(
        "year", "month", "sas_rowcount", "sumvisitorcount", matches.alias("matches")
    )
