"""Staged visits: cleaning raw records, writing and reading them by month, counting them."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivalmart.functions.codes import (
    CASTABLE,
    MISSING,
    UNKNOWN,
    VISIT_COLUMNS,
    VISIT_FIELDS,
)
from arrivalmart.operators.quality import QualityError, require_rows

# Day zero of the raw date numbers and the columns of the manifest.
DAY_ZERO = datetime.date(1960, 1, 1)
MANIFEST_SCHEMA = "sas_data_year int, sas_data_month int, sas_data_rowcount bigint"

# Quotes are doubled and blanks kept; an empty field is read as null.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# A file holds about 256 MB at some 200 bytes a row. No field holds a line break (see one_line), so Spark
# splits a file of any size; a packed one, a quarter as large, is read by one task.
ROWS_PER_FILE = (256 << 20) // 200
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# Rows of the months that are dealt out in one step, see batched.
BATCH_ROWS = 1 << 25
# Signs that would break a line, and how they are written; the backslash first, so that it can be undone last.
ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))

Month = tuple[int, int]


def in_months(year: Column, month: Column, months: Iterable[Month]) -> Column:
    """Whether (year, month) is one of the given months, in a form that prunes partitions."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    if not by_year:
        return F.lit(False)
    tests = [(year == y) & month.isin(ms) for y, ms in by_year.items()]
    return reduce(lambda a, b: a | b, tests)


def batched(rows: Mapping[Month, int], most: int | None = None) -> list[list[Month]]:
    """Months in order, in batches of at most ``most`` rows, BATCH_ROWS by default; a month of more is a batch of its own."""
    most, batches, held = most or BATCH_ROWS, [], 0
    for month in sorted(rows, key=lambda m: [(v is not None, v or 0) for v in m]):
        if not batches or held + rows[month] > most:
            batches.append([])
            held = 0
        batches[-1].append(month)
        held += rows[month]
    return batches


def in_batch(year: Column, month: Column, batch: Iterable[Month]) -> Column:
    """As :func:`in_months`, whether a missing year or month is one of the batch included."""
    full = [m for m in batch if None not in m]
    missing = [year.eqNullSafe(y) & month.eqNullSafe(m) for y, m in batch if y is None or m is None]
    return reduce(lambda a, b: a | b, missing, in_months(year, month, full))


def month_parts(visits: DataFrame) -> list[DataFrame]:
    """Visits in parts of whole months, at most BATCH_ROWS rows each where months allow it; a missing year or month counts as -1, which cleaning makes of it.

    So large a part is shuffled at once if parts are staged one after the other. Visits are read once to count months, which reach the driver, and
    once for each part, and should be a table.
    """
    year, month = (F.coalesce(c, F.lit(MISSING)) for c in ("i94yr", "i94mon"))
    counted = visits.groupBy(year.alias("year"), month.alias("month")).agg(F.count(F.lit(1)).alias("n")).collect()
    batches = batched({(row["year"], row["month"]): row["n"] for row in counted})
    return [visits.where(in_batch(year, month, batch)) for batch in batches] if len(batches) > 1 else [visits]


def one_line(df: DataFrame) -> DataFrame:
    """The same rows with line breaks and backslashes in text escaped, so that a row is one line of CSV."""

    def escaped(name: str) -> Column:
        return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), ESCAPES, F.col(name)).alias(name)

    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[escaped(c) if c in text else c for c in df.columns])


def restored(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Undoes :func:`one_line` in some text columns, or all: after it each backslash is followed by its letter, so nothing is ambiguous."""

    def plain(name: str) -> Column:
        return reduce(lambda c, pair: F.replace(c, F.lit(pair[1]), F.lit(pair[0])), reversed(ESCAPES), F.col(name)).alias(name)

    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    text &= text if columns is None else set(columns)
    return df.select(*[plain(c) if c in text else c for c in df.columns])


def clean_visits(raw: DataFrame) -> DataFrame:
    """Twenty typed columns from raw records.

    Day numbers become dates and stay null when missing, missing text becomes ``'unknown'`` and a
    missing number, null or NaN, becomes -1.
    """

    def clean(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind == "string":
            return F.coalesce(value, F.lit(UNKNOWN)).alias(name)
        if isinstance(raw.schema[name].dataType, (T.FloatType, T.DoubleType)):
            value = F.nanvl(value, F.lit(None))
        if kind == "date":
            return F.date_add(F.lit(DAY_ZERO), value.try_cast("int")).alias(name)
        return F.coalesce(value.try_cast(kind), F.lit(MISSING).cast(kind)).alias(name)

    return raw.select(*[clean(name, kind) for name, kind in VISIT_FIELDS])


def write_staged(
    visits: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    clustered: bool = True,
    packed: bool = False,
) -> list[Month]:
    """Write CSV by month, at most ``rows_per_file`` rows a file; a month written again is replaced.

    Gives the months written, which the same pass observes; they reach the driver, as many as there are. Raw records that arrive one month per file are already ``clustered`` and need no shuffle. Mixed
    input is rebalanced by month first, which also splits a month that is too big for one task. ``packed`` files are compressed.
    """
    out = visits.select("*", F.col("i94yr").alias("year"), F.col("i94mon").alias("month"))
    if not clustered:
        out = out.hint("rebalance", "year", "month")
    # After the shuffle, so that the stage before it stays within what the JVM compiles, see _typed.
    out = one_line(out)
    seen = Observation()
    out = out.observe(seen, F.collect_set(F.struct("year", "month")).alias("months"))
    (
        out.write.mode("overwrite")
        .options(**CSV_OPTIONS, **(PACKED if packed else {}), partitionOverwriteMode="dynamic", maxRecordsPerFile=rows_per_file)
        .partitionBy("year", "month")
        .csv(path)
    )
    return sorted(((row.year, row.month) for row in seen.get["months"]), key=str)


def _typed(staged: DataFrame) -> DataFrame:
    """Typed columns of text ones.

    All of them become one generated method, and the JVM never compiles one of over 8,000 bytes: each column has one pattern, which
    allows one point at most, and cuts there.
    """

    def typed(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind == "string":
            return value
        whole = value if kind == "date" else F.substring_index(value, ".", 1)
        return F.when(value.rlike(CASTABLE[kind]), whole).try_cast(kind).alias(name)

    columns = [typed(name, kind) for name, kind in VISIT_FIELDS]
    return staged.select(*columns).withColumn("fltno", F.ltrim("fltno", F.lit("0")))


def _by_header(spark: SparkSession, paths: str | list[str], columns: Sequence[str]) -> DataFrame:
    """The columns named, as text, of CSV files in whatever order their header has them; other columns are left out.

    The header of the first file is taken, a name it lacks is an error, and so is a file whose header
    differs from it, which is found when that file is read.
    """
    # Named by Spark where a header has no name, as an index column does; the schema takes the empty name.
    found = spark.read.options(**CSV_OPTIONS).csv(paths)
    header = [c for c in found.columns if c not in ("year", "month")]
    if missing := [c for c in columns if c not in header]:
        raise QualityError(f"no column {', '.join(missing)} in the header of {paths}: {header}")
    unnamed = {f"_c{at}": "" for at in range(len(header))}
    schema = T.StructType([T.StructField(unnamed.get(c, c), T.StringType()) for c in header])
    return spark.read.options(**CSV_OPTIONS, enforceSchema=False).schema(schema).csv(paths)


def read_visits(
    spark: SparkSession,
    path: str,
    months: Iterable[Month] | None = None,
    layout: str = "partitioned",
) -> DataFrame:
    """Staged visits as twenty typed columns; bad numbers and dates become null, no rows an error.

    Columns are found by the name in the header. ``partitioned`` is what :func:`write_staged` writes; only the
    folders of ``months`` are listed in the scan. ``folders`` is ``<path>/<yyyy>/<mm>/*.csv``, with or
    without an index column, the text as it is.
    """
    if layout == "partitioned":
        text = [f"{name} string" for name in VISIT_COLUMNS]
        schema = ", ".join([*text, "year int", "month int"])
        staged = spark.read.options(**CSV_OPTIONS, enforceSchema=False).schema(schema).csv(path)
        if months is not None:
            staged = staged.where(in_months(F.col("year"), F.col("month"), months))
        staged = restored(staged, [name for name, kind in VISIT_FIELDS if kind == "string"])
    elif layout == "folders":
        if months is None:
            globs = [f"{path}/*/*/*.csv"]
        else:
            globs = [f"{path}/{year:d}/{month:02d}/*.csv" for year, month in months]
        staged = _by_header(spark, globs, VISIT_COLUMNS)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return _typed(require_rows(staged, path))


def row_manifest(visits: DataFrame) -> DataFrame:
    """Rows per month of the source."""
    return visits.groupBy(
        F.col("i94yr").alias("sas_data_year"), F.col("i94mon").alias("sas_data_month")
    ).agg(F.count(F.lit(1)).alias("sas_data_rowcount"))


def staged_manifest(spark: SparkSession, path: str, months: Iterable[Month]) -> DataFrame:
    """Rows per month as :func:`write_staged` has written them; only lines are counted, no column is parsed."""
    schema = ", ".join([*[f"{name} string" for name in VISIT_COLUMNS], "year int", "month int"])
    staged = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    return staged.where(in_months(F.col("year"), F.col("month"), months)).groupBy(
        F.col("year").alias("sas_data_year"), F.col("month").alias("sas_data_month")
    ).agg(F.count(F.lit(1)).alias("sas_data_rowcount"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One CSV folder per month, so a month staged again replaces its own count."""
    keyed = manifest.select(
        "*", F.col("sas_data_year").alias("year"), F.col("sas_data_month").alias("month")
    )
    (
        keyed.write.mode("overwrite")
        .options(header=True, partitionOverwriteMode="dynamic")
        .partitionBy("year", "month")
        .csv(path)
    )


def read_manifest(
    spark: SparkSession, path: str, months: Iterable[Month] | None = None
) -> DataFrame:
    """The manifest rows, of the given months only if any are named."""
    counts = spark.read.schema(MANIFEST_SCHEMA).csv(
        path, header=True, recursiveFileLookup=True, enforceSchema=False
    )
    if months is None:
        return counts
    return counts.where(in_months(F.col("sas_data_year"), F.col("sas_data_month"), months))
