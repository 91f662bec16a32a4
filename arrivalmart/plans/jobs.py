"""The jobs of the warehouse: stage, dimensions, monthly load, row check, extract.

Each is a function on a session and a set of paths; any scheduler can call them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalmart.functions.bands import AGE, DURATION
from arrivalmart.functions.codes import UNKNOWN
from arrivalmart.operators import differences, dimensions, fact, marts, quality, states
from arrivalmart.sources import ledger, lookups, staging, warehouse
from arrivalmart.sources.staging import Month
from arrivalmart.sources.workspace import kept, kept_parts, shuffles_removed, work_folder

BANDED_VALUES = ((DURATION, "duration_days"), (AGE, "i94bir"))
BY_MONTH = ("year", "month")


# Folders of the warehouse below its root.
LAYOUT = {
    "staged": "staged/visits",
    "manifest": "staged/manifest",
    "ports": "lookups/ports.csv",
    "states": "lookups/states.csv",
    "countries": "lookups/countries.csv",
    "visit_fact": "warehouse/visit_fact",
    "date": "warehouse/date",
    "port": "warehouse/port",
    "age": "warehouse/age",
    "duration": "warehouse/duration",
    "states_of_months": "warehouse/profile",
    "ledger": "warehouse/ledger",
    "logs": "logs",
    "extracts": "extracts",
}


@dataclass(frozen=True)
class Paths:
    """Where each table lives."""

    staged: str
    manifest: str
    ports: str
    states: str
    countries: str
    visit_fact: str
    date: str
    port: str
    age: str
    duration: str
    states_of_months: str
    ledger: str
    logs: str
    extracts: str

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(**{name: f"{root}/{folder}" for name, folder in LAYOUT.items()})


def stage(raw: DataFrame | Sequence[DataFrame], paths: Paths, clustered: bool = True) -> None:
    """Clean raw records, write them by month, compressed, and count the rows written for each month; raw records are read once.

    Several tables of raw records, which have no month in common, are staged one after the other, each within the disk that its own rows need.
    """
    parts = [raw] if isinstance(raw, DataFrame) else raw
    spark = parts[0].sparkSession
    with shuffles_removed(spark):
        written = [staging.write_staged(staging.clean_visits(part), paths.staged, clustered=clustered, packed=True) for part in parts]
        months = sorted({month for of_part in written for month in of_part}, key=str)
        counted = staging.staged_manifest(spark, paths.staged, months)
        staging.write_manifest(counted, paths.manifest)


def build_dimensions(spark: SparkSession, paths: Paths) -> None:
    """Write the port, age and duration dimensions."""
    ports = lookups.read_lookup(spark, paths.ports, lookups.PORT_COLUMNS)
    ports = ports.withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude")})
    warehouse.write_dim(dimensions.port_dim(ports), paths.port)
    for bands, path in ((AGE, paths.age), (DURATION, paths.duration)):
        warehouse.write_dim(dimensions.band_dim(spark, bands), path)


def read_lookups(spark: SparkSession, paths: Paths) -> lookups.Lookups:
    """The lookups of the fact, around the port dimension already written.

    Their keys are checked to be unique, so the left joins give back exactly the rows read and the
    rows counted after them are the rows of the source.
    """
    ports = quality.require_rows(spark.read.parquet(paths.port), paths.port)
    states = lookups.read_lookup(spark, paths.states, lookups.STATE_COLUMNS)
    countries = lookups.read_lookup(
        spark, paths.countries, lookups.COUNTRY_COLUMNS, sep="|", int_key="code"
    )
    return lookups.Lookups.of(spark, ports, states, countries).unique().checked()


def read_star(
    spark: SparkSession, paths: Paths, months: Iterable[Month] | None = None
) -> marts.Star:
    """The star as written, its dimensions sized for broadcast; an empty dimension is an error."""
    dimension = {
        "port": spark.read.parquet(paths.port),
        "age": spark.read.parquet(paths.age),
        "duration": spark.read.parquet(paths.duration),
        "date": warehouse.read_date_dim(spark, paths.date),
    }
    for name, table in dimension.items():
        quality.require_rows(table, getattr(paths, name))
    return marts.Star(fact=warehouse.read_fact(spark, paths.visit_fact, months), **dimension).checked()


def _write_log(report: DataFrame, paths: Paths, name: str) -> None:
    (
        report.coalesce(1)
        .write.mode("overwrite")
        .options(header=True, partitionOverwriteMode="dynamic")
        .partitionBy(*BY_MONTH)
        .csv(f"{paths.logs}/{name}")
    )


def _measures(banded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every measure the profiles and band checks of a load need, one row per month."""
    schema = banded.select(*columns).schema
    return banded.groupBy(*BY_MONTH).agg(
        *quality.missing_measures(schema),
        *quality.numeric_measures(schema, quality.NUMERIC_COLUMNS),
        *quality.string_measures(quality.STRING_COLUMNS),
        *quality.band_measures(BANDED_VALUES),
        *states.state_measures(schema),
        quality.hashed(),
    )


def _fact_of(visits: DataFrame, resolved: lookups.Lookups, months: Sequence[Month] | None) -> DataFrame:
    """The fact of some months, or all; every key of it is in one month."""
    own = visits if months is None else visits.where(staging.in_batch(F.col("i94yr"), F.col("i94mon"), months))
    return fact.build_fact(fact.add_bands(fact.denormalise(own, resolved, citizenship=False)))


def load_months(
    spark: SparkSession,
    paths: Paths,
    months: Iterable[Month],
    layout: str = "partitioned",
    store: str = warehouse.CLUSTERED,
) -> None:
    """Load months from staged visits into the warehouse: profile, count, check, publish. ``store`` is the layout of the fact.

    The staged text is parsed once, into a table of the work folder. All months go through the same two passes over that
    table, one for every profile and check measure and one for the fact, each reading its own columns. The fact is written to a work folder first and published
    only if it agrees with the measures, so a failed check leaves the warehouse as it was, and a
    lost executor never repeats the joins behind a table already written. The fact is counted and written batch by batch of months,
    and each step leaves no shuffle files, so the disk needed beside the tables is that of one batch. Loading months again
    replaces them.
    """
    wanted = sorted(set(months))
    if not wanted:
        raise ValueError("no months to load")
    resolved = read_lookups(spark, paths)
    with work_folder(spark, "load") as work, shuffles_removed(spark):
        with work_folder(spark, "parsed") as parsed:
            visits = kept(staging.read_visits(spark, paths.staged, wanted, layout), f"{parsed}/visits")
            banded = fact.add_bands(fact.denormalise(visits, resolved))
            keyed = banded.withColumns({"year": F.col("i94yr"), "month": F.col("i94mon")})
            measured = kept(_measures(keyed, banded.columns), f"{work}/measures")
            found = {(row.year, row.month) for row in measured.select(*BY_MONTH).collect()}
            if found != set(wanted):
                held = sorted(found, key=str)
                raise quality.QualityError(f"asked for months {wanted}, staged rows are of {held}")

            _write_log(quality.missing_report(measured, banded.columns, BY_MONTH), paths, "checknulls")
            _write_log(quality.numeric_report(measured, by=BY_MONTH), paths, "intfields")
            _write_log(quality.string_report(measured, by=BY_MONTH), paths, "stringfields")

            batches = staging.batched({(row.year, row.month): row.totalrows for row in measured.select(*BY_MONTH, "totalrows").collect()})
            batches = batches if len(batches) > 1 else [None]
            counted = kept_parts(spark, (_fact_of(visits, resolved, batch) for batch in batches), f"{work}/fact")
            totals = kept(quality.band_totals(counted, BANDED_VALUES, BY_MONTH), f"{work}/totals")
        rows_in = measured.select(*BY_MONTH, F.col("totalrows").alias("rows_in"))
        reconciled = kept(
            quality.reconcile_totals(rows_in, totals, BY_MONTH), f"{work}/reconciled"
        )
        _write_log(reconciled, paths, "reconcile")
        quality.raise_on_failure(reconciled, "row reconciliation")
        bands = quality.reconcile_band_totals(measured, totals, BANDED_VALUES, BY_MONTH)
        quality.raise_on_failure(bands, "band reconciliation")

        dates = dimensions.date_dim(dimensions.months_table(spark, wanted))
        warehouse.write_date_dim(dates, paths.date)
        warehouse.write_states(states.states_of(measured, banded.columns, BY_MONTH), paths.states_of_months)
        warehouse.write_fact(counted, paths.visit_fact, wanted, store, warehouse.GROUP_BYTES, batches)


def load_changed(
    spark: SparkSession, paths: Paths, layout: str = "partitioned", store: str = warehouse.CLUSTERED
) -> ledger.Changes:
    """Load the months whose staged files hold something else than at the last call; without any nothing is read.

    The ledger is written after the months are published, so a load that stops before is done again. A month that is no longer staged stays in the
    warehouse and is named in ``gone``.
    """
    with work_folder(spark, "ledger") as work:
        found = ledger.changes(spark, paths.staged, paths.ledger, layout)
        if found.changed or found.touched:
            rows = kept(found.rows, work)
            if found.changed:
                load_months(spark, paths, found.changed, layout, store)
            ledger.write_ledger(rows, paths.ledger)
    return found


def differing_groups(spark: SparkSession, paths: Paths, months: Iterable[Month], layout: str = "partitioned") -> DataFrame:
    """The groups of the published fact whose visitors differ from the staged visits of some months, with either number.

    left_rows are the visits staged, right_rows the visitors stored. Both sides are narrowed by the day of arrival.
    """
    wanted = sorted(set(months))
    visits = staging.read_visits(spark, paths.staged, wanted, layout)
    banded = fact.add_bands(fact.denormalise(visits, read_lookups(spark, paths), citizenship=False))
    stored = warehouse.read_fact(spark, paths.visit_fact, wanted)
    state = F.when(F.col("arrivalstate_abbr") != "", F.col("arrivalstate_abbr")).otherwise(F.lit(UNKNOWN))
    grouped = fact.keyed(banded).withColumn("arrivalstate_abbr", state)
    return differences.differing_rows(grouped, stored, "arrivaldate_id", (None, "visitorcount"))


def profile_months(
    spark: SparkSession, paths: Paths, months: Iterable[Month] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The profile of all visits of the months loaded, or of those named, from their stored states; no visit is read."""
    stored = spark.read.parquet(paths.states_of_months)
    if months is not None:
        stored = stored.where(staging.in_months(F.col("year"), F.col("month"), months))
    return states.profile(states.merge_states(stored, by), by)


def check_rows(spark: SparkSession, paths: Paths, months: Iterable[Month]) -> DataFrame:
    """Compare the manifest with what the published star holds, log it, fail on a difference.

    The report has a row for each month asked for, and is returned from the driver's memory.
    """
    wanted = sorted(set(months))
    manifest = staging.read_manifest(spark, paths.manifest, wanted)
    quality.require_unique(manifest, ("sas_data_year", "sas_data_month"), paths.manifest)
    checked = quality.row_check(manifest, read_star(spark, paths, wanted))
    report = spark.createDataFrame(checked.collect(), checked.schema)
    _write_log(report, paths, "rowcheck")
    return quality.raise_on_failure(report, "row check")


def extract_slice(
    spark: SparkSession,
    paths: Paths,
    years: Sequence[int] | None = None,
    months: Sequence[int] | None = None,
    states: Sequence[str] | None = None,
    by: Sequence[str] = marts.SLICE_COLUMNS,
) -> str:
    """Export a slice of the published star as CSV and return its path."""
    sliced = marts.dice(read_star(spark, paths), years, months, states, by)
    return marts.export_slice(sliced, paths.extracts, years, months, states)
