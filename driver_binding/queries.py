"""Registered queries: every operator of the package over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalmart.functions.bands import AGE, DURATION, Bands
from arrivalmart.functions.codes import MISSING, UNKNOWN, VISIT_COLUMNS, VISIT_FIELDS
from arrivalmart.operators import differences, dimensions, fact, marts, quality, states
from arrivalmart.plans import jobs
from arrivalmart.sources import ledger, lookups, staging, warehouse
from arrivalmart.sources.workspace import kept, kept_parts, new_folder, shuffles_removed, work_folder
from driver_binding import views

# Parameters of the slices; the oracle texts use the same.
SLICE_YEARS = (1996, 1997, 1999)
SUMMER = (6, 7, 8)
SLICE_STATES = ("S1", "S5", "S9", "S11", "unknown")
TOP_STATES = ("S1", "S2", "S3", "S7", "S9", "S14")
TOP_COUNTRIES = 5
TOP_CITIES = 3
AIR = 1
RELOADED_YEAR = 1996


def visits_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.visits(spark, sf_dir)


def stored_visits(spark: SparkSession, sf_dir: str, path: str, clustered: bool = False) -> DataFrame:
    """Visits as a table, joined range of orders by range of orders, as each range leaves its shuffle files; ``clustered`` by their id, which begins with the order's."""
    parts = [views.visits(spark, sf_dir, of) for of in views.passes(spark, sf_dir)]
    if clustered:
        parts = [part.repartitionByRange("cicid").sortWithinPartitions("cicid") for part in parts]
    return kept_parts(spark, parts, path)


def port_dim_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.port_dim(views.bind(spark, sf_dir, views.PORTS))


def lookups_of(spark: SparkSession, sf_dir: str) -> lookups.Lookups:
    """Lookups, measured in one job and broadcast where small."""
    states, countries = (views.bind(spark, sf_dir, view) for view in (views.STATES, views.COUNTRIES))
    return lookups.Lookups.of(spark, port_dim_of(spark, sf_dir), states, countries).checked()


def banded_of(spark: SparkSession, sf_dir: str, citizenship: bool = True) -> DataFrame:
    visits = visits_of(spark, sf_dir)
    return fact.add_bands(fact.denormalise(visits, lookups_of(spark, sf_dir), citizenship))


def visit_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.build_fact(banded_of(spark, sf_dir, citizenship=False))


def dates_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the months of the visits."""
    return dimensions.date_dim(dimensions.months_of(visits_of(spark, sf_dir)))


def calendar_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the months of all orders, whether or not an order has visits.

    A star only joins the days its fact has, so a calendar may hold more months, and the orders alone give them. A calendar has 31
    rows a month at most, which needs no count to be broadcast.
    """
    orders = views.read_table(spark, sf_dir, "orders")
    arrivals = orders.select(
        F.year("o_orderdate").alias("i94yr"), F.month("o_orderdate").alias("i94mon")
    )
    return F.broadcast(dimensions.date_dim(dimensions.months_of(arrivals)))


def star_of(spark: SparkSession, sf_dir: str) -> marts.Star:
    sized = lookups_of(spark, sf_dir)
    resolved = fact.denormalise(visits_of(spark, sf_dir), sized, citizenship=False)
    return marts.Star(
        fact=fact.build_fact(fact.add_bands(resolved)),
        port=sized.ports,
        age=F.broadcast(dimensions.band_dim(spark, AGE)),
        duration=F.broadcast(dimensions.band_dim(spark, DURATION)),
        date=calendar_of(spark, sf_dir),
    )


def raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records(visits_of(spark, sf_dir))


def raw_records(visits: DataFrame) -> DataFrame:
    """Visits turned back into raw records: day numbers, doubles, nulls and NaN for missing."""

    def raw(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind == "date":
            return F.datediff(value, F.lit(staging.DAY_ZERO)).cast("double").alias(name)
        if kind == "string":
            return F.when(value != UNKNOWN, value).alias(name)
        missing = F.lit("NaN").cast("double") if name == "i94bir" else F.lit(None)
        return F.when(value == MISSING, missing).otherwise(value.cast("double")).alias(name)

    return visits.select(*[raw(name, kind) for name, kind in VISIT_FIELDS])


# Staging


def clean_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.clean_visits(raw_visits(spark, sf_dir))


def row_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "manifest")
    staging.write_manifest(staging.row_manifest(visits_of(spark, sf_dir)), path)
    return staging.read_manifest(spark, path)


def staged_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "staged")
    staging.write_staged(visits_of(spark, sf_dir), path, clustered=False)
    return staging.read_visits(spark, path)


def staged_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in month folders, an index column first and the others in reverse order, read by their header."""
    path = new_folder(spark, "folders")
    visits = visits_of(spark, sf_dir)
    foreign = visits.select(
        F.col("cicid").alias("row_index"),
        *reversed(VISIT_COLUMNS),
        F.col("i94yr").alias("year"),
        F.col("i94mon").alias("month"),
    )
    foreign.write.options(**staging.CSV_OPTIONS).partitionBy("year", "month").csv(path)
    return staging.read_visits(spark, path, layout="folders")


# Lookups


def lookup_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "lookups")
    sources = (
        ("ports", views.PORTS, ",", lookups.PORT_COLUMNS),
        ("states", views.STATES, ",", lookups.STATE_COLUMNS),
        ("countries", views.COUNTRIES, "|", lookups.COUNTRY_COLUMNS),
    )
    read = []
    for name, view, sep, columns in sources:
        table = views.bind(spark, sf_dir, view).select(*columns)
        table.write.csv(f"{folder}/{name}", header=True, sep=sep, escape='"')
        int_key = "code" if name == "countries" else None
        rows = lookups.read_lookup(spark, f"{folder}/{name}", columns, sep, int_key)
        label = {"ports": "place", "states": "state_name", "countries": "i94ctry"}[name]
        number = F.col(columns[0]) if int_key else F.lit(None).cast("int")
        read.append(
            rows.select(
                F.lit(name).alias("lookup_name"),
                F.col(columns[0]).cast("string").alias("code"),
                number.alias("int_code"),
                F.col(label).alias("label"),
            )
        )
    return reduce(DataFrame.unionAll, read)


def mode_purpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both code tables with the visits that use each code; visits are counted once, by both codes."""
    used = visits_of(spark, sf_dir).groupBy("i94mode", "i94visa").agg(
        F.count(F.lit(1)).alias("visits")
    )

    def members(codes: DataFrame, kind: str, code: str, label: str, visit_code: str) -> DataFrame:
        counted = used.groupBy(visit_code).agg(F.sum("visits").alias("visits"))
        return codes.join(counted, F.col(code) == F.col(visit_code), "left").select(
            F.lit(kind).alias("kind"),
            F.col(code).alias("code"),
            F.col(label).alias("label"),
            F.coalesce("visits", F.lit(0).cast("bigint")).alias("visits"),
        )

    mode = members(lookups.modes(spark), "mode", "mode_code", "mode", "i94mode")
    return mode.unionAll(
        members(lookups.purposes(spark), "purpose", "purpose_code", "purpose", "i94visa")
    )


def port_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.split_port_labels(views.bind(spark, sf_dir, views.PORT_LABELS))


def port_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.enrich_ports(
        port_labels(spark, sf_dir),
        views.bind(spark, sf_dir, views.US_CITIES),
        views.bind(spark, sf_dir, views.WORLD_CITIES),
        views.bind(spark, sf_dir, views.MANUAL_PORTS),
    )


# Dimensions


def _band_usage(spark: SparkSession, sf_dir: str, bands: Bands) -> DataFrame:
    """A band dimension with the visitors the fact files under each member."""
    filed = visit_fact(spark, sf_dir).groupBy(F.col(bands.fact_column).alias("filed_id")).agg(
        F.sum("visitorcount").alias("visitorcount")
    )
    members = dimensions.band_dim(spark, bands)
    return members.join(filed, F.col(bands.id_column) == F.col("filed_id"), "left").select(
        bands.id_column,
        bands.label_column,
        F.coalesce("visitorcount", F.lit(0).cast("bigint")).alias("visitorcount"),
    )


def age_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _band_usage(spark, sf_dir, AGE)


def duration_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _band_usage(spark, sf_dir, DURATION)


def dim_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The port dimension written twice and read back."""
    path = new_folder(spark, "port")
    for _ in range(2):
        warehouse.write_dim(port_dim_of(spark, sf_dir), path)
    return spark.read.parquet(path)


def date_dim_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension written twice and read back."""
    path = new_folder(spark, "date")
    for _ in range(2):
        warehouse.write_date_dim(dates_of(spark, sf_dir), path)
    return warehouse.read_date_dim(spark, path)


# Fact


def denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = fact.denormalise(visits_of(spark, sf_dir), lookups_of(spark, sf_dir))
    return resolved.select("cicid", "visitpurpose", "citizen_ctry", *fact.ORPHAN_DEFAULTS)


def _banded_visits(spark: SparkSession, sf_dir: str, bands: Bands, value: str) -> DataFrame:
    """Visits per band with its label and the range of values found in it."""
    stay = visits_of(spark, sf_dir).withColumn("stay", F.datediff("depdate", "arrdate"))
    counted = fact.add_band(stay, value, bands).groupBy(
        F.col(bands.fact_column).alias("band_id")
    ).agg(
        F.count(F.lit(1)).alias("visits"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
    )
    members = dimensions.band_dim(spark, bands).toDF("band_id", "label")
    return counted.join(members, "band_id")


def duration_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _banded_visits(spark, sf_dir, DURATION, "stay")


def age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _banded_visits(spark, sf_dir, AGE, "i94bir")


def fact_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written, one year of it loaded again, and the whole table read back."""
    path = new_folder(spark, "visit_fact")
    with work_folder(spark, "fact") as work:
        built = kept(visit_fact(spark, sf_dir), work)
        warehouse.write_fact(built, path)
        warehouse.write_fact(built.where(F.col("year") == RELOADED_YEAR), path)
    return warehouse.read_fact(spark, path)


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[jobs.Paths, list[staging.Month]]:
    """All jobs up to the load, from raw records to the star and its logs."""
    paths = jobs.Paths.under(new_folder(spark, "mart"))
    with work_folder(spark, "visits") as stored, shuffles_removed(spark):
        parts = staging.month_parts(stored_visits(spark, sf_dir, stored))
        jobs.stage([raw_records(part) for part in parts], paths, clustered=False)
    for view, path, sep, columns in (
        (views.PORTS, paths.ports, ",", lookups.PORT_COLUMNS),
        (views.STATES, paths.states, ",", lookups.STATE_COLUMNS),
        (views.COUNTRIES, paths.countries, "|", lookups.COUNTRY_COLUMNS),
    ):
        table = views.bind(spark, sf_dir, view).select(*columns)
        table.write.csv(path, header=True, sep=sep, escape='"')
    jobs.build_dimensions(spark, paths)
    months = [
        (row.sas_data_year, row.sas_data_month)
        for row in staging.read_manifest(spark, paths.manifest).collect()
    ]
    jobs.load_months(spark, paths, months)
    return paths, months


def monthly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs in a row, from raw records to the checked star; the row check of every month."""
    return jobs.check_rows(spark, *_loaded(spark, sf_dir))


def load_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric and string logs of a load as read back: a row for each month, summary and field."""
    paths, _ = _loaded(spark, sf_dir)

    def cells(log: str, columns: Sequence[str], text: bool) -> DataFrame:
        schema = ", ".join(["summary string", *[f"{c} string" for c in columns], "year int", "month int"])
        rows = spark.read.schema(schema).csv(f"{paths.logs}/{log}", header=True, enforceSchema=False)
        fields = [F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns]
        value = F.col("cell.value")
        # Rounded in the same steps as in the oracle, so that halves fall alike.
        number = F.lit(None).cast("double") if text else F.floor(value.cast("double") * 100 + 0.5) / 100
        return rows.select("year", "month", "summary", F.explode(F.array(*fields)).alias("cell")).select(
            "year",
            "month",
            F.lit(log).alias("log"),
            "summary",
            "cell.field",
            (value if text else F.lit(None).cast("string")).alias("text_value"),
            number.alias("number_value"),
        )

    return cells("intfields", quality.NUMERIC_COLUMNS, False).unionByName(
        cells("stringfields", quality.STRING_COLUMNS, True)
    )


def load_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation log of a load as read back."""
    paths, _ = _loaded(spark, sf_dir)
    schema = "rows_in bigint, fact_rows bigint, visitors bigint, reduction_pct double, matches boolean, year int, month int"
    log = spark.read.schema(schema).csv(f"{paths.logs}/reconcile", header=True, enforceSchema=False)
    return log.withColumn("reduction_pct", F.round("reduction_pct", 6))


# Quality


def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_profile(banded_of(spark, sf_dir))


def missing_profile_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = banded_of(spark, sf_dir).withColumns(
        {"year": F.col("i94yr"), "month": F.col("i94mon")}
    )
    return quality.missing_profile(keyed, ("year", "month"))


def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = quality.numeric_profile(banded_of(spark, sf_dir))
    return profile.select(
        "summary", *[F.round(name, 4).alias(name) for name in quality.NUMERIC_COLUMNS]
    )


def string_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.string_profile(banded_of(spark, sf_dir))


def merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of every field and year, merged from the stored states of its months."""
    path = new_folder(spark, "states")
    keyed = banded_of(spark, sf_dir).withColumns({"year": F.col("i94yr"), "month": F.col("i94mon")})
    warehouse.write_states(states.profile_states(keyed, ("year", "month")), path)
    by_year = states.profile(states.merge_states(spark.read.parquet(path), ("year",)), ("year",))
    return by_year.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")}).withColumnsRenamed(
        {
            "rows": "row_count",
            "isnan": "nan_count",
            "isnull": "null_count",
            "emptystring": "empty_count",
            "unknownstring": "unknown_count",
            "nan_as_-1": "minus_one_count",
        }
    )


def differing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits against a copy with some lost, some doubled and some altered; both are clustered by their id."""
    left_at, right_at = (new_folder(spark, name) for name in ("left", "right"))
    with shuffles_removed(spark):
        left = stored_visits(spark, sf_dir, left_at, clustered=True)
        # A file is read in its order, so the copy is clustered without a shuffle.
        right = kept(_miscopied(left), right_at)
        found = differences.differing_rows(left, right, "cicid")
    return found.select("cicid", "gender", "left_rows", "right_rows")


def _miscopied(visits: DataFrame) -> DataFrame:
    """Visits in their order, with some lost, some doubled and some altered."""
    copies = F.when(F.col("cicid") % 997 == 0, 0).when(F.col("cicid") % 1009 == 1, 2).otherwise(1)
    altered = F.when(F.col("cicid") % 2003 == 5, F.lit("X")).otherwise(F.col("gender"))
    return visits.withColumn("gender", altered).withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("copy")


def changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a ledger of staged files finds at first, after a year is staged again as it was, and after a visit of each of its first months is lost."""
    staged, known = new_folder(spark, "staged"), new_folder(spark, "ledger")
    found = []
    with work_folder(spark, "visits") as stored, shuffles_removed(spark):
        visits = stored_visits(spark, sf_dir, stored)
        year = visits.where(F.col("i94yr") == RELOADED_YEAR)
        some = year.where(F.col("i94mon") <= 2)
        gone = some.groupBy("i94mon").agg(F.min("cicid").alias("cicid")).select("cicid")
        fewer = some.join(gone, "cicid", "left_anti").select(*visits.columns)
        for step, rows in ((1, visits), (2, year), (3, fewer)):
            for part in staging.month_parts(rows):
                staging.write_staged(part, staged, clustered=False, packed=True)
            seen = ledger.changes(spark, staged, known)
            for status in ("changed", "touched", "gone"):
                found += [(step, *month, status) for month in getattr(seen, status)]
            if seen.changed or seen.touched:
                with work_folder(spark, "seen") as work:
                    ledger.write_ledger(kept(seen.rows, work), known)
    return spark.createDataFrame(found, "step int, year int, month int, status string")


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.reconcile(visits_of(spark, sf_dir), visit_fact(spark, sf_dir))
    return report.withColumn("reduction_pct", F.round("reduction_pct", 6))


def reconcile_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    stay = visits_of(spark, sf_dir).withColumn("stay", F.datediff("depdate", "arrdate"))
    return quality.reconcile_bands(
        stay, visit_fact(spark, sf_dir), ((DURATION, "stay"), (AGE, "i94bir"))
    )


def row_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = staging.row_manifest(visits_of(spark, sf_dir))
    return quality.row_check(manifest, star_of(spark, sf_dir))


def require_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "visits": visits_of(spark, sf_dir),
        "ports": views.bind(spark, sf_dir, views.PORTS),
        "states": views.bind(spark, sf_dir, views.STATES),
        "countries": views.bind(spark, sf_dir, views.COUNTRIES),
    }
    for name, table in tables.items():
        quality.require_rows(table, name)
    return quality.guard_report(tables)


# Marts


def dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dice(star_of(spark, sf_dir), SLICE_YEARS, SUMMER, SLICE_STATES)


def dice_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dice(star_of(spark, sf_dir))


def dice_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another choice of grouping columns: age range, sex and destination per year."""
    by = ("year", "age_range", "gender", "firstdeststate")
    return marts.dice(star_of(spark, sf_dir), by=by)


def slice_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    sliced = dice_all(spark, sf_dir)
    return marts.read_slice(spark, marts.export_slice(sliced, new_folder(spark, "extracts")))


def stored_star_of(spark: SparkSession, sf_dir: str) -> marts.Star:
    """The star written to the warehouse and read from it."""
    paths = jobs.Paths.under(new_folder(spark, "star"))
    built = star_of(spark, sf_dir)
    warehouse.write_fact(built.fact, paths.visit_fact)
    warehouse.write_date_dim(built.date, paths.date)
    for name in ("port", "age", "duration"):
        warehouse.write_dim(getattr(built, name), getattr(paths, name))
    return jobs.read_star(spark, paths)


def dice_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dice(stored_star_of(spark, sf_dir), SLICE_YEARS, SUMMER, SLICE_STATES)


def by_port_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_port(stored_star_of(spark, sf_dir))


def by_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_port(star_of(spark, sf_dir))


def visatype_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.visatype_counts(visits_of(spark, sf_dir), AIR)


def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_countries(star_of(spark, sf_dir), TOP_STATES, SUMMER, TOP_COUNTRIES)


def purpose_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.purpose_by_weekday(star_of(spark, sf_dir), None, SUMMER)


def purpose_weekday_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.purpose_by_weekday(star_of(spark, sf_dir), None, SUMMER, pivot=True)


def city_mode_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.city_mode_month(star_of(spark, sf_dir), TOP_STATES, TOP_CITIES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_visits": clean_visits,
    "row_manifest": row_manifest,
    "staged_roundtrip": staged_roundtrip,
    "staged_folders": staged_folders,
    "lookup_read": lookup_read,
    "mode_purpose": mode_purpose,
    "port_labels": port_labels,
    "port_geo": port_geo,
    "port_dim": port_dim_of,
    "age_dim": age_dim,
    "duration_dim": duration_dim,
    "date_dim": dates_of,
    "dim_write": dim_write,
    "date_dim_write": date_dim_write,
    "denormalised": denormalised,
    "duration_band": duration_band,
    "age_band": age_band,
    "visit_fact": visit_fact,
    "fact_rewrite": fact_rewrite,
    "monthly_load": monthly_load,
    "load_profiles": load_profiles,
    "load_reconcile": load_reconcile,
    "missing_profile": missing_profile,
    "missing_profile_monthly": missing_profile_monthly,
    "numeric_profile": numeric_profile,
    "string_profile": string_profile,
    "merged_profile": merged_profile,
    "differing_rows": differing_rows,
    "changed_months": changed_months,
    "reconcile": reconcile,
    "reconcile_bands": reconcile_bands,
    "row_check": row_check,
    "require_rows": require_rows,
    "dice": dice,
    "dice_all": dice_all,
    "dice_by_age": dice_by_age,
    "slice_export": slice_export,
    "by_port": by_port,
    "dice_stored": dice_stored,
    "by_port_stored": by_port_stored,
    "visatype_counts": visatype_counts,
    "top_countries": top_countries,
    "purpose_by_weekday": purpose_by_weekday,
    "purpose_weekday_pivot": purpose_weekday_pivot,
    "city_mode_month": city_mode_month,
}
