"""Marts over the star: slices by year, month and state, and the analyses built on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalmart.functions.sizing import BROADCAST_ROWS, broadcast_checked
from arrivalmart.sources.staging import CSV_OPTIONS, one_line, restored

# Grouping columns of a slice, in order, with their types for reading one back.
SLICE_FIELDS = (
    ("arrivaldate_id", "date"),
    ("port_id", "string"),
    ("visitpurpose", "string"),
    ("day", "int"),
    ("week", "int"),
    ("month", "int"),
    ("year", "int"),
    ("weekday", "string"),
    ("port_mode", "string"),
    ("port_latitude", "double"),
    ("port_longitude", "double"),
    ("port_place", "string"),
    ("port_city", "string"),
    ("port_county", "string"),
    ("port_state_abbr", "string"),
    ("port_state", "string"),
    ("port_country_abbr", "string"),
    ("port_country", "string"),
    ("duration_days", "string"),
    ("countryofresidence", "string"),
)
SLICE_COLUMNS = tuple(name for name, _ in SLICE_FIELDS)
PORT_COLUMNS = tuple(name for name in SLICE_COLUMNS if name.startswith("port_"))
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


@dataclass(frozen=True)
class Star:
    """The fact and its four dimensions."""

    fact: DataFrame
    port: DataFrame
    age: DataFrame
    duration: DataFrame
    date: DataFrame

    def checked(self, max_rows: int = BROADCAST_ROWS) -> Star:
        """The same star; each dimension is broadcast only if it was counted small."""
        dimensions = {name: getattr(self, name) for name in ("port", "age", "duration", "date")}
        return replace(self, **broadcast_checked(dimensions, max_rows))

    def dimensions(self) -> list[tuple[str, DataFrame]]:
        """Each dimension under the name its key has in the fact."""
        return [
            ("age_id", self.age),
            ("visitduration_id", self.duration.withColumnRenamed("duration_id", "visitduration_id")),
            ("arrivaldate_id", self.date.withColumnRenamed("date_id", "arrivaldate_id")),
            ("port_id", self.port),
        ]


def dice(
    star: Star,
    years: Sequence[int] | None = None,
    months: Sequence[int] | None = None,
    states: Sequence[str] | None = None,
    by: Sequence[str] = SLICE_COLUMNS,
) -> DataFrame:
    """Visitors of a slice, summed by any columns of fact and dimensions; ``None`` means all.

    The three filters are on the partition columns of the fact table, so a slice reads only its own
    folders. Year and month of the result are those of the date dimension. Fact rows without a
    member in some dimension drop out, also where ``by`` names no column of it.

    A dimension whose key is in ``by`` is joined after the sum: its other columns follow from the
    key, so only the key is grouped and shuffled. The others are joined before.
    """
    fact = star.fact
    for column, wanted in (("year", years), ("month", months), ("arrivalstate_abbr", states)):
        if wanted is not None:
            fact = fact.where(F.col(column).isin(list(wanted)))
    rows, grouped, later = fact.drop("year", "month"), list(by), []
    for key, dimension in star.dimensions():
        members = dimension.select(key, *[c for c in dimension.columns if c in by and c != key])
        if key in by:
            later.append((key, members))
            grouped = [c for c in grouped if c == key or c not in members.columns]
        else:
            rows = rows.join(members, key)
    summed = rows.groupBy(*grouped).agg(F.sum("visitorcount").alias("visitorcount"))
    for key, members in later:
        summed = summed.join(members, key)
    return summed.select(*by, "visitorcount")


def slice_name(
    years: Sequence[int] | None, months: Sequence[int] | None, states: Sequence[str] | None
) -> str:
    """Folder name of an extract, such as ``states_CA_yrs_2016_mths_6_7_8``."""

    def part(prefix: str, values: Sequence | None) -> str:
        return "_".join([prefix, *(["all"] if values is None else map(str, values))])

    return "_".join([part("states", states), part("yrs", years), part("mths", months)])


def export_slice(
    df: DataFrame,
    folder: str,
    years: Sequence[int] | None = None,
    months: Sequence[int] | None = None,
    states: Sequence[str] | None = None,
) -> str:
    """Write a slice as CSV, one file per task, and return its path; an old export is replaced."""
    path = f"{folder}/{slice_name(years, months, states)}"
    one_line(df).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_slice(spark: SparkSession, path: str) -> DataFrame:
    """An exported slice with its default columns."""
    schema = ", ".join([f"{name} {kind}" for name, kind in SLICE_FIELDS] + ["visitorcount bigint"])
    return restored(spark.read.options(**CSV_OPTIONS, enforceSchema=False).schema(schema).csv(path))


def by_port(star: Star, years: Sequence[int] | None = None) -> DataFrame:
    """Visitors at every port and mode per year, with the coordinates of the port."""
    return dice(star, years, by=("year", *PORT_COLUMNS))


def visatype_counts(visits: DataFrame, mode: int = 1) -> DataFrame:
    """Visits per visa type among arrivals of one mode; a null type is listed with 0."""
    arrivals = visits.where(F.col("i94mode") == mode)
    return arrivals.groupBy("visatype").agg(F.count("visatype").alias("visatype_count"))


def _leaders(totals: DataFrame, columns: Sequence[str], total: str, k: int) -> DataFrame:
    """The k members with the most visitors, ties by name; at most k rows, so safe to broadcast.

    A member is named by its first column, which must not be null; the others tell equal names apart.
    """
    summed = totals.where(F.col(columns[0]).isNotNull()).groupBy(*columns).agg(
        F.sum("visitorcount").alias(total)
    )
    return F.broadcast(summed.orderBy(F.desc(total), *map(F.asc, columns)).limit(k))


def top_countries(
    star: Star,
    states: Sequence[str] | None,
    months: Sequence[int] | None,
    k: int = 10,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """The k countries of residence with the most visitors to a slice, split by length of stay."""
    by_stay = dice(star, years, months, states, by=("countryofresidence", "duration_days"))
    leaders = _leaders(by_stay, ("countryofresidence",), "country_total", k)
    return by_stay.join(leaders, "countryofresidence").select(
        "countryofresidence", "country_total", "duration_days", "visitorcount"
    )


def purpose_by_weekday(
    star: Star,
    states: Sequence[str] | None = None,
    months: Sequence[int] | None = None,
    years: Sequence[int] | None = None,
    pivot: bool = False,
) -> DataFrame:
    """Visitors per purpose and weekday of arrival; ``pivot`` gives one column per weekday."""
    long = dice(star, years, months, states, by=("visitpurpose", "weekday"))
    if not pivot:
        return long
    return long.groupBy("visitpurpose").pivot("weekday", list(WEEKDAYS)).agg(F.sum("visitorcount"))


def city_mode_month(
    star: Star,
    states: Sequence[str] | None,
    k: int = 3,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Monthly visitors by mode for the k cities of a slice with the most visitors; a city is one of its state."""
    city = ("port_city", "port_state_abbr")
    monthly = dice(star, years, None, states, by=(*city, "port_mode", "month"))
    leaders = _leaders(monthly, city, "city_total", k)
    named = [monthly[c].eqNullSafe(leaders[c]) for c in city]
    return monthly.join(leaders, reduce(lambda a, b: a & b, named), "left_semi")
