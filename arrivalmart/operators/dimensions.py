"""Dimension tables: port, date and the two band dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalmart.functions.bands import Bands
from arrivalmart.functions.codes import MODES, fixed_table

# Columns of the port dimension and the port columns they come from, in order.
PORT_DIM_COLUMNS = (
    ("i94port_code", "code"),
    ("port_mode", "mode"),
    ("port_latitude", "latitude"),
    ("port_longitude", "longitude"),
    ("port_place", "place"),
    ("port_city", "city"),
    ("port_county", "county_name"),
    ("port_state_abbr", "state_id"),
    ("port_state", "state_name"),
    ("port_country_abbr", "country_code"),
    ("port_country", "country"),
)


def port_dim(ports: DataFrame, modes: Sequence[tuple[int, str]] = MODES) -> DataFrame:
    """One member per port and mode of arrival; ``port_id`` is ``<mode code>_<port code>``.

    The modes are a fixed list of five, so each port row is exploded in place and nothing is joined.
    """
    per_mode = F.inline(
        F.array(*[F.struct(F.lit(c).alias("mode_code"), F.lit(m).alias("mode")) for c, m in modes])
    )
    members = ports.select("*", per_mode)
    port_id = F.concat(F.col("mode_code").cast("string"), F.lit("_"), F.col("code"))
    return members.select(
        port_id.alias("port_id"), *[F.col(old).alias(new) for new, old in PORT_DIM_COLUMNS]
    )


def band_dim(spark: SparkSession, bands: Bands) -> DataFrame:
    """Id and label of every band, made from the cuts the fact is banded with."""
    return fixed_table(spark, (bands.id_column, bands.label_column), bands.members())


def months_of(visits: DataFrame) -> DataFrame:
    """Distinct (year, month) of visits; combined map-side, so only months are shuffled."""
    return visits.select(F.col("i94yr").alias("year"), F.col("i94mon").alias("month")).distinct()


def months_table(spark: SparkSession, months: Iterable[tuple[int, int]]) -> DataFrame:
    return fixed_table(spark, ("year", "month"), sorted(set(months)))


def date_dim(months: DataFrame) -> DataFrame:
    """Every day of the given (year, month) rows; a pair that is no calendar month gives no day."""
    on_calendar = F.col("month").between(1, 12) & F.col("year").between(1, 9999)
    first = F.when(on_calendar, F.make_date("year", "month", F.lit(1)))
    days = months.select(first.alias("first")).distinct().select(
        F.explode(F.sequence("first", F.last_day("first"))).alias("date_id")
    )
    return days.select(
        "date_id",
        F.dayofmonth("date_id").alias("day"),
        F.weekofyear("date_id").alias("week"),
        F.month("date_id").alias("month"),
        F.year("date_id").alias("year"),
        F.date_format("date_id", "EEEE").alias("weekday"),
    )
