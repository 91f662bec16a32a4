"""The visit fact: resolve codes, band durations and ages, count visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivalmart.functions.bands import AGE, DURATION, Bands
from arrivalmart.functions.codes import UNKNOWN, UNKNOWN_PORT
from arrivalmart.sources.lookups import Lookups

# What an unresolved code becomes, and the keys of the fact in order.
ORPHAN_DEFAULTS = {
    "mode": UNKNOWN,
    "port_id": UNKNOWN_PORT,
    "arrivalstate": UNKNOWN,
    "arrivalstate_abbr": UNKNOWN,
    "firstdeststate_abbr": UNKNOWN,
    "firstdeststate": UNKNOWN,
    "countryofresidence": UNKNOWN,
}
FACT_KEYS = (
    "arrivaldate_id",
    "year",
    "month",
    "port_id",
    "mode",
    "visitduration_id",
    "visitpurpose",
    "arrivalstate",
    "arrivalstate_abbr",
    "firstdeststate",
    "firstdeststate_abbr",
    "age_id",
    "gender",
    "countryofresidence",
)


def _with_ports(visits: DataFrame, lookups: Lookups) -> DataFrame:
    """Visits with port_id and the port's state, null where the port is unlisted under the visit's mode."""
    places = {"arrivalstate": "port_state", "arrivalstate_abbr": "port_state_abbr"}
    code = F.col("i94port") == F.col("i94port_code")
    if lookups.codes is None:
        ports = lookups.ports.select("port_id", "i94port_code", "port_mode", *[F.col(old).alias(new) for new, old in places.items()])
        return visits.join(ports, code & (F.col("mode") == F.col("port_mode")), "left")
    joined = visits.join(lookups.codes, code, "left")
    listed = F.col("mode").isNotNull() & F.col("i94port_code").isNotNull()
    member = F.concat(F.col("mode_code").cast("string"), F.lit("_"), F.col("i94port_code"))
    return joined.withColumns({"port_id": F.when(listed, member), **{new: F.when(listed, F.col(old)) for new, old in places.items()}})


def denormalise(visits: DataFrame, lookups: Lookups, citizenship: bool = True) -> DataFrame:
    """Attach purpose, mode, port, destination state and countries; no visit is lost.

    A port matches on its code and on the mode text, so a visit of unlisted mode matches none.
    Purpose and citizenship stay null when unlisted, the other labels get their default.
    ``citizenship=False`` leaves out the one join that the fact does not need.
    """
    purposes = lookups.purposes.withColumnRenamed("purpose", "visitpurpose")
    states = lookups.states.select(
        F.col("state_id").alias("firstdeststate_abbr"),
        F.col("state_name").alias("firstdeststate"),
    )
    residence = lookups.countries.select(
        F.col("code").alias("residence_code"), F.col("i94ctry").alias("countryofresidence")
    )
    moded = visits.join(purposes, F.col("i94visa") == F.col("purpose_code"), "left").join(
        lookups.modes, F.col("i94mode") == F.col("mode_code"), "left"
    )
    joined = (
        _with_ports(moded, lookups)
        .join(states, F.col("i94addr") == F.col("firstdeststate_abbr"), "left")
        .join(residence, F.col("i94res") == F.col("residence_code"), "left")
    )
    kept = ["visitpurpose"]
    if citizenship:
        citizen = lookups.countries.select(
            F.col("code").alias("citizen_code"), F.col("i94ctry").alias("citizen_ctry")
        )
        joined = joined.join(citizen, F.col("i94cit") == F.col("citizen_code"), "left")
        kept.append("citizen_ctry")
    return joined.select(
        *visits.columns,
        *kept,
        *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(d)).alias(c) for c, d in ORPHAN_DEFAULTS.items()],
    )


def add_band(df: DataFrame, value: str, bands: Bands) -> DataFrame:
    """Add the band id of a value column under the name the fact uses."""
    return df.withColumn(bands.fact_column, bands.id_of(F.col(value)))


def add_bands(df: DataFrame) -> DataFrame:
    """Add stay length in days, its band, and the age band; a missing date gives the unknown band."""
    stay = df.withColumn("duration_days", F.datediff("depdate", "arrdate"))
    return add_band(add_band(stay, "duration_days", DURATION), "i94bir", AGE)


def keyed(banded: DataFrame) -> DataFrame:
    """The fact keys of every visit."""
    renamed = {"arrivaldate_id": "arrdate", "year": "i94yr", "month": "i94mon"}
    return banded.select(*[F.col(renamed.get(key, key)).alias(key) for key in FACT_KEYS])


def build_fact(banded: DataFrame) -> DataFrame:
    """Visitors per combination of the fact keys.

    Rows are counted, not dates, so a visit without arrival date is counted too. The count combines
    map-side before the one shuffle on all fourteen keys, which no single value can dominate.
    """
    return keyed(banded).groupBy(*FACT_KEYS).agg(F.count(F.lit(1)).alias("visitorcount"))
