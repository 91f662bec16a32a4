"""Lookup tables: code lists from CSV, fixed code tables, port labels and port coordinates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivalmart.functions.codes import MODES, PURPOSES, UNKNOWN, fixed_table
from arrivalmart.functions.sizing import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_checked, row_bytes
from arrivalmart.operators.quality import require_rows, require_unique

# Columns of the lookup files.
PORT_COLUMNS = (
    "code",
    "latitude",
    "longitude",
    "place",
    "city",
    "county_name",
    "state_id",
    "state_name",
    "country_code",
    "country",
)
STATE_COLUMNS = ("state_id", "state_name")
COUNTRY_COLUMNS = ("code", "i94ctry")

# Fixed values: "CITY, ST" with an optional border-patrol mark, and "CITY, COUNTRY".
LABEL_PATTERN = r"^(.*), ([A-Z]{2})( \(BPS\))?$"
BPS_PATTERN = r" \(BPS\)$"
BPS_MARK = "(BPS)"
PLACE_PATTERN = r"^(.*), ([^,]+)$"

# Codes of ports that are broadcast at most, within the bytes of any broadcast: three columns a code, one row for all its modes.
CODE_ROWS = 1_000_000
CODE_COLUMNS = ("i94port_code", "port_state", "port_state_abbr")


def read_lookup(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    sep: str = ",",
    int_key: str | None = None,
) -> DataFrame:
    """A code list from CSV as text, one key made int if asked; the file must not be empty.

    The header is checked against ``columns``, so a file with other columns fails instead of being
    read by position.
    """
    schema = ", ".join(f"{name} string" for name in columns)
    table = spark.read.schema(schema).csv(
        path, header=True, sep=sep, escape='"', enforceSchema=False
    )
    require_rows(table, path)
    if int_key is not None:
        table = table.withColumn(int_key, F.col(int_key).try_cast("int"))
    return table


def modes(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, ("mode_code", "mode"), MODES)


def purposes(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, ("purpose_code", "purpose"), PURPOSES)


@dataclass(frozen=True)
class Lookups:
    """Everything a visit is resolved against."""

    purposes: DataFrame
    modes: DataFrame
    ports: DataFrame
    states: DataFrame
    countries: DataFrame
    codes: DataFrame | None = None  # of a port dimension too large to broadcast: a row for each code, see port_codes

    @classmethod
    def of(
        cls, spark: SparkSession, ports: DataFrame, states: DataFrame, countries: DataFrame
    ) -> Lookups:
        """Lookups around a port dimension; the fixed code tables are always small."""
        return cls(
            purposes=F.broadcast(purposes(spark)),
            modes=F.broadcast(modes(spark)),
            ports=ports,
            states=states,
            countries=countries,
        )

    def unique(self) -> Lookups:
        """The same lookups, or an error if a key occurs twice and would multiply visits."""
        require_unique(self.ports, ("i94port_code", "port_mode"), "ports")
        require_unique(self.states, ("state_id",), "states")
        require_unique(self.countries, ("code",), "countries")
        return self

    def checked(self, max_rows: int | None = None) -> Lookups:
        """The same lookups; a table is broadcast only if it was counted small, of ports that aren't the codes if these are."""
        tables = {name: getattr(self, name) for name in ("ports", "states", "countries")}
        found = replace(self, **broadcast_checked(tables, BROADCAST_ROWS if max_rows is None else max_rows))
        if found.ports is not self.ports:
            return found
        return replace(found, codes=port_codes(self.ports, CODE_ROWS if max_rows is None else max_rows))


def port_codes(ports: DataFrame, max_rows: int = CODE_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """The codes of a port dimension with their states, to be broadcast, if they stand for it and are small.

    They do if every code has one member for each mode, named ``<mode code>_<port code>``, and its members are in one state: then
    code and mode give the member, without a join that shuffles all visits. None otherwise; one job tells.
    """
    named = F.lit(False)
    for number, text in MODES:
        named |= (F.col("port_mode") == text) & F.col("port_id").eqNullSafe(F.concat(F.lit(f"{number}_"), F.col("i94port_code")))
    members = ports.dropna(subset=["i94port_code"]).groupBy("i94port_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.size(F.collect_set("port_mode")).alias("modes"),
        F.size(F.collect_set(F.struct("port_state", "port_state_abbr"))).alias("places"),
        F.bool_and(F.coalesce(named, F.lit(False))).alias("named"),
        F.first("port_state").alias("port_state"),
        F.first("port_state_abbr").alias("port_state_abbr"),
    )
    whole = F.expr(f"n = {len(MODES)} AND modes = {len(MODES)} AND places = 1 AND named")
    size = F.sum(row_bytes(members.select(*CODE_COLUMNS).schema))
    rows, total, regular = members.agg(F.count(F.lit(1)), size, F.bool_and(whole)).first()
    if not regular or rows > max_rows or total > max_bytes:
        return None
    return F.broadcast(ports.where(F.col("port_mode") == MODES[0][1]).dropna(subset=["i94port_code"]).select(*CODE_COLUMNS))


def split_port_labels(ports: DataFrame, label: str = "i94port_raw") -> DataFrame:
    """Add city, state and border-patrol mark taken from a port label.

    A label that does not end in a two-letter state keeps its whole text as city.
    """
    text = F.col(label)
    fits = F.coalesce(text.rlike(LABEL_PATTERN), F.lit(False))

    def when_fits(value: Column, other: Column) -> Column:
        return F.when(fits, value).otherwise(other)

    unknown = F.lit(UNKNOWN)
    return ports.withColumns(
        {
            "i94port_state": when_fits(F.regexp_extract(text, LABEL_PATTERN, 2), unknown),
            "i94port_bps": F.when(
                fits & text.rlike(BPS_PATTERN), F.lit(BPS_MARK)
            ).otherwise(unknown),
            "i94port_city": when_fits(F.regexp_extract(text, LABEL_PATTERN, 1), text),
        }
    )


def _rank(population: Column, latitude: Column, longitude: Column) -> Column:
    """One number that orders by population to a hundredth, then latitude, then longitude to a millionth; null comes last."""

    def digits(value: Column, scale: int, most: int) -> Column:
        whole = F.round(F.coalesce(value.cast("double"), F.lit(-most / scale)) * scale)
        return F.greatest(F.lit(0.0), F.least(whole + most, F.lit(2.0 * most))).cast("decimal(13,0)")

    def shifted(value: Column, places: int) -> Column:
        return (value * F.lit(Decimal(10**places))).cast("decimal(38,0)")

    people = F.greatest(F.lit(0.0), F.least(F.round(F.coalesce(population.cast("double"), F.lit(-1.0)) * 100) + 100, F.lit(9e11)))
    place = shifted(digits(latitude, 10**6, 10**12), 13) + digits(longitude, 10**6, 10**12)
    return (shifted(people.cast("decimal(12,0)"), 26) + place).cast("decimal(38,0)")


def _largest_city(cities: DataFrame, keys: dict[str, Column], values: dict[str, Column]) -> DataFrame:
    """One row per key, the most populous, so that a join on the key cannot multiply ports.

    Equal populations fall to the highest latitude, then longitude, then a hash of the row. Either step is a maximum of
    one number, hashed and combined map-side and joined back on the key, so no city table is sorted for it.
    """
    latitude, longitude = list(values)[:2]
    left = cities.select(
        *[c.alias(n) for n, c in keys.items()],
        *[c.alias(n) for n, c in values.items()],
        _rank(F.col("population"), values[latitude], values[longitude]).alias("_rank"),
    ).dropna(subset=list(keys))
    left = left.withColumn("_row", F.xxhash64(*values)).distinct()
    for step in ("_rank", "_row"):
        highest = left.groupBy(*keys).agg(F.max(step).alias("_highest"))
        left = left.join(highest, list(keys)).where(F.col(step) == F.col("_highest")).drop("_highest")
    return left.select(*keys, *values)


def enrich_ports(
    ports: DataFrame, us_cities: DataFrame, world_cities: DataFrame, manual: DataFrame
) -> DataFrame:
    """Give ports a place: US city by (city, state), then world city by (city, country), then by hand.

    ``ports`` comes from :func:`split_port_labels`. A later source only fills what earlier ones left
    empty; a port found nowhere keeps null coordinates.
    """
    us = _largest_city(
        us_cities,
        {"us_city_key": F.upper("city"), "us_state_key": F.col("state_id")},
        {
            "us_lat": F.col("lat"),
            "us_lng": F.col("lng"),
            "us_city": F.col("city"),
            "us_county": F.col("county_name"),
            "us_state_name": F.col("state_name"),
        },
    )
    world = _largest_city(
        world_cities,
        {"world_city_key": F.upper("city"), "world_country_key": F.upper("country")},
        {
            "world_lat": F.col("lat"),
            "world_lng": F.col("lng"),
            "world_city": F.col("city"),
            "world_iso2": F.col("iso2"),
            "world_country": F.col("country"),
        },
    )
    by_hand = manual.select(
        F.col("code").alias("hand_code"),
        *[F.col(name).alias(f"hand_{name}") for name in PORT_COLUMNS if name != "code"],
    )

    label = F.col("i94port_raw")
    has_state = F.col("i94port_state") != UNKNOWN
    keyed = ports.withColumns(
        {
            "place_city": F.when(~has_state, F.upper(F.regexp_extract(label, PLACE_PATTERN, 1))),
            "place_country": F.when(~has_state, F.upper(F.regexp_extract(label, PLACE_PATTERN, 2))),
        }
    )
    found = (
        keyed.join(
            us,
            (F.upper("i94port_city") == F.col("us_city_key"))
            & (F.col("i94port_state") == F.col("us_state_key")),
            "left",
        )
        .join(
            world,
            (F.col("place_city") == F.col("world_city_key"))
            & (F.col("place_country") == F.col("world_country_key")),
            "left",
        )
        .join(by_hand, F.col("code") == F.col("hand_code"), "left")
    )
    in_us = F.col("us_city_key").isNotNull()
    return found.select(
        "code",
        F.coalesce("us_lat", "world_lat", "hand_latitude").alias("latitude"),
        F.coalesce("us_lng", "world_lng", "hand_longitude").alias("longitude"),
        F.coalesce(label, "hand_place").alias("place"),
        F.coalesce("us_city", "world_city", "hand_city").alias("city"),
        F.coalesce("us_county", "hand_county_name").alias("county_name"),
        F.coalesce(F.when(has_state, F.col("i94port_state")), "hand_state_id").alias("state_id"),
        F.coalesce("us_state_name", "hand_state_name").alias("state_name"),
        F.coalesce(F.when(in_us, F.lit("US")), "world_iso2", "hand_country_code").alias(
            "country_code"
        ),
        F.coalesce(
            F.when(in_us, F.lit("United States")), "world_country", "hand_country"
        ).alias("country"),
    )
