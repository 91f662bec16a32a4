"""Warehouse tables as Parquet: the fact, published month by month, and the dimensions.

Files of the fact are written once, below ``data/load=<id>``, and never changed. What a month holds is said by its pointer, an empty file
``current/<year>_<month>.<version>.<layout>.<load>``: the highest version counts. Its folder is ``data/load=<load>/year=<year>/month=<month>``,
or none if the load is ``none``. A load writes its files first and then publishes each month by the rename that puts
its next pointer in place, so that a reader finds the old month or the new one whenever the load stops. The version before
the current one is kept for readers that have already resolved it; older ones are removed with their files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrivalmart.functions.codes import UNKNOWN
from arrivalmart.sources.staging import Month, in_batch
from arrivalmart.sources.workspace import hadoop_files

# The fact table, partition columns last. Declared so that a partition value such as
# '01' is read as the text it is.
FACT_SCHEMA = (
    "arrivaldate_id date, port_id string, mode string, visitduration_id int, visitpurpose string, "
    "arrivalstate string, firstdeststate_abbr string, firstdeststate string, age_id int, "
    "gender string, countryofresidence string, visitorcount bigint, "
    "year int, month int, arrivalstate_abbr string"
)
DATE_DIM_SCHEMA = "date_id date, day int, week int, weekday string, year int, month int"
FACT_PARTITIONS = ("year", "month", "arrivalstate_abbr")
FACT_COLUMNS = tuple(field.split()[0] for field in FACT_SCHEMA.split(", "))
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# How the rows of a month lie in its folder: sorted by state in few files, or in a folder for each state.
CLUSTERED = "clustered"
FOLDERS = "folders"
# Rows are dealt to files by ranges of these columns and sorted by the first five. The others only split a range that
# the first five leave too large, so that no state, port or day is too much for one task.
RANGES = (*FACT_PARTITIONS, "port_id", "arrivaldate_id", "countryofresidence", "age_id", "visitduration_id")
SORTED = RANGES[:5]
BLOOM = ("arrivalstate_abbr", "port_id")
# Bytes of a row group of the clustered layout. A slice reads the groups whose range of states it meets: smaller groups
# read less beside a slice, larger ones compress better.
GROUP_BYTES = 16 << 20

VERSIONS_KEPT = 2
NO_LOAD = "none"
POINTER = re.compile(rf"(-?\d+|null)_(-?\d+|null)\.(\d+)\.({CLUSTERED}|{FOLDERS})\.(\w+)")


@dataclass(frozen=True, order=True)
class Pointer:
    """One version of a month."""

    version: int
    load: str
    layout: str
    year: int | None
    month: int | None

    @property
    def name(self) -> str:
        year, month = ("null" if v is None else str(v) for v in (self.year, self.month))
        return f"{year}_{month}.{self.version:010d}.{self.layout}.{self.load}"

    @property
    def folder(self) -> str | None:
        """Its folder below the fact's, if it has rows."""
        if self.load == NO_LOAD:
            return None
        year, month = (NULL_FOLDER if v is None else v for v in (self.year, self.month))
        return f"data/load={self.load}/year={year}/month={month}"

    @classmethod
    def of(cls, name: str) -> Pointer | None:
        """The pointer of a file name; None for any other file."""
        found = POINTER.fullmatch(name)
        if not found:
            return None
        year, month, version, layout, load = found.groups()
        return cls(int(version), load, layout, *[None if v == "null" else int(v) for v in (year, month)])


def pointers(spark: SparkSession, path: str) -> dict[Month, list[Pointer]]:
    """All versions of each month, the current one last, from one listing."""
    files, folder = hadoop_files(spark, f"{path}/current")
    found: dict[Month, list[Pointer]] = {}
    for status in files.listStatus(folder) if files.exists(folder) else ():
        pointer = Pointer.of(status.getPath().getName())
        if pointer:
            found.setdefault((pointer.year, pointer.month), []).append(pointer)
    return {month: sorted(versions) for month, versions in found.items()}


def publish(spark: SparkSession, path: str, load: str, layout: str, months: Iterable[Month], written: Iterable[Month]) -> None:
    """Point months to a load whose files are complete; months that it has no rows of become empty.

    Each month is published by one rename. Versions older than the last VERSIONS_KEPT are removed after it, the pointer before its files.
    """
    known, full = pointers(spark, path), set(written)
    files, current = hadoop_files(spark, f"{path}/current")
    files.mkdirs(current)
    for year, month in months:
        versions = known.get((year, month), [])
        own = load if (year, month) in full else NO_LOAD
        pointer = Pointer(versions[-1].version + 1 if versions else 1, own, layout, year, month)
        made = hadoop_files(spark, f"{path}/current/_{pointer.name}")[1]
        files.create(made, True).close()
        if not files.rename(made, hadoop_files(spark, f"{path}/current/{pointer.name}")[1]):
            raise OSError(f"{pointer.name} could not be put in place below {path}")
        for old in [*versions, pointer][:-VERSIONS_KEPT]:
            files.delete(hadoop_files(spark, f"{path}/current/{old.name}")[1], False)
            if old.folder:
                files.delete(hadoop_files(spark, f"{path}/{old.folder}")[1], True)


def remove_unnamed(spark: SparkSession, path: str) -> list[str]:
    """Remove and name the month folders that no pointer names, which loads that were killed have left. No load may be running."""
    named = {p.folder for versions in pointers(spark, path).values() for p in versions}
    files, data = hadoop_files(spark, f"{path}/data")

    def children(folder: str) -> list[str]:
        found = files.listStatus(hadoop_files(spark, f"{path}/{folder}")[1])
        return [f"{folder}/{s.getPath().getName()}" for s in found if s.isDirectory()]

    removed = []
    for load in children("data") if files.exists(data) else ():
        kept = 0
        for month in (m for year in children(load) if "/year=" in year for m in children(year)):
            if month in named:
                kept += 1
            else:
                files.delete(hadoop_files(spark, f"{path}/{month}")[1], True)
                removed.append(month)
        if not kept:
            files.delete(hadoop_files(spark, f"{path}/{load}")[1], True)
    return removed


def write_fact(
    fact: DataFrame,
    path: str,
    months: Iterable[Month] | None = None,
    layout: str = CLUSTERED,
    group_bytes: int = GROUP_BYTES,
    batches: Sequence[Sequence[Month] | None] = (None,),
) -> None:
    """Replace the months a fact holds, and those named; loading a month twice leaves it as loaded once.

    ``clustered`` deals the rows to files by ranges of state, port and day within a month and sorts them, so that row groups have
    narrow ranges of states and a slice reads only those it meets. ``folders`` has a folder for each state, which a slice doesn't
    even list; it pays once the states of a month fill many files each. Months of both layouts may be in one table. In either a state with a
    third of all rows is split over many tasks and small ones share one. A state that is null or empty is written as ``'unknown'``. The
    months written are observed in the same pass and reach the driver. ``batches`` of months, all that it holds, are dealt out one after the other, so that the
    shuffle of one is on the disks at once; each reads ``fact`` again, which should be a table. They are published together.
    """
    if layout not in (CLUSTERED, FOLDERS):
        raise ValueError(f"unknown layout {layout!r}")
    state = FACT_PARTITIONS[-1]
    fact = fact.withColumn(state, F.when(F.col(state) != "", F.col(state)).otherwise(F.lit(UNKNOWN)))
    load, written = uuid.uuid4().hex, set()
    folders = FACT_PARTITIONS[:-1] if layout == CLUSTERED else FACT_PARTITIONS
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM if c not in folders}
    for batch in batches:
        out = fact if batch is None else fact.where(in_batch(F.col("year"), F.col("month"), batch))
        if layout == CLUSTERED:
            out = out.repartitionByRange(*RANGES).sortWithinPartitions(*SORTED)
        else:
            out = out.hint("rebalance", *FACT_PARTITIONS)
        seen = Observation()
        out = out.observe(seen, F.collect_set(F.struct("year", "month")).alias("months"))
        out.write.mode("append").options(**options, **{"parquet.block.size": group_bytes}).partitionBy(*folders).parquet(f"{path}/data/load={load}")
        written |= {(row.year, row.month) for row in seen.get["months"]}
    publish(fact.sparkSession, path, load, layout, sorted(written | set(months or ()), key=str), written)


def read_fact(spark: SparkSession, path: str, months: Iterable[Month] | None = None) -> DataFrame:
    """The fact table as it is published now; only the folders of the given months are listed if any are named."""
    wanted = None if months is None else set(months)
    current = [versions[-1] for month, versions in sorted(pointers(spark, path).items(), key=str) if wanted is None or month in wanted]
    read = []
    for layout in (CLUSTERED, FOLDERS):
        folders = [f"{path}/{p.folder}" for p in current if p.folder and p.layout == layout]
        if folders:
            rows = spark.read.schema(FACT_SCHEMA).option("basePath", f"{path}/data").parquet(*folders)
            read.append(rows.select(*FACT_COLUMNS))
    return reduce(DataFrame.unionAll, read) if read else spark.createDataFrame([], FACT_SCHEMA)


def write_dim(dim: DataFrame, path: str) -> None:
    """Replace a dimension table."""
    dim.write.mode("overwrite").parquet(path)


def write_date_dim(dates: DataFrame, path: str) -> None:
    """Replace the days of the months given, keep those of other months."""
    (
        dates.repartition("year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_states(states: DataFrame, path: str) -> None:
    """Replace the profile states of the months given, keep those of other months."""
    out = states.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("year", "month").parquet(path)


def read_date_dim(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DATE_DIM_SCHEMA).parquet(path)
