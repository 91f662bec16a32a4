"""Broadcast only what was measured and found small."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table is broadcast if its rows and their bytes stay within both; every executor holds one copy.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
FIXED_WIDTH = 8


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row: text by its length, anything else by one word, and a word for each column besides."""
    text = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in schema if isinstance(f.dataType, T.StringType)]
    fixed = F.lit(2 * FIXED_WIDTH * len(schema))
    return reduce(lambda a, b: a + b, text, fixed)


def broadcast_checked(
    tables: Mapping[str, DataFrame], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> dict[str, DataFrame]:
    """Hint a broadcast on each table within ``max_rows`` rows and ``max_bytes`` bytes.

    One job measures all tables, each only up to the bound of rows. A larger table comes back without a
    hint: the join then shuffles both sides, and the adaptive skew join splits its hot keys.
    """
    probes = [
        table.select(F.lit(name).alias("name"), row_bytes(table.schema).cast("bigint").alias("size")).limit(max_rows + 1)
        for name, table in tables.items()
    ]
    measured = reduce(DataFrame.unionAll, probes).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")
    )
    found = {row["name"]: (row["n"], row["size"]) for row in measured.collect()}

    def small(name: str) -> bool:
        rows, size = found.get(name, (0, 0))
        return rows <= max_rows and size <= max_bytes

    return {name: F.broadcast(table) if small(name) else table for name, table in tables.items()}
