"""Which rows differ between two tables, found without comparing all of them row by row.

Both tables are summed over cells of their key, each row by its hash, those of one side with a minus: a cell whose sums are not zero holds a row that
one side lacks or has more often, whatever the order of rows. Only such cells are read again, each cut into finer ones, until few rows
or single keys are left; these are compared as they are. Where too many cells differ to be listed, small ones are found in one step, kept as a table, and their rows
read range by range, so that only rows of differing cells are shuffled. A step asks the scan for the ranges of keys it needs, so on files that are
clustered by the key each step reads less than the one before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivalmart.operators.quality import QualityError
from arrivalmart.sources.workspace import kept, new_folder

FINER = 64  # cells that a differing cell is cut into
CELLS = 4_096  # differing cells that are listed on the driver, at most; beyond, a table of them is joined
RANGES = 64  # ranges of keys that a scan is asked for, at most; nearest ones are taken together
FEW = 100_000  # rows of differing cells that are compared as they are
PER_CELL = 16  # rows of a cell, on average, once differing cells are a table
SENT = 500_000  # cells of that table that every task is sent at once
CHUNKS = 64  # ranges of keys that the table is read in, at most
BITS = 21  # of a hash in each of the sums of its parts, which stay exact up to a weight of 2^41 in a cell
SIDE, WEIGHT, CELL = "_side", "_weight", "_cell"


@dataclass(frozen=True)
class Grid:
    """Cells of `width` keys from `low` on; the keys of dates are days."""

    low: int
    width: int

    def cell(self, number: Column) -> Column:
        return F.call_function("div", number - F.lit(self.low), F.lit(self.width))

    def finer(self, parts: int) -> Grid:
        return Grid(self.low, max(1, -(-self.width // parts)))

    def keys(self, cells: Sequence[int]) -> list[tuple[int, int]]:
        """Ranges of keys, first and last, that hold the cells: at most RANGES, the widest gaps left out."""
        cells = sorted(cells)
        gaps = sorted(range(1, len(cells)), key=lambda k: cells[k - 1] - cells[k])
        cuts = [0, *sorted(k for k in gaps[: RANGES - 1] if cells[k] - cells[k - 1] > 1), len(cells)]
        return [(self.low + cells[a] * self.width, self.low + (cells[b - 1] + 1) * self.width - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def _number(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("bigint")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(key).cast("bigint")
    raise QualityError(f"rows can't be told apart by the key {key} of type {kind.simpleString()}: a whole number or a date is needed")


def _between(df: DataFrame, key: str, first: int, last: int) -> Column:
    """A range of keys in the key's own type, so that it reaches the scan."""
    if isinstance(df.schema[key].dataType, T.DateType):
        return F.col(key).between(F.date_from_unix_date(F.lit(first)), F.date_from_unix_date(F.lit(last)))
    return F.col(key).between(F.lit(first), F.lit(last))


def _row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row that tells where its nulls are, by a bit for each column."""
    bits = [F.when(F.isnull(c), F.lit(1 << k % 30)).otherwise(F.lit(0)) for k, c in enumerate(columns)]
    nulls = [reduce(Column.bitwiseOR, bits[k : k + 30]) for k in range(0, len(bits), 30)]
    return F.xxhash64(*columns, *nulls)


def _parts(number: Column) -> list[Column]:
    """Parts of a long, the highest with its sign; sums of all parts are equal only if sums of the whole are."""
    low = F.lit((1 << BITS) - 1)
    return [F.shiftright(number, 2 * BITS), F.shiftright(number, BITS).bitwiseAND(low), number.bitwiseAND(low)]


@dataclass(frozen=True)
class Sides:
    """Two tables with the same columns; a row counts once, or as often as its weight says."""

    left: DataFrame
    right: DataFrame
    key: str
    columns: tuple[str, ...]
    weights: tuple[str | None, str | None] = (None, None)

    @classmethod
    def of(cls, left: DataFrame, right: DataFrame, key: str, weights: tuple[str | None, str | None] = (None, None)) -> Sides:
        named = [[f for f in df.schema if f.name != weight] for df, weight in zip((left, right), weights, strict=True)]
        kinds = [{f.name: f.dataType for f in fields} for fields in named]
        if kinds[0] != kinds[1] or key not in kinds[0]:
            raise QualityError(f"tables differ in their columns, or have no {key}: {left.schema.simpleString()}, {right.schema.simpleString()}")
        return cls(left, right, key, tuple(f.name for f in named[0]), weights)

    def rows(self, grid: Grid | None = None, cells: Sequence[int] | None = None, keys: tuple[int, int] | None = None, nulls: bool = False) -> DataFrame:
        """Rows of both sides with their side, 1 or -1, and weight; of the cells given only, null standing for null keys, or of a range of keys, or of null keys."""
        found = []
        for df, weight, side in zip((self.left, self.right), self.weights, (1, -1), strict=True):
            if keys is not None:
                df = df.where(_between(df, self.key, *keys))
            if nulls:
                df = df.where(F.isnull(self.key))
            if cells is not None:
                number, full = _number(df, self.key), [c for c in cells if c is not None]
                wanted = [_between(df, self.key, *r) for r in grid.keys(full)] if full else []
                wanted = [reduce(lambda a, b: a | b, wanted) & grid.cell(number).isin(full)] if wanted else []
                wanted += [F.isnull(self.key)] if None in cells else []
                df = df.where(reduce(lambda a, b: a | b, wanted))
            count = F.lit(1) if weight is None else F.col(weight)
            found.append(df.select(*self.columns, F.lit(side).alias(SIDE), count.cast("bigint").alias(WEIGHT)))
        return found[0].unionAll(found[1])

    def sums(self, grid: Grid, read: tuple[Grid, Sequence[int]] | None = None) -> DataFrame:
        """(cell, n) of the cells of a grid whose sums differ, among the rows of the cells of a coarser grid; n rows of both sides are in them."""
        rows = self.rows(*(read or (None, None)))
        own = F.col(SIDE) * F.col(WEIGHT)
        hashed = rows.select(grid.cell(_number(rows, self.key)).alias(CELL), own.alias("own"), _row_hash(self.columns).alias("hash"))
        parts = {f"part{k}": F.sum(F.col("own") * part) for k, part in enumerate(_parts(F.col("hash")))}
        summed = hashed.groupBy(CELL).agg(F.sum("own").alias("weight"), F.count(F.lit(1)).alias("n"), *[part.alias(name) for name, part in parts.items()])
        return summed.where(" OR ".join(f"{name} <> 0" for name in ("weight", *parts))).select(CELL, "n")

    def compared(self, rows: DataFrame) -> DataFrame:
        """Rows whose weights differ, with the weight on either side."""
        by_side = [F.sum(F.when(F.col(SIDE) == side, F.col(WEIGHT)).otherwise(F.lit(0))).alias(name) for side, name in ((1, "left_rows"), (-1, "right_rows"))]
        return rows.groupBy(*self.columns).agg(*by_side).where("left_rows <> right_rows")


def _chunks(cells: DataFrame) -> list[tuple[int, int, int]]:
    """Ranges of cells, first, last and how many differ, that hold the differing ones in order; few for the driver, whatever their number."""
    low, high, held = cells.agg(F.min(CELL), F.max(CELL), F.count(CELL)).first()
    if not held:
        return []
    span = -(-(high - low + 1) // CELLS)
    counted = cells.where(F.col(CELL).isNotNull()).groupBy(F.call_function("div", F.col(CELL) - F.lit(low), F.lit(span)).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    most, found = max(SENT, -(-held // CHUNKS)), []
    for at, n in sorted((row["at"], row["n"]) for row in counted.collect()):
        first, last = low + at * span, low + (at + 1) * span - 1
        if found and found[-1][2] + n <= most:
            found[-1] = (found[-1][0], last, found[-1][2] + n)
        else:
            found.append((first, last, n))
    return found


def _small(grid: Grid, rows: int, cells: int) -> Grid:
    """A grid of PER_CELL rows to a cell, if some cells of another grid hold so many rows."""
    return grid.finer(max(1, rows // (PER_CELL * cells)))


def _compared_by_table(sides: Sides, grid: Grid, read: tuple[Grid, Sequence[int]] | None, high: int) -> DataFrame:
    """Rows that differ in the differing cells of a grid, which are a table: each range of them is sent to the tasks that read its keys."""
    cells = kept(sides.sums(grid, read), new_folder(sides.left.sparkSession, "cells"))
    found = []
    for first, last, n in _chunks(cells):
        rows = sides.rows(keys=(grid.low + first * grid.width, min(high, grid.low + (last + 1) * grid.width - 1)))
        own = cells.where(F.col(CELL).between(first, last)).select(CELL)
        numbered = rows.withColumn("_number", grid.cell(_number(rows, sides.key)))
        found.append(numbered.join(F.broadcast(own) if n <= 2 * SENT else own, F.col("_number") == F.col(CELL), "left_semi").drop("_number"))
    if not cells.where(F.isnull(CELL)).isEmpty():
        found.append(sides.rows(nulls=True))
    return reduce(DataFrame.unionAll, [sides.compared(rows) for rows in found or [sides.rows().where(F.lit(False))]])


def differing_rows(
    left: DataFrame,
    right: DataFrame,
    key: str,
    weights: tuple[str | None, str | None] = (None, None),
    finer: int = FINER,
    few: int = FEW,
    most: int = CELLS,
) -> DataFrame:
    """The rows that two tables hold unequally often, each once, with left_rows and right_rows.

    Tables need the same columns, those of the weights apart, in any order; nulls are equal to each other. The key, a whole number or a date, is
    what both are clustered by; it need not be unique, and its range must be below 2^63. Null keys are a cell of their own. The result is complete: where more
    than `most` cells differ they are no longer listed but found at PER_CELL rows each, kept as a table below ``spark.checkpoint.dir`` and joined. Two different sets of rows in a cell pass for
    equal with a chance of 1 in 2^64.
    """
    sides = Sides.of(left, right, key, weights)
    ends = sides.rows().select(_number(left, key).alias("k")).agg(F.min("k"), F.max("k")).first()
    low, high = (0, 0) if ends[0] is None else ends
    if high - low >= 1 << 63:
        raise QualityError(f"the range of {key} is too wide: {low} to {high}")
    grid, read, held = Grid(low, high - low + 1).finer(finer), None, None
    while True:
        found = sides.sums(grid, read).limit(most + 1).collect()
        if len(found) > most:
            held = sides.rows().count() if held is None else held
            cells = -(-(high - low + 1) // grid.width) if read is None else len(read[1]) * -(-read[0].width // grid.width)
            return _compared_by_table(sides, _small(grid, held, cells), read, high)
        read, held = (grid, [row[CELL] for row in found]), sum(row.n for row in found)
        if not found:
            return sides.compared(sides.rows().where(F.lit(False)))
        if grid.width == 1 or held <= few:
            return sides.compared(sides.rows(*read))
        if 2 * len(found) > most:  # finer ones would be too many to list
            return _compared_by_table(sides, _small(grid, held, len(found)), read, high)
        grid = grid.finer(finer)
