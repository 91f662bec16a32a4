"""Mergeable measures of a profile: a row of partial states for each field of a group, kept as a table.

Counts, extrema, the exact sum, and the second moment about a whole number near the mean add up without error, because all profiled numbers
are whole: states of months merge into those of a year, and the year's profile reads no visit again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivalmart.operators import quality

# Columns of a state, by how they merge.
COUNTS = ("rows", *quality.CHECKS, "numbers", "texts")
EXTREMA = (("lowest", "min"), ("highest", "max"), ("text_min", "min"), ("text_max", "max"))
WIDE = "DECIMAL(38,0)"
STATE_COLUMNS = ("field", *COUNTS, "total", "centre", "second", *[name for name, _ in EXTREMA])
# The sum of squares of n whole numbers with a sum of `total` and a second moment about `centre`.
SQUARES = f"second + 2 * CAST(centre AS {WIDE}) * total - CAST(numbers AS {WIDE}) * CAST(centre AS {WIDE}) * CAST(centre AS {WIDE})"
CENTRE = "total DIV numbers"
SECOND = f"squares - 2 * CAST({CENTRE} AS {WIDE}) * total + CAST(numbers AS {WIDE}) * CAST({CENTRE} AS {WIDE}) * CAST({CENTRE} AS {WIDE})"


def state_measures(schema: T.StructType, columns: Iterable[str] = quality.NUMERIC_COLUMNS) -> list[Column]:
    """Exact measures of number columns, beside those of :mod:`quality`; text is read as a whole number where it is one."""
    measures = []
    for name in columns:
        value = quality.whole_number(schema, name)
        if isinstance(schema[name].dataType, T.IntegerType):
            # A sum of decimals makes objects for every row. The square of a 32-bit number has 62 bits: its halves are summed as longs, exact up
            # to 2^32 rows of a group, which no month comes near; beyond, the sum raises an error.
            square = f"CAST({value} AS BIGINT) * {value}"
            high, low = f"sum(shiftright({square}, 31))", f"sum({square} & {(1 << 31) - 1}L)"
            total = f"sum(CAST({value} AS BIGINT))"
            squares = f"CAST({high} AS {WIDE}) * {1 << 31} + CAST({low} AS {WIDE})"
        else:
            wide = f"CAST({value} AS DECIMAL(19,0))"
            total, squares = f"sum({wide})", f"sum(CAST({wide} * {wide} AS {WIDE}))"
        parts = {
            "numbers": f"count({value})",
            "total": f"CAST({total} AS {WIDE})",
            "squares": f"CAST({squares} AS {WIDE})",
            "lowest": f"CAST(min({value}) AS BIGINT)",
            "highest": f"CAST(max({value}) AS BIGINT)",
        }
        measures += [F.expr(f"{part} AS `state:{key}:{name}`") for key, part in parts.items()]
    return measures


def _packed(states: DataFrame) -> DataFrame:
    """States from exact sums: the squares become the second moment about a whole number near the mean."""
    return states.withColumns({"centre": F.expr(f"CASE WHEN numbers > 0 THEN {CENTRE} END"), "second": F.expr(f"CASE WHEN numbers > 0 THEN {SECOND} END")})


def states_of(measured: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row of states for each group and profiled column, from the measures of a group in one row."""
    held = set(measured.columns)

    def cell(key: str, otherwise: str) -> str:
        return f"`{key}`" if key in held else otherwise

    rows = []
    for name in columns:
        checks = [cell(f"{check}:{name}", "0L") for check in quality.CHECKS]
        numbers, total, squares, lowest, highest = (
            cell(f"state:{key}:{name}", none)
            for key, none in (("numbers", "0L"), ("total", f"CAST(NULL AS {WIDE})"), ("squares", f"CAST(NULL AS {WIDE})"), ("lowest", "CAST(NULL AS BIGINT)"), ("highest", "CAST(NULL AS BIGINT)"))
        )
        text = [cell(f"string:{part}:{name}", "CAST(NULL AS STRING)") for part in ("min", "max")]
        texts = f"coalesce(CAST({cell(f'string:count:{name}', 'NULL')} AS BIGINT), 0L)"
        rows.append(", ".join([f"'{name}'", "totalrows", *checks, numbers, texts, total, squares, lowest, highest, *text]))
    names = ", ".join(f"`{c}`" for c in ("field", *COUNTS, "total", "squares", *[n for n, _ in EXTREMA]))
    long = measured.selectExpr(*[f"`{c}`" for c in by], f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")
    return _packed(long).select(*by, *STATE_COLUMNS)


def profile_states(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of every column of a table but those it is grouped by, in one scan."""
    columns = [name for name in df.columns if name not in by]
    schema = T.StructType([df.schema[name] for name in columns])
    numbers, texts = ([c for c in wanted if c in columns] for wanted in (quality.NUMERIC_COLUMNS, quality.STRING_COLUMNS))
    measured = df.groupBy(*by).agg(
        *quality.missing_measures(schema), *quality.string_measures(texts), *state_measures(schema, numbers), quality.hashed()
    )
    return states_of(measured.where(F.size(quality.HASHED) > 0), columns, by)


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of the union of groups, equal to those of all their rows together."""
    sums = [F.sum(F.col(f"`{c}`")).alias(c) for c in COUNTS]
    exact = [F.expr(f"CAST(sum(total) AS {WIDE}) AS total"), F.expr(f"CAST(sum({SQUARES}) AS {WIDE}) AS squares")]
    extrema = [F.expr(f"{how}({name}) AS {name}") for name, how in EXTREMA]
    return _packed(states.groupBy(*by, "field").agg(*sums, *exact, *extrema)).select(*by, *STATE_COLUMNS)


def profile(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile that states stand for: counts, mean, sample deviation and extrema of each field."""
    # The sum about the centre is below the count, so that its square takes no digits from the second moment.
    off = f"CAST(total - CAST(numbers AS {WIDE}) * CAST(centre AS {WIDE}) AS DOUBLE)"
    return states.select(
        *by,
        "field",
        *[F.col(f"`{c}`") for c in COUNTS],
        F.expr(f"CASE WHEN numbers > 0 THEN centre + {off} / numbers END AS mean"),
        F.expr(f"CASE WHEN numbers > 1 THEN sqrt((CAST(second AS DOUBLE) - {off} * {off} / numbers) / (numbers - 1)) END AS stddev"),
        *[name for name, _ in EXTREMA],
    )
