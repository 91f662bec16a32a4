"""Closed-open bands shared by the dimensions, the fact and the checks.

Ids, labels and value ranges all come from one list of cuts, so they cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrivalmart.functions.codes import MISSING, UNKNOWN


@dataclass(frozen=True)
class Bands:
    """Band 0 lies below the first cut, band i starts at cut i, the last band is open."""

    name: str
    id_column: str
    label_column: str
    fact_column: str
    cuts: tuple[int, ...]
    missing: int | None = None
    unknown_id: int = 999

    def bounds(self) -> list[tuple[int, int | None, int | None]]:
        """(id, first value, first value past the end) of every value band."""
        starts = (None, *self.cuts)
        ends = (*self.cuts, None)
        return [(i, lo, hi) for i, (lo, hi) in enumerate(zip(starts, ends, strict=True))]

    def members(self) -> list[tuple[int, str]]:
        """(id, label) of every band, the unknown one last."""

        def label(lo: int | None, hi: int | None) -> str:
            if lo is None:
                return "invalid"
            return f"{lo}+" if hi is None else f"{lo}-{hi - 1}"

        return [(i, label(lo, hi)) for i, lo, hi in self.bounds()] + [(self.unknown_id, UNKNOWN)]

    def is_unknown(self, value: Column) -> Column:
        if self.missing is None:
            return value.isNull()
        return value.isNull() | (value == self.missing)

    def id_of(self, value: Column) -> Column:
        """Band id of a value; stays inside whole-stage codegen."""
        band = F.when(self.is_unknown(value), F.lit(self.unknown_id))
        for i, cut in enumerate(self.cuts):
            band = band.when(value < cut, F.lit(i))
        return band.otherwise(F.lit(len(self.cuts)))

    def holds(self, value: Column, band_id: int) -> Column:
        """Whether the value lies in the range of a band, tested on the range alone."""
        if band_id == self.unknown_id:
            return self.is_unknown(value)
        _, lo, hi = self.bounds()[band_id]
        test = ~self.is_unknown(value)
        if lo is not None:
            test = test & (value >= lo)
        if hi is not None:
            test = test & (value < hi)
        return test


# The cuts of the two band dimensions.
AGE = Bands(
    name="age",
    id_column="age_id",
    label_column="age_range",
    fact_column="age_id",
    cuts=(0, 2, 11, 16, 21, 26, 36, 46, 56, 66),
    missing=MISSING,
)
DURATION = Bands(
    name="duration",
    id_column="duration_id",
    label_column="duration_days",
    fact_column="visitduration_id",
    cuts=(0, 4, 8, 11, 15, 22, 29),
)
