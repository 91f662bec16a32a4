import pytest
from helpers import as_set
from pyspark.sql import functions as F

from arrivalmart.functions.bands import AGE, DURATION
from arrivalmart.operators import dimensions, fact

DURATION_EDGES = {
    -5: 0, -1: 0, 0: 1, 3: 1, 4: 2, 7: 2, 8: 3, 10: 3, 11: 4, 14: 4, 15: 5, 21: 5, 22: 6, 28: 6,
    29: 7, 100000: 7, None: 999,
}
AGE_EDGES = {
    -3: 0, -1: 999, 0: 1, 1: 1, 2: 2, 10: 2, 11: 3, 15: 3, 16: 4, 20: 4, 21: 5, 25: 5, 26: 6, 35: 6,
    36: 7, 45: 7, 46: 8, 55: 8, 56: 9, 65: 9, 66: 10, 120: 10, None: 999,
}


@pytest.mark.parametrize(("bands", "edges"), [(DURATION, DURATION_EDGES), (AGE, AGE_EDGES)])
def test_band_edges(spark, bands, edges):
    values = spark.createDataFrame([(v,) for v in edges], "value int")
    assert as_set(fact.add_band(values, "value", bands), "value", bands.fact_column) == set(edges.items())


@pytest.mark.parametrize("bands", [DURATION, AGE])
def test_ranges_agree_with_ids_and_partition_the_line(spark, bands):
    values = spark.range(-150, 150).select(F.col("id").cast("int").alias("value"))
    values = values.unionAll(spark.sql("SELECT CAST(NULL AS INT)"))
    ids = [i for i, _ in bands.members()]
    held = F.filter(
        F.array(*[F.when(bands.holds(F.col("value"), i), F.lit(i)) for i in ids]),
        lambda x: x.isNotNull(),
    )
    checked = fact.add_band(values, "value", bands).select("*", held.alias("held"))
    wrong = checked.where(~((F.size("held") == 1) & (F.col("held")[0] == F.col(bands.fact_column))))
    assert wrong.count() == 0


def test_band_dimensions(spark):
    age = as_set(dimensions.band_dim(spark, AGE), "age_id", "age_range")
    assert age == {
        (0, "invalid"), (1, "0-1"), (2, "2-10"), (3, "11-15"), (4, "16-20"), (5, "21-25"),
        (6, "26-35"), (7, "36-45"), (8, "46-55"), (9, "56-65"), (10, "66+"), (999, "unknown"),
    }
    duration = as_set(dimensions.band_dim(spark, DURATION), "duration_id", "duration_days")
    assert duration == {
        (0, "invalid"), (1, "0-3"), (2, "4-7"), (3, "8-10"), (4, "11-14"), (5, "15-21"),
        (6, "22-28"), (7, "29+"), (999, "unknown"),
    }
