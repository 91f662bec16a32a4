"""The visits of the driver's tables: equal to their text, with lineitem shuffled for orders alone once parts are too many to broadcast."""

import pytest
from pyspark.sql import functions as F

from driver_binding import queries, views

SF = "/root/testdata/sf0.001"


def test_visits_equal_their_text(spark):
    text, found = views.bind(spark, SF, views.VISITS), views.visits(spark, SF)
    assert text.schema.simpleString() == found.schema.simpleString()
    assert text.exceptAll(found).isEmpty() and found.exceptAll(text).isEmpty()


def test_customers_meet_orders_before_lineitem(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.visits(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and not any("l_orderkey" in line for line in joins[1:])


@pytest.mark.parametrize("clustered", [False, True])
def test_visits_are_stored_whole_in_passes(spark, tmp_path, monkeypatch, clustered):
    monkeypatch.setattr(views, "PASS_ROWS", 1_000)
    passes = views.passes(spark, SF)
    assert len(passes) > 4 and passes[0][0] is None is passes[-1][1] and all(a[1] == b[0] for a, b in zip(passes, passes[1:]))
    stored, found = queries.stored_visits(spark, SF, str(tmp_path / "visits"), clustered), views.visits(spark, SF)
    assert stored.exceptAll(found).isEmpty() and found.exceptAll(stored).isEmpty()
    if clustered:
        ends = stored.groupBy(F.col("_metadata.file_path")).agg(F.min("cicid").alias("a"), F.max("cicid").alias("b")).orderBy("a").collect()
        assert len(ends) > 4 and all(x.b <= y.a for x, y in zip(ends, ends[1:]))
