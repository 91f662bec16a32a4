import random

from helpers import D, PORTS, as_set, lookups_of, plan_of, visits
from pyspark.sql import functions as F

from arrivalmart.functions.codes import VISIT_COLUMNS
from arrivalmart.operators import fact


def resolved(spark, *changes, **options):
    return fact.denormalise(visits(spark, *changes), lookups_of(spark), **options)


def test_known_codes(spark):
    row = resolved(spark, {"i94res": 582}).first()
    assert row["visitpurpose"] == "Pleasure"
    assert row["mode"] == "Air"
    assert row["port_id"] == "1_LOS"
    assert (row["arrivalstate_abbr"], row["arrivalstate"]) == ("CA", "California")
    assert (row["firstdeststate_abbr"], row["firstdeststate"]) == ("CA", "California")
    assert (row["citizen_ctry"], row["countryofresidence"]) == ("ALBANIA", "MEXICO")


def test_columns(spark):
    added = ["visitpurpose", "citizen_ctry", *fact.ORPHAN_DEFAULTS]
    assert resolved(spark, {}).columns == [*VISIT_COLUMNS, *added]
    added.remove("citizen_ctry")
    assert resolved(spark, {}, citizenship=False).columns == [*VISIT_COLUMNS, *added]


def test_orphans_become_unknown_and_none_is_lost(spark):
    rows = resolved(
        spark,
        {"i94visa": 7},
        {"i94mode": 0},
        {"i94port": "ZZZ"},
        {"i94addr": "99"},
        {"i94cit": 999, "i94res": 999},
        {"i94port": "CLG"},
        {"i94port": "XXX", "i94mode": -1},
        {"i94mode": None, "i94port": None, "i94addr": None, "i94res": None, "i94visa": None, "gender": None},
    )
    got = {r["cicid"]: r for r in rows.collect()}
    assert len(got) == 8
    assert got[0]["visitpurpose"] is None
    assert (got[1]["mode"], got[1]["port_id"], got[1]["arrivalstate"]) == ("unknown", "-1_XXX", "unknown")
    assert (got[2]["mode"], got[2]["port_id"]) == ("Air", "-1_XXX")
    assert (got[3]["firstdeststate_abbr"], got[3]["firstdeststate"]) == ("unknown", "unknown")
    assert (got[4]["citizen_ctry"], got[4]["countryofresidence"]) == (None, "unknown")
    assert (got[5]["port_id"], got[5]["arrivalstate_abbr"]) == ("1_CLG", "unknown")
    assert (got[6]["mode"], got[6]["port_id"]) == ("unknown", "-1_XXX")
    assert [got[7][c] for c in fact.ORPHAN_DEFAULTS] == list(fact.ORPHAN_DEFAULTS.values())
    assert got[7]["gender"] is None


def test_bands_of_visits(spark):
    rows = fact.add_bands(
        visits(
            spark,
            {"depdate": D(2016, 6, 22), "i94bir": 66},
            {"depdate": None, "i94bir": -1},
            {"arrdate": None, "i94bir": None},
            {"depdate": D(2016, 5, 31), "i94bir": -2},
        )
    )
    assert as_set(rows, "cicid", "duration_days", "visitduration_id", "age_id") == {
        (0, 21, 5, 10),
        (1, None, 999, 999),
        (2, None, 999, 999),
        (3, -1, 0, 0),
    }


def test_fact_counts_every_row_also_without_arrival_date(spark):
    rows = fact.add_bands(resolved(spark, {}, {}, {"arrdate": None}, {"gender": None}, {"gender": None}))
    built = fact.build_fact(rows)
    assert built.columns == [*fact.FACT_KEYS, "visitorcount"]
    assert as_set(built, "arrivaldate_id", "gender", "visitorcount") == {
        (D(2016, 6, 1), "F", 2),
        (None, "F", 1),
        (D(2016, 6, 1), None, 2),
    }


def random_visits(spark, n, seed):
    pick = random.Random(seed)
    codes = [p[0] for p in PORTS] + ["unknown", "ZZZ", None]
    changes = []
    for _ in range(n):
        # A third of all rows share one port code that no lookup holds.
        port = "unknown" if pick.random() < 0.34 else pick.choice(codes)
        changes.append(
            {
                "i94port": port,
                "i94mode": pick.choice([1, 2, 3, 9, -1, 0, None]),
                "i94visa": pick.choice([1, 2, 3, -1, 7]),
                "i94addr": pick.choice(["CA", "FL", "99", None]),
                "i94res": pick.choice([101, 582, 5]),
                "i94mon": pick.randint(1, 3),
                "i94bir": pick.choice([-3, -1, 0, 30, 70, None]),
                "depdate": pick.choice([None, D(2016, 5, 1), D(2016, 6, 9)]),
                "arrdate": pick.choice([None, D(2016, 6, 1), D(2016, 6, 2)]),
            }
        )
    return visits(spark, *changes)


def test_random_visits_are_conserved_with_and_without_broadcast(spark):
    rows = random_visits(spark, 600, seed=7)
    small, large = lookups_of(spark).checked(), lookups_of(spark).checked(max_rows=1)
    facts = []
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for lookups, limit in ((small, threshold), (large, "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            built = fact.build_fact(fact.add_bands(fact.denormalise(rows, lookups)))
            assert built.agg(F.sum("visitorcount")).first()[0] == 600
            plan = plan_of(built)
            assert ("SortMergeJoin" in plan) == (lookups is large)
            facts.append(sorted(map(str, built.collect())))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert facts[0] == facts[1]


def test_hot_port_is_split_when_ports_are_too_many_to_broadcast(spark):
    """The way beyond a broadcast: adaptive execution splits the port that a third of rows share."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in changes}
    rows = spark.range(0, 20000, 1, 8).crossJoin(visits(spark, {}).drop("cicid", "i94port")).selectExpr(
        "id AS cicid",
        "CASE WHEN id % 3 = 0 THEN 'unknown' ELSE CAST(id % 500 AS STRING) END AS i94port",
        *[c for c in VISIT_COLUMNS if c not in ("cicid", "i94port")],
    )
    many = [(str(i), None, None, "p", "c", None, "CA", "California", "US", "U") for i in range(500)]
    large = lookups_of(spark, many)
    expected = fact.build_fact(fact.add_bands(fact.denormalise(rows, large.checked()))).collect()
    for name, value in changes.items():
        spark.conf.set(name, value)
    try:
        unsized = large.checked(max_rows=400)
        built = fact.build_fact(fact.add_bands(fact.denormalise(rows, unsized)))
        got = built.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(built)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert sorted(map(str, got)) == sorted(map(str, expected))
