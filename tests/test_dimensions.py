from helpers import D, PORTS, as_set, ports

from arrivalmart.operators import dimensions


def test_port_dim(spark):
    dim = dimensions.port_dim(ports(spark))
    assert dim.columns == [
        "port_id", "i94port_code", "port_mode", "port_latitude", "port_longitude", "port_place",
        "port_city", "port_county", "port_state_abbr", "port_state", "port_country_abbr",
        "port_country",
    ]
    assert dim.count() == 5 * len(PORTS)
    members = as_set(dim, "port_id", "port_mode", "port_state")
    assert ("9_LOS", "Not reported", "California") in members
    assert ("-1_XXX", "unknown", None) in members


def test_date_dim(spark):
    months = dimensions.months_table(spark, [(2016, 1), (2016, 2), (2016, 2)])
    days = dimensions.date_dim(months)
    assert days.columns == ["date_id", "day", "week", "month", "year", "weekday"]
    assert days.count() == 31 + 29
    rows = as_set(days, *days.columns)
    assert (D(2016, 1, 1), 1, 53, 1, 2016, "Friday") in rows
    assert (D(2016, 2, 29), 29, 9, 2, 2016, "Monday") in rows


def test_months_off_the_calendar_give_no_day(spark):
    months = spark.createDataFrame(
        [(-1, -1), (2016, 13), (0, 1), (None, 2), (2015, 2)], "year int, month int"
    )
    assert dimensions.date_dim(months).count() == 28
