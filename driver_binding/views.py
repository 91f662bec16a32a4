"""Views that give the driver's tables the shape of visits, ports, states and countries.

Each text runs unchanged in Spark and in DuckDB; ``{name}`` stands for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VISITS = """
SELECT l.l_orderkey * 10 + l.l_linenumber                             AS cicid,
       CAST(year(o.o_orderdate) AS INT)                               AS i94yr,
       CAST(month(o.o_orderdate) AS INT)                              AS i94mon,
       CASE WHEN s.s_nationkey = 24 THEN 124 ELSE s.s_nationkey END   AS i94cit,
       CASE WHEN c.c_nationkey = 24 THEN 124 ELSE c.c_nationkey END   AS i94res,
       CASE WHEN l.l_linenumber = 7 THEN 'unknown'
            ELSE CAST(l.l_suppkey AS VARCHAR(20)) END                 AS i94port,
       CAST(o.o_orderdate AS DATE)                                    AS arrdate,
       CASE WHEN l.l_linenumber = 6 THEN 0
            WHEN o.o_orderpriority = '1-URGENT' THEN 1
            WHEN o.o_orderpriority = '2-HIGH'   THEN 2
            WHEN o.o_orderpriority = '3-MEDIUM' THEN 3
            WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 9
            ELSE -1 END                                               AS i94mode,
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN '99'
            ELSE CAST(n.n_regionkey AS VARCHAR(20)) END               AS i94addr,
       CASE WHEN l.l_returnflag = 'N' AND l.l_linenumber = 1 THEN NULL
            ELSE CAST(l.l_shipdate AS DATE) END                       AS depdate,
       CASE WHEN p.p_size = 50 THEN -1 WHEN p.p_size = 49 THEN -3
            ELSE p.p_size * 2 - 2 END                                 AS i94bir,
       CASE WHEN l.l_returnflag = 'A' THEN 1
            WHEN l.l_returnflag = 'R' THEN 2
            WHEN l.l_linestatus = 'O' THEN 3 ELSE 7 END               AS i94visa,
       CASE WHEN l.l_returnflag = 'N' AND l.l_linenumber = 1
            THEN 'unknown' ELSE 'M' END                               AS matflag,
       CASE WHEN p.p_size >= 49 THEN -1
            ELSE CAST(year(o.o_orderdate) AS INT) - (p.p_size * 2 - 2) END AS biryear,
       CASE WHEN o.o_orderstatus = 'F' THEN 'F'
            WHEN o.o_orderstatus = 'O' THEN 'M' ELSE 'unknown' END    AS gender,
       CASE WHEN l.l_quantity < 48 THEN 'unknown'
            ELSE CAST(l.l_linenumber AS VARCHAR(20)) END              AS insnum,
       CASE WHEN i.r_regionkey = 0 THEN 'unknown' ELSE p.p_brand END  AS airline,
       l.l_orderkey * 1000 + l.l_suppkey                              AS admnum,
       lpad(CAST(l.l_partkey AS VARCHAR(20)), 6, '0')                 AS fltno,
       p.p_type                                                       AS visatype
FROM {lineitem} l
JOIN {orders}   o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey  = c.c_custkey
JOIN {supplier} s ON l.l_suppkey  = s.s_suppkey
JOIN {part}     p ON l.l_partkey  = p.p_partkey
JOIN {nation}   n ON c.c_nationkey = n.n_nationkey
JOIN {region}   i ON n.n_regionkey = i.r_regionkey
"""

PORTS = """
SELECT CAST(s.s_suppkey AS VARCHAR(20)) AS code, s.s_name AS place, n.n_name AS city,
       CAST(NULL AS VARCHAR(20)) AS county_name,
       CASE WHEN s.s_nationkey >= 20 THEN NULL
            ELSE concat('S', CAST(s.s_nationkey AS VARCHAR(20))) END AS state_id,
       CASE WHEN s.s_nationkey >= 20 THEN NULL ELSE n.n_name END AS state_name,
       concat('R', CAST(r.r_regionkey AS VARCHAR(20))) AS country_code, r.r_name AS country,
       CASE WHEN s.s_nationkey >= 22 THEN NULL
            ELSE CAST(s.s_nationkey AS DOUBLE) + 10 END AS latitude,
       CASE WHEN s.s_nationkey >= 22 THEN NULL ELSE -CAST(s.s_suppkey AS DOUBLE) END AS longitude
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'XXX', 'NOT REPORTED/UNKNOWN', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
"""

STATES = "SELECT CAST(r_regionkey AS VARCHAR(20)) AS state_id, r_name AS state_name FROM {region}"

COUNTRIES = "SELECT n_nationkey AS code, n_name AS i94ctry FROM {nation}"

# Port labels in each of the forms a label can take; those of nations 3 and 13 name no known city.
PORT_LABELS = """
SELECT CAST(s.s_suppkey AS VARCHAR(20)) AS code,
       CASE WHEN s.s_nationkey = 3 THEN concat('OLD ', n.n_name, ', ', substr(r.r_name, 1, 2))
            WHEN s.s_nationkey = 13 THEN concat('OLD ', n.n_name, ', ', r.r_name)
            WHEN s.s_nationkey < 8 THEN concat(n.n_name, ', ', substr(r.r_name, 1, 2))
            WHEN s.s_nationkey < 10 THEN concat(n.n_name, ', ', substr(r.r_name, 1, 2), ' (BPS)')
            WHEN s.s_nationkey < 12
            THEN concat('FIELD ', CAST(s.s_suppkey AS VARCHAR(20)), ', ', n.n_name, ', ',
                        substr(r.r_name, 1, 2))
            WHEN s.s_nationkey < 18 THEN concat(n.n_name, ', ', r.r_name)
            WHEN s.s_nationkey < 20 THEN concat('No PORT Code (', s.s_name, ')')
            ELSE s.s_name END AS i94port_raw
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# City tables with many rows per city, of which the most populous counts.
US_CITIES = """
SELECT n.n_name AS city, substr(r.r_name, 1, 2) AS state_id, concat('State of ', r.r_name) AS state_name,
       concat('County ', CAST(c.c_custkey AS VARCHAR(20))) AS county_name,
       CAST(c.c_custkey AS DOUBLE) / 4 AS lat, -CAST(c.c_custkey AS DOUBLE) / 8 AS lng,
       c.c_acctbal AS population
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""
WORLD_CITIES = """
SELECT lower(n.n_name) AS city, r.r_name AS country, substr(r.r_name, 1, 3) AS iso2,
       CAST(c.c_custkey AS DOUBLE) / 2 AS lat, CAST(c.c_custkey AS DOUBLE) AS lng,
       c.c_acctbal AS population
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""
# Places by hand, under a code of no port for the nations from 22 on.
MANUAL_PORTS = """
SELECT CASE WHEN s.s_nationkey >= 22 THEN concat('X', CAST(s.s_suppkey AS VARCHAR(20)))
            ELSE CAST(s.s_suppkey AS VARCHAR(20)) END AS code, s.s_acctbal AS latitude, -s.s_acctbal AS longitude,
       s.s_name AS place, concat('Town ', CAST(s.s_suppkey AS VARCHAR(20))) AS city,
       'By hand' AS county_name, 'ZZ' AS state_id, 'Hand state' AS state_name,
       'HH' AS country_code, 'Handland' AS country
FROM {supplier} s
"""


def table_names(view: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", view)))


def duckdb_text(view: str) -> str:
    return view.format(**{name: name for name in table_names(view)})


# Declared so that binding a table needs no job to read its footer.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The view over the driver's Parquet tables as a DataFrame."""
    tables = {name: read_table(spark, sf_dir, name) for name in table_names(view)}
    return spark.sql(view, **tables)


# Rows of lineitem, the largest table, that one pass of :func:`passes` joins: so much of the shuffles is on the disks at once.
PASS_ROWS = 1 << 25
# Lowest order of a pass and lowest of the next one; None where it is open.
Orders = tuple[int | None, int | None]


def passes(spark: SparkSession, sf_dir: str) -> list[Orders]:
    """Ranges of orders with about PASS_ROWS rows of lineitem each; visits of an order of none are in no range, as no order is null in VISITS."""
    line = read_table(spark, sf_dir, "lineitem")
    parts = -(-line.count() // PASS_ROWS)
    if parts <= 1:
        return [(None, None)]
    at = F.percentile_approx("l_orderkey", [k / parts for k in range(1, parts)], 10_000)
    cuts = sorted(set(line.agg(at.alias("cuts")).first()["cuts"] or ()))
    return list(zip([None, *cuts], [*cuts, None], strict=True))


def visits(spark: SparkSession, sf_dir: str, of: Orders = (None, None)) -> DataFrame:
    """The rows of VISITS, or those of a range of orders, its columns by the same text, with its inner joins in another order.

    Spark joins in the order of a text, which shuffles lineitem, the largest table, for orders, customers and parts in turn, each time with more
    columns. Here orders meet customers before they meet lineitem, and lineitem meets parts and suppliers while it is narrow.
    """
    chosen = VISITS.split("FROM {lineitem} l")[0]
    line, orders, customer, supplier, part, nation, region = (
        read_table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region")
    )
    first, following = of
    if first is not None:
        line = line.where(F.col("l_orderkey") >= first)
    if following is not None:
        line = line.where(F.col("l_orderkey") < following)
    people = orders.join(
        customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey),
        orders.o_custkey == customer.c_custkey,
    )
    lines = line.join(supplier, line.l_suppkey == supplier.s_suppkey).join(part, line.l_partkey == part.p_partkey)
    joined = lines.join(people, line.l_orderkey == orders.o_orderkey)
    # Column names begin with their table's letter, so none needs its table named.
    return spark.sql(re.sub(r"\b[locspni]\.(?=[locspnr]_)", "", chosen) + "FROM {joined}", joined=joined)
