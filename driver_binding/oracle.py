"""DuckDB texts that state the expected result of every registered query.

They are written from the semantics, by hand: band ids as explicit CASE ladders, labels as literal
rows, joins in plain SQL.
"""

from __future__ import annotations

from arrivalmart.functions.codes import VISIT_COLUMNS
from arrivalmart.operators.fact import FACT_KEYS
from arrivalmart.operators.marts import PORT_COLUMNS, SLICE_COLUMNS, WEEKDAYS
from arrivalmart.operators.quality import NUMERIC_COLUMNS, STRING_COLUMNS
from driver_binding import queries, views

# The ladders of the bands, and below the rows of modes, purposes, ages and durations.
DURATION_CASE = """CASE WHEN stay IS NULL THEN 999 WHEN stay < 0 THEN 0 WHEN stay <= 3 THEN 1
  WHEN stay <= 7 THEN 2 WHEN stay <= 10 THEN 3 WHEN stay <= 14 THEN 4 WHEN stay <= 21 THEN 5
  WHEN stay <= 28 THEN 6 ELSE 7 END"""
AGE_CASE = """CASE WHEN i94bir IS NULL OR i94bir = -1 THEN 999 WHEN i94bir < 0 THEN 0
  WHEN i94bir <= 1 THEN 1 WHEN i94bir <= 10 THEN 2 WHEN i94bir <= 15 THEN 3 WHEN i94bir <= 20 THEN 4
  WHEN i94bir <= 25 THEN 5 WHEN i94bir <= 35 THEN 6 WHEN i94bir <= 45 THEN 7 WHEN i94bir <= 55 THEN 8
  WHEN i94bir <= 65 THEN 9 ELSE 10 END"""

# Each entry may use the ones above it.
CTES = {
    "visits": views.duckdb_text(views.VISITS),
    "ports": views.duckdb_text(views.PORTS),
    "states": views.duckdb_text(views.STATES),
    "countries": views.duckdb_text(views.COUNTRIES),
    "modes(mode_code, mode)": """VALUES (1, 'Air'), (2, 'Sea'), (3, 'Land'), (9, 'Not reported'),
  (-1, 'unknown')""",
    "purposes(purpose_code, purpose)": """VALUES (1, 'Business'), (2, 'Pleasure'), (3, 'Student'),
  (-1, 'unknown')""",
    "age(age_id, age_range)": """VALUES (0, 'invalid'), (1, '0-1'), (2, '2-10'), (3, '11-15'),
  (4, '16-20'), (5, '21-25'), (6, '26-35'), (7, '36-45'), (8, '46-55'), (9, '56-65'), (10, '66+'),
  (999, 'unknown')""",
    "duration(duration_id, duration_days)": """VALUES (0, 'invalid'), (1, '0-3'), (2, '4-7'),
  (3, '8-10'), (4, '11-14'), (5, '15-21'), (6, '22-28'), (7, '29+'), (999, 'unknown')""",
    "port": """SELECT CAST(mode_code AS VARCHAR) || '_' || code AS port_id, code AS i94port_code,
  mode AS port_mode, latitude AS port_latitude, longitude AS port_longitude, place AS port_place,
  city AS port_city, county_name AS port_county, state_id AS port_state_abbr,
  state_name AS port_state, country_code AS port_country_abbr, country AS port_country
FROM ports CROSS JOIN modes""",
    "dates": """SELECT CAST(d AS DATE) AS date_id, CAST(day(d) AS INTEGER) AS day,
  CAST(weekofyear(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS month,
  CAST(year(d) AS INTEGER) AS year, dayname(d) AS weekday
FROM (SELECT unnest(generate_series(first, last_day(first), INTERVAL 1 DAY)) AS d
      FROM (SELECT DISTINCT make_date(i94yr, i94mon, 1) AS first FROM visits))""",
    "banded": f"""SELECT v.*, pu.purpose AS visitpurpose, coalesce(m.mode, 'unknown') AS mode,
  coalesce(p.port_id, '-1_XXX') AS port_id, coalesce(p.port_state, 'unknown') AS arrivalstate,
  coalesce(p.port_state_abbr, 'unknown') AS arrivalstate_abbr,
  coalesce(s.state_id, 'unknown') AS firstdeststate_abbr,
  coalesce(s.state_name, 'unknown') AS firstdeststate, cc.i94ctry AS citizen_ctry,
  coalesce(cr.i94ctry, 'unknown') AS countryofresidence,
  CAST(stay AS INTEGER) AS duration_days,
  {DURATION_CASE} AS visitduration_id, {AGE_CASE} AS age_id
FROM (SELECT *, date_diff('day', arrdate, depdate) AS stay FROM visits) v
LEFT JOIN purposes pu ON v.i94visa = pu.purpose_code
LEFT JOIN modes m ON v.i94mode = m.mode_code
LEFT JOIN port p ON v.i94port = p.i94port_code AND m.mode = p.port_mode
LEFT JOIN states s ON v.i94addr = s.state_id
LEFT JOIN countries cc ON v.i94cit = cc.code
LEFT JOIN countries cr ON v.i94res = cr.code""",
    "fact": """SELECT arrdate AS arrivaldate_id, i94yr AS year, i94mon AS month, port_id, mode,
  visitduration_id, visitpurpose, arrivalstate, arrivalstate_abbr, firstdeststate,
  firstdeststate_abbr, age_id, gender, countryofresidence, count(*) AS visitorcount
FROM banded GROUP BY ALL""",
    "star": """SELECT f.* EXCLUDE (year, month), d.day, d.week, d.month, d.year, d.weekday,
  p.* EXCLUDE (port_id), u.duration_days, a.age_range, f.year AS fact_year, f.month AS fact_month
FROM fact f JOIN age a ON f.age_id = a.age_id JOIN dates d ON f.arrivaldate_id = d.date_id
JOIN duration u ON f.visitduration_id = u.duration_id JOIN port p ON f.port_id = p.port_id""",
}


def _with(select: str) -> str:
    """The select over all common tables; DuckDB computes only those it reaches."""
    ctes = ",\n".join(f"{name} AS ({text.strip()})" for name, text in CTES.items())
    return f"WITH {ctes}\n{select}"


def _columns(names) -> str:
    return ", ".join(names)


def _texts(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _numbers(values) -> str:
    return ", ".join(map(str, values))


def _summed(by, where: str = "TRUE") -> str:
    keys = _columns(by)
    return (
        f"SELECT {keys}, CAST(sum(visitorcount) AS BIGINT) AS visitorcount FROM star "
        f"WHERE {where} GROUP BY {keys}"
    )


SUMMER = f"fact_month IN ({_numbers(queries.SUMMER)})"
TOP_STATES = f"arrivalstate_abbr IN ({_texts(queries.TOP_STATES)})"
SLICE = (
    f"fact_year IN ({_numbers(queries.SLICE_YEARS)}) AND {SUMMER} "
    f"AND arrivalstate_abbr IN ({_texts(queries.SLICE_STATES)})"
)

VISIT_LIST = _columns(VISIT_COLUMNS)
FACT_LIST = _columns((*FACT_KEYS, "visitorcount"))
SLICE_ALL = _summed(SLICE_COLUMNS)

BANDED_COLUMNS = (
    *VISIT_COLUMNS,
    "visitpurpose",
    "citizen_ctry",
    "mode",
    "port_id",
    "arrivalstate",
    "arrivalstate_abbr",
    "firstdeststate_abbr",
    "firstdeststate",
    "countryofresidence",
    "duration_days",
    "visitduration_id",
    "age_id",
)
TEXT_COLUMNS = (
    "i94port",
    "i94addr",
    "matflag",
    "gender",
    "insnum",
    "airline",
    "fltno",
    "visatype",
    "visitpurpose",
    "citizen_ctry",
    "mode",
    "port_id",
    "arrivalstate",
    "arrivalstate_abbr",
    "firstdeststate_abbr",
    "firstdeststate",
    "countryofresidence",
)
DATE_COLUMNS = frozenset({"arrdate", "depdate"})


def _missing(by: tuple[str, ...] = ()) -> str:
    def count(check: str, name: str) -> str:
        text, date = name in TEXT_COLUMNS, name in DATE_COLUMNS
        tests = {
            "isnan": "FALSE",
            "isnull": f"{name} IS NULL",
            "emptystring": f"{name} = ''" if text else "FALSE",
            "unknownstring": f"{name} = 'unknown'" if text else "FALSE",
            "nan_as_-1": f"TRY_CAST({name} AS INTEGER) = -1"
            if text
            else ("FALSE" if date else f"{name} = -1"),
        }
        return f"count(*) FILTER (WHERE {tests[check]}) AS {name}"

    keys = "".join(f"{k} AS {a}, " for k, a in by)
    group = f" GROUP BY {_columns(k for k, _ in by)}" if by else ""
    checks = ("isnan", "isnull", "emptystring", "unknownstring", "nan_as_-1")
    return " UNION ALL ".join(
        f"SELECT {keys}{_columns(count(check, name) for name in BANDED_COLUMNS)}, "
        f"'{check}' AS checktype, count(*) AS totalrows FROM banded{group}"
        for check in checks
    )


def _numeric() -> str:
    forms = {
        "count": "CAST(count({c}) AS DOUBLE)",
        "mean": "round(avg({c}), 4)",
        "stddev": "round(stddev_samp({c}), 4)",
        "min": "CAST(min({c}) AS DOUBLE)",
        "max": "CAST(max({c}) AS DOUBLE)",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS summary, "
        + _columns(f"{form.format(c=c)} AS {c}" for c in NUMERIC_COLUMNS)
        + " FROM banded"
        for name, form in forms.items()
    )


def _string() -> str:
    forms = {"count": "CAST(count({c}) AS VARCHAR)", "min": "min({c})", "max": "max({c})"}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS summary, "
        + _columns(f"{form.format(c=c)} AS {c}" for c in STRING_COLUMNS)
        + " FROM banded"
        for name, form in forms.items()
    )


def _load_profiles() -> str:
    """Both monthly logs in long form, a row for each month, summary and field."""
    numeric = {
        "count": "CAST(count({c}) AS DOUBLE)",
        "mean": "floor(avg({c}) * 100 + 0.5) / 100",
        "stddev": "floor(stddev_samp({c}) * 100 + 0.5) / 100",
        "min": "CAST(min({c}) AS DOUBLE)",
        "max": "CAST(max({c}) AS DOUBLE)",
    }
    # An empty cell of a log is read back as null.
    text = {
        "count": "CAST(count({c}) AS VARCHAR)",
        "min": "nullif(min({c}), '')",
        "max": "nullif(max({c}), '')",
    }
    none_text, none_number = "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)"

    def row(log: str, summary: str, field: str, shown: str, number: str) -> str:
        return f"""SELECT i94yr AS year, i94mon AS month, '{log}' AS log, '{summary}' AS summary, '{field}' AS field,
  {shown} AS text_value, {number} AS number_value
FROM (SELECT * REPLACE (ltrim(fltno, '0') AS fltno) FROM banded) GROUP BY 1, 2"""

    rows = [row("intfields", n, c, none_text, f.format(c=c)) for n, f in numeric.items() for c in NUMERIC_COLUMNS]
    rows += [row("stringfields", n, c, f.format(c=c), none_number) for n, f in text.items() for c in STRING_COLUMNS]
    return " UNION ALL ".join(rows)


LOAD_RECONCILE = """SELECT b.year, b.month, b.rows_in, f.fact_rows, f.visitors,
  round(100.0 * CAST(b.rows_in - f.fact_rows AS DOUBLE) / b.rows_in, 6) AS reduction_pct,
  b.rows_in = f.visitors AS matches
FROM (SELECT i94yr AS year, i94mon AS month, count(*) AS rows_in FROM visits GROUP BY 1, 2) b
JOIN (SELECT year, month, count(*) AS fact_rows, CAST(sum(visitorcount) AS BIGINT) AS visitors
      FROM fact GROUP BY 1, 2) f ON b.year = f.year AND b.month = f.month"""


def _merged_profile() -> str:
    """A row for each year and field, over all its visits at once."""
    none = {"number": "CAST(NULL AS BIGINT)", "text": "CAST(NULL AS VARCHAR)", "double": "CAST(NULL AS DOUBLE)"}

    def row(c: str) -> str:
        number, text, date = c in NUMERIC_COLUMNS, c in STRING_COLUMNS, c in DATE_COLUMNS
        unknown = f"count(*) FILTER (WHERE {c} = 'unknown')" if c in TEXT_COLUMNS else "0"
        empty = f"count(*) FILTER (WHERE {c} = '')" if c in TEXT_COLUMNS else "0"
        value = f"TRY_CAST({c} AS INTEGER)" if c in TEXT_COLUMNS else c
        minus = "0" if date else f"count(*) FILTER (WHERE {value} = -1)"
        return f"""SELECT i94yr AS year, '{c}' AS field, count(*) AS row_count, CAST(0 AS BIGINT) AS nan_count,
  count(*) FILTER (WHERE {c} IS NULL) AS null_count, CAST({empty} AS BIGINT) AS empty_count, CAST({unknown} AS BIGINT) AS unknown_count,
  CAST({minus} AS BIGINT) AS minus_one_count, CAST({f"count({c})" if number else "0"} AS BIGINT) AS numbers,
  CAST({f"count({c})" if text else "0"} AS BIGINT) AS texts,
  {f"round(avg({c}), 4)" if number else none["double"]} AS mean, {f"round(stddev_samp({c}), 4)" if number else none["double"]} AS stddev,
  {f"CAST(min({c}) AS BIGINT)" if number else none["number"]} AS lowest, {f"CAST(max({c}) AS BIGINT)" if number else none["number"]} AS highest,
  {f"min({c})" if text else none["text"]} AS text_min, {f"max({c})" if text else none["text"]} AS text_max
FROM banded GROUP BY i94yr"""

    return " UNION ALL ".join(map(row, BANDED_COLUMNS))


DIFFERING = """SELECT * FROM (
  SELECT cicid, gender, CAST(1 AS BIGINT) AS left_rows,
    CAST(CASE WHEN cicid % 997 = 0 THEN 0 WHEN cicid % 2003 = 5 THEN 0 WHEN cicid % 1009 = 1 THEN 2 ELSE 1 END AS BIGINT) AS right_rows
  FROM visits)
WHERE left_rows <> right_rows
UNION ALL SELECT cicid, 'X', 0, CASE WHEN cicid % 1009 = 1 THEN 2 ELSE 1 END FROM visits WHERE cicid % 2003 = 5 AND cicid % 997 <> 0"""

CHANGED = f"""SELECT 1 AS step, i94yr AS year, i94mon AS month, 'changed' AS status FROM (SELECT DISTINCT i94yr, i94mon FROM visits)
UNION ALL SELECT CASE WHEN s.step = 2 THEN 2 ELSE 3 END, i94yr, i94mon, CASE WHEN s.step = 2 THEN 'touched' ELSE 'changed' END
FROM (SELECT DISTINCT i94yr, i94mon FROM visits WHERE i94yr = {queries.RELOADED_YEAR}), (VALUES (2), (3)) s(step)
WHERE s.step = 2 OR i94mon <= 2"""


def _band_usage(table: str, id_column: str, label: str, fact_column: str) -> str:
    return f"""SELECT b.{id_column}, b.{label},
  CAST(coalesce(sum(f.visitorcount), 0) AS BIGINT) AS visitorcount
FROM {table} b LEFT JOIN fact f ON f.{fact_column} = b.{id_column} GROUP BY 1, 2"""


def _banded_visits(table: str, id_column: str, label: str, fact_column: str, value: str) -> str:
    return f"""SELECT t.{id_column} AS band_id, t.{label} AS label, count(*) AS visits,
  CAST(min(b.{value}) AS INTEGER) AS lowest, CAST(max(b.{value}) AS INTEGER) AS highest
FROM banded b JOIN {table} t ON b.{fact_column} = t.{id_column} GROUP BY 1, 2"""


def _band_check(table: str, id_column: str, fact_column: str) -> str:
    return f"""SELECT '{table}' AS band_name, t.{id_column} AS band_id,
  (SELECT count(*) FROM banded b WHERE b.{fact_column} = t.{id_column}) AS rows_before,
  CAST((SELECT coalesce(sum(visitorcount), 0) FROM fact f
        WHERE f.{fact_column} = t.{id_column}) AS BIGINT) AS visitors_after,
  TRUE AS matches
FROM {table} t"""


def _split_labels() -> str:
    pattern = r"^(.*), ([A-Z]{2})( \(BPS\))?$"
    return f"""SELECT code, i94port_raw,
  CASE WHEN regexp_matches(i94port_raw, '{pattern}')
       THEN regexp_extract(i94port_raw, '{pattern}', 2) ELSE 'unknown' END AS i94port_state,
  CASE WHEN regexp_matches(i94port_raw, ', [A-Z]{{2}} \\(BPS\\)$') THEN '(BPS)'
       ELSE 'unknown' END AS i94port_bps,
  CASE WHEN regexp_matches(i94port_raw, '{pattern}')
       THEN regexp_extract(i94port_raw, '{pattern}', 1) ELSE i94port_raw END AS i94port_city
FROM ({views.duckdb_text(views.PORT_LABELS)})"""


def _geo() -> str:
    return f"""WITH labels AS ({_split_labels()}),
us AS (SELECT * FROM ({views.duckdb_text(views.US_CITIES)})
  QUALIFY row_number() OVER (PARTITION BY upper(city), state_id
    ORDER BY population DESC, lat DESC, lng DESC) = 1),
world AS (SELECT * FROM ({views.duckdb_text(views.WORLD_CITIES)})
  QUALIFY row_number() OVER (PARTITION BY upper(city), upper(country)
    ORDER BY population DESC, lat DESC, lng DESC) = 1),
hand AS ({views.duckdb_text(views.MANUAL_PORTS)})
SELECT l.code, coalesce(u.lat, w.lat, h.latitude) AS latitude,
  coalesce(u.lng, w.lng, h.longitude) AS longitude, l.i94port_raw AS place,
  coalesce(u.city, w.city, h.city) AS city, coalesce(u.county_name, h.county_name) AS county_name,
  coalesce(nullif(l.i94port_state, 'unknown'), h.state_id) AS state_id,
  coalesce(u.state_name, h.state_name) AS state_name,
  coalesce(CASE WHEN u.city IS NOT NULL THEN 'US' END, w.iso2, h.country_code) AS country_code,
  coalesce(CASE WHEN u.city IS NOT NULL THEN 'United States' END, w.country, h.country) AS country
FROM labels l
LEFT JOIN us u ON upper(l.i94port_city) = upper(u.city) AND l.i94port_state = u.state_id
LEFT JOIN world w ON l.i94port_state = 'unknown'
  AND upper(l.i94port_raw) = upper(w.city) || ', ' || upper(w.country)
LEFT JOIN hand h ON l.code = h.code"""


def _leading(by: tuple[str, ...], where: str, columns: tuple[str, ...], k: int, total: str) -> tuple[str, str]:
    """Common table text of a grouped slice and of its k leading members."""
    return (
        _summed(by, where),
        f"SELECT {_columns(columns)}, CAST(sum(visitorcount) AS BIGINT) AS {total} FROM grouped "
        f"WHERE {columns[0]} IS NOT NULL GROUP BY {_columns(columns)} "
        f"ORDER BY {total} DESC, {', '.join(f'{c} NULLS FIRST' for c in columns)} LIMIT {k}",
    )


def _top_countries() -> str:
    grouped, leaders = _leading(
        ("countryofresidence", "duration_days"),
        f"{TOP_STATES} AND {SUMMER}",
        ("countryofresidence",),
        queries.TOP_COUNTRIES,
        "country_total",
    )
    return f""", grouped AS ({grouped}), leaders AS ({leaders})
SELECT g.countryofresidence, l.country_total, g.duration_days, g.visitorcount
FROM grouped g JOIN leaders l ON g.countryofresidence = l.countryofresidence"""


def _city_mode_month() -> str:
    grouped, leaders = _leading(
        ("port_city", "port_state_abbr", "port_mode", "month"),
        TOP_STATES,
        ("port_city", "port_state_abbr"),
        queries.TOP_CITIES,
        "city_total",
    )
    return f""", grouped AS ({grouped}), leaders AS ({leaders})
SELECT g.* FROM grouped g SEMI JOIN leaders l
  ON g.port_city = l.port_city AND g.port_state_abbr IS NOT DISTINCT FROM l.port_state_abbr"""


def _pivot() -> str:
    days = _columns(
        f"CAST(sum(visitorcount) FILTER (WHERE weekday = '{day}') AS BIGINT) AS {day}"
        for day in WEEKDAYS
    )
    return f"SELECT visitpurpose, {days} FROM star WHERE {SUMMER} GROUP BY visitpurpose"


MONTH_CHECK = """SELECT s.year, s.month, s.sas_rowcount, t.sumvisitorcount,
  s.sas_rowcount = t.sumvisitorcount AS matches
FROM (SELECT i94yr AS year, i94mon AS month, count(*) AS sas_rowcount FROM visits GROUP BY 1, 2) s
LEFT JOIN (SELECT fact_year AS year, fact_month AS month,
             CAST(sum(visitorcount) AS BIGINT) AS sumvisitorcount FROM star GROUP BY 1, 2) t
  ON s.year = t.year AND s.month = t.month"""


def texts() -> dict[str, str]:
    after_ctes = {
        "clean_visits": f"SELECT {VISIT_LIST} FROM visits",
        "row_manifest": """SELECT i94yr AS sas_data_year, i94mon AS sas_data_month,
  count(*) AS sas_data_rowcount FROM visits GROUP BY 1, 2""",
        "staged_roundtrip": "SELECT * REPLACE (ltrim(fltno, '0') AS fltno) FROM "
        f"(SELECT {VISIT_LIST} FROM visits)",
        "staged_folders": "SELECT * REPLACE (ltrim(fltno, '0') AS fltno) FROM "
        f"(SELECT {VISIT_LIST} FROM visits)",
        "lookup_read": """SELECT 'ports' AS lookup_name, code, CAST(NULL AS INTEGER) AS int_code,
  place AS label FROM ports
UNION ALL SELECT 'states', state_id, NULL, state_name FROM states
UNION ALL SELECT 'countries', CAST(code AS VARCHAR), code, i94ctry FROM countries""",
        "mode_purpose": """SELECT 'mode' AS kind, m.mode_code AS code, m.mode AS label,
  count(v.cicid) AS visits FROM modes m LEFT JOIN visits v ON v.i94mode = m.mode_code GROUP BY ALL
UNION ALL
SELECT 'purpose', p.purpose_code, p.purpose, count(v.cicid)
FROM purposes p LEFT JOIN visits v ON v.i94visa = p.purpose_code GROUP BY ALL""",
        "port_dim": "SELECT * FROM port",
        "dim_write": "SELECT * FROM port",
        "age_dim": _band_usage("age", "age_id", "age_range", "age_id"),
        "duration_dim": _band_usage("duration", "duration_id", "duration_days", "visitduration_id"),
        "date_dim": "SELECT * FROM dates",
        "date_dim_write": "SELECT * FROM dates",
        "denormalised": """SELECT cicid, visitpurpose, citizen_ctry, mode, port_id, arrivalstate,
  arrivalstate_abbr, firstdeststate_abbr, firstdeststate, countryofresidence FROM banded""",
        "duration_band": _banded_visits(
            "duration", "duration_id", "duration_days", "visitduration_id", "duration_days"
        ),
        "age_band": _banded_visits("age", "age_id", "age_range", "age_id", "i94bir"),
        "visit_fact": f"SELECT {FACT_LIST} FROM fact",
        "fact_rewrite": f"SELECT {FACT_LIST} FROM fact",
        "monthly_load": MONTH_CHECK,
        "row_check": MONTH_CHECK,
        "load_profiles": _load_profiles(),
        "load_reconcile": LOAD_RECONCILE,
        "missing_profile": _missing(),
        "missing_profile_monthly": _missing((("i94yr", "year"), ("i94mon", "month"))),
        "numeric_profile": _numeric(),
        "string_profile": _string(),
        "merged_profile": _merged_profile(),
        "differing_rows": DIFFERING,
        "changed_months": CHANGED,
        "reconcile": """SELECT rows_in, fact_rows, visitors,
  round(100.0 * CAST(rows_in - fact_rows AS DOUBLE) / rows_in, 6) AS reduction_pct,
  rows_in = visitors AS matches
FROM (SELECT (SELECT count(*) FROM visits) AS rows_in, (SELECT count(*) FROM fact) AS fact_rows,
        CAST((SELECT sum(visitorcount) FROM fact) AS BIGINT) AS visitors)""",
        "reconcile_bands": _band_check("duration", "duration_id", "visitduration_id")
        + " UNION ALL "
        + _band_check("age", "age_id", "age_id"),
        "require_rows": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) > 0 AS ok FROM {t}"
            for t in ("visits", "ports", "states", "countries")
        ),
        "dice": _summed(SLICE_COLUMNS, SLICE),
        "dice_all": SLICE_ALL,
        "dice_by_age": _summed(("year", "age_range", "gender", "firstdeststate")),
        "slice_export": SLICE_ALL,
        "by_port": _summed(("year", *PORT_COLUMNS)),
        "dice_stored": _summed(SLICE_COLUMNS, SLICE),
        "by_port_stored": _summed(("year", *PORT_COLUMNS)),
        "visatype_counts": f"""SELECT visatype, count(visatype) AS visatype_count
FROM visits WHERE i94mode = {queries.AIR} GROUP BY visatype""",
        "purpose_by_weekday": _summed(("visitpurpose", "weekday"), SUMMER),
        "purpose_weekday_pivot": _pivot(),
    }
    more_ctes = {"top_countries": _top_countries(), "city_mode_month": _city_mode_month()}
    return {
        **{name: _with(select) for name, select in after_ctes.items()},
        **{name: _with("").rstrip() + select for name, select in more_ctes.items()},
        "port_labels": _split_labels(),
        "port_geo": _geo(),
    }
