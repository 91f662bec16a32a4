import glob
import re

import pytest
from helpers import D, as_set, plan_of, visits

from arrivalmart.functions.codes import VISIT_COLUMNS
from arrivalmart.operators.quality import QualityError
from arrivalmart.sources import ledger, staging

NAN = float("nan")
RAW_SCHEMA = (
    "cicid double, i94yr double, i94mon double, i94cit double, i94res double, i94port string, "
    "arrdate double, i94mode double, i94addr string, depdate double, i94bir double, i94visa double, "
    "count double, matflag string, biryear double, gender string, insnum string, airline string, "
    "admnum double, fltno string, visatype string"
)


def test_clean_visits(spark):
    full = (5.0, 2016.0, 1.0, 101.0, 102.0, "LOS", 20454.0, 1.0, "CA", 20460.0, 30.9, 2.0, 1.0, "M",
            1986.0, "F", "33", "AA", 92468463130.0, "00120", "B2")
    empty = (6.0, NAN, None, NAN, None, None, None, NAN, None, NAN, NAN, None, None, None, NAN, None,
             None, None, None, None, None)
    cleaned = staging.clean_visits(spark.createDataFrame([full, empty], RAW_SCHEMA))
    assert cleaned.columns == list(VISIT_COLUMNS)
    assert cleaned.schema["cicid"].dataType.simpleString() == "bigint"
    first, second = cleaned.orderBy("cicid").collect()
    assert tuple(first) == (5, 2016, 1, 101, 102, "LOS", D(2016, 1, 1), 1, "CA", D(2016, 1, 7), 30, 2,
                            "M", 1986, "F", "33", "AA", 92468463130, "00120", "B2")
    assert tuple(second) == (6, -1, -1, -1, -1, "unknown", None, -1, "unknown", None, -1, -1, "unknown",
                             -1, "unknown", "unknown", "unknown", -1, "unknown", "unknown")


def test_number_too_big_for_its_column_is_missing(spark):
    raw = spark.createDataFrame([(1e15,) + (1.0,) * 3], "i94yr double, b double, c double, d double")
    full = visits(spark, {}).drop("i94yr").crossJoin(raw.select("i94yr"))
    numbers = [f"CAST(datediff({c}, DATE'1960-01-01') AS DOUBLE) AS {c}" for c in ("arrdate", "depdate")]
    others = [c for c in full.columns if c not in ("arrdate", "depdate")]
    assert staging.clean_visits(full.selectExpr(*others, *numbers)).first()["i94yr"] == -1


def test_roundtrip_keeps_blanks_and_quotes_and_reads_empty_text_as_null(spark, tmp_path):
    path = str(tmp_path / "staged")
    rows = visits(
        spark,
        {"fltno": "00120", "depdate": None},
        {"fltno": "000", "airline": ' A "quoted", one\\'},
        {"fltno": "0A0", "gender": None, "matflag": ""},
    )
    staging.write_staged(rows, path)
    read = staging.read_visits(spark, path)
    assert read.dtypes == rows.dtypes
    assert as_set(read, "cicid", "fltno", "airline", "gender", "matflag", "depdate") == {
        (0, "120", "AA", "F", "M", None),
        (1, "", ' A "quoted", one\\', "F", "M", D(2016, 6, 6)),
        (2, "A0", "AA", None, None, D(2016, 6, 6)),
    }


def test_staged_again_replaces_the_month_only(spark, tmp_path):
    path = str(tmp_path / "staged")
    staging.write_staged(visits(spark, {}, {}, {"i94mon": 7}), path)
    staging.write_staged(visits(spark, {"cicid": 9}), path, clustered=False)
    assert as_set(staging.read_visits(spark, path), "cicid", "i94mon") == {(9, 6), (2, 7)}
    july = staging.read_visits(spark, path, [(2016, 7)])
    assert as_set(july, "cicid") == {(2,)}
    assert "PartitionFilters: [isnotnull(year" in plan_of(july).replace("(year#", "(year ")


def test_files_hold_at_most_the_given_rows(spark, tmp_path):
    path = str(tmp_path / "staged")
    staging.write_staged(visits(spark, *[{}] * 25).coalesce(1), path, rows_per_file=10)
    files = glob.glob(f"{path}/year=2016/month=6/*.csv")
    assert sorted(len(open(f).readlines()) - 1 for f in files) == [5, 10, 10]


def test_folder_layout_with_index_column_and_bad_text(spark, tmp_path):
    folder = tmp_path / "2016" / "06"
    folder.mkdir(parents=True)
    header = "," + ",".join(VISIT_COLUMNS)
    good = "0,5,2016,6,101,101,LOS,2016-06-01,1,CA,,30,2,M,1986,F,unknown,AA,77,00120,B2"
    bad = "1,x,2016,6,?,101,LOS,soon,1,CA,2016-02-30,abc,2,M,1986,F,unknown,AA,77,0,B2"
    (folder / "i94_jun16_sub_000.csv").write_text("\n".join([header, good]) + "\n")
    (folder / "i94_jun16_sub_001.csv").write_text("\n".join([header, bad]) + "\n")
    read = staging.read_visits(spark, str(tmp_path), [(2016, 6)], layout="folders")
    assert as_set(read, "cicid", "i94cit", "arrdate", "depdate", "i94bir", "fltno") == {
        (5, 101, D(2016, 6, 1), None, 30, "120"),
        (None, None, None, None, None, ""),
    }
    assert staging.read_visits(spark, str(tmp_path), layout="folders").count() == 2


def test_month_without_rows_is_refused(spark, tmp_path):
    path = str(tmp_path / "staged")
    staging.write_staged(visits(spark, {}), path)
    with pytest.raises(QualityError):
        staging.read_visits(spark, path, [(2015, 1)])


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "manifest")
    staging.write_manifest(staging.row_manifest(visits(spark, {}, {}, {"i94mon": 7})), path)
    staging.write_manifest(staging.row_manifest(visits(spark, {}, {}, {})), path)
    columns = ("sas_data_year", "sas_data_month", "sas_data_rowcount")
    assert as_set(staging.read_manifest(spark, path), *columns) == {(2016, 6, 3), (2016, 7, 1)}
    assert as_set(staging.read_manifest(spark, path, [(2016, 7)]), *columns) == {(2016, 7, 1)}


LINE = "5,2016,6,101,102,LOS,2016-06-01,1,CA,,30,2,M,1986,F,unknown,AA,77,00120,B2"


def folder_of(tmp_path, header, line):
    folder = tmp_path / "2016" / "06"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(f"{header}\n{line}\n")
    return str(tmp_path)


@pytest.mark.parametrize("order", ["as written", "swapped", "more", "index"])
def test_columns_are_found_by_their_header(spark, tmp_path, order):
    names, values = list(VISIT_COLUMNS), LINE.split(",")
    if order == "swapped":
        names, values = names[::-1], values[::-1]
    if order == "more":
        names, values = [*names[:4], "extra", *names[4:]], [*values[:4], "x", *values[4:]]
    if order == "index":
        names, values = ["", *names], ["0", *values]
    path = folder_of(tmp_path, ",".join(names), ",".join(values))
    read = staging.read_visits(spark, path, [(2016, 6)], layout="folders")
    assert as_set(read, "i94yr", "i94mon", "i94cit", "i94res", "fltno") == {(2016, 6, 101, 102, "120")}


def test_a_missing_column_is_refused(spark, tmp_path):
    path = folder_of(tmp_path, ",".join(VISIT_COLUMNS[1:]), LINE.split(",", 1)[1])
    with pytest.raises(QualityError, match="no column cicid"):
        staging.read_visits(spark, path, layout="folders")


def test_decimal_text_counts_by_its_whole_part(spark, tmp_path):
    line = LINE.replace("2016,6,101", "2016.0,6.,101.9")
    read = staging.read_visits(spark, folder_of(tmp_path, ",".join(VISIT_COLUMNS), line), layout="folders")
    assert as_set(read, "i94yr", "i94mon", "i94cit") == {(2016, 6, 101)}


def test_line_breaks_quotes_and_backslashes_survive(spark, tmp_path):
    path = str(tmp_path / "staged")
    odd = ['two\nlines', 'a\r\nb', '\\n', '\\', 'q"uo"te', '\\b\\\n']
    rows = visits(spark, *[{"airline": o} for o in odd])
    assert staging.write_staged(rows, path) == [(2016, 6)]
    assert as_set(staging.read_visits(spark, path), "cicid", "airline") == set(enumerate(odd))
    counted = staging.staged_manifest(spark, path, [(2016, 6)])
    assert as_set(counted, *counted.columns) == {(2016, 6, len(odd))}


def test_other_manifest_header_is_refused(spark, tmp_path):
    (tmp_path / "m.csv").write_text("sas_data_month,sas_data_year,sas_data_rowcount\n6,2016,3\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        staging.read_manifest(spark, str(tmp_path)).collect()


def test_reading_is_one_method_that_the_jvm_compiles(spark, tmp_path, capsys):
    path = str(tmp_path / "staged")
    staging.write_staged(visits(spark, {}), path)
    staging.read_visits(spark, path).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_text_is_escaped_after_the_shuffle(spark, tmp_path):
    rows = visits(spark, {"airline": "a\\b\nc", "fltno": "007"}, {"airline": "\\n", "i94mon": 7})
    path = str(tmp_path / "staged")
    staging.write_staged(rows, path, clustered=False)
    assert as_set(staging.read_visits(spark, path), "airline", "fltno") == {("a\\b\nc", "7"), ("\\n", "12")}


def test_months_staged_in_parts_are_those_staged_at_once(spark, tmp_path, monkeypatch):
    rows = visits(spark, *[{"i94mon": k % 5 + 1, "i94yr": None if k == 7 else 2016, "airline": f'"{k}\\', "cicid": k} for k in range(40)], {"i94yr": None, "i94mon": None}, {"i94yr": -1})
    assert len(staging.month_parts(rows)) == 1
    monkeypatch.setattr(staging, "BATCH_ROWS", 10)
    parts = staging.month_parts(rows)
    held = [as_set(part, "cicid", "i94yr", "i94mon") for part in parts]
    assert len(parts) > 3 and sum(part.count() for part in parts) == 42 and set().union(*held) == as_set(rows, "cicid", "i94yr", "i94mon")
    cleaned = [{(-1 if y is None else y, -1 if m is None else m) for _, y, m in part} for part in held]
    assert sum(map(len, cleaned)) == len(set().union(*cleaned))

    whole, packed = str(tmp_path / "whole"), str(tmp_path / "packed")
    months = staging.write_staged(rows, whole, clustered=False)
    written = [staging.write_staged(part, packed, clustered=False, packed=True) for part in parts]
    assert sorted((m for part in written for m in part), key=str) == months
    assert glob.glob(f"{packed}/year=2016/month=2/*.csv.gz") and not glob.glob(f"{packed}/*/*/*.csv")
    read = [sorted(staging.read_visits(spark, path).collect(), key=str) for path in (whole, packed)]
    assert read[0] == read[1] and len(read[0]) == 42
    counted = [as_set(staging.staged_manifest(spark, path, [(2016, m) for m in range(1, 6)]), "sas_data_month", "sas_data_rowcount") for path in (whole, packed)]
    assert counted[0] == counted[1] and sum(n for _, n in counted[0]) == 39


def test_the_ledger_sees_packed_files_by_their_lines(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("plain", "packed")]
    for path, packed in zip(paths, (False, True), strict=True):
        staging.write_staged(visits(spark, *[{"i94mon": k % 2 + 1, "cicid": k} for k in range(9)]).coalesce(1), path, packed=packed)
    found = [ledger.changes(spark, path, str(tmp_path / "none")) for path in paths]
    assert found[0].changed == found[1].changed == [(2016, 1), (2016, 2)]
    lines = [as_set(f.rows, "month", "lines", "content") for f in found]
    assert lines[0] == lines[1] and {n for _, n, _ in lines[0]} == {5, 6}
