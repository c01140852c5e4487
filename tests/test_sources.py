"""CSV extract, listing and the reading rules (header order, NA words,
short / long rows, header-only files, missing dates, header drift)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SOURCE_COLUMNS, TICKS, write_csv, write_golden_files
from dailybars.sources.csv_ticks import date_glob, read_ticks_csv
from dailybars.sources.layouts import csv_layouts, file_headers
from dailybars.sources.files import date_from_path, list_files

D = dt.date


def days(first, last):
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def test_extract_no_dates_gives_typed_empty(spark, tmp):
    write_golden_files(tmp)
    df = read_ticks_csv(spark, tmp, [D(2200, 1, 2)])
    assert df.count() == 0
    assert df.columns == SOURCE_COLUMNS
    assert dict(df.dtypes)["StartPrice"] == "double"


def test_extract_files_of_listed_dates(spark, tmp):
    write_golden_files(tmp)
    df = read_ticks_csv(spark, tmp, days(D(2021, 4, 16), D(2021, 4, 20)))
    got = sorted((r["Date"].isoformat(), r["Time"], r["StartPrice"], r["TradedVolume"])
                 for r in df.collect())
    exp = sorted((t[2], t[3], t[4], t[8]) for t in TICKS[1:])
    assert got == exp
    assert dict(df.dtypes) == {"ISIN": "string", "Mnemonic": "string", "Date": "date",
                               "Time": "string", "StartPrice": "double", "EndPrice": "double",
                               "MinPrice": "double", "MaxPrice": "double",
                               "TradedVolume": "bigint"}


def test_glob_is_stricter_than_prefix(spark, tmp):
    write_golden_files(tmp)
    write_csv(f"{tmp}/2021-04-170/x.csv", SOURCE_COLUMNS, [TICKS[2]])
    df = read_ticks_csv(spark, tmp, [D(2021, 4, 17)])
    assert df.count() == 2


def test_header_only_file_is_skipped(spark, tmp):
    write_golden_files(tmp)
    write_csv(f"{tmp}/2021-04-18/holiday.csv", SOURCE_COLUMNS, [])
    df = read_ticks_csv(spark, tmp, [D(2021, 4, 18)])
    assert df.count() == 2


def test_swapped_header_fails_instead_of_misreading(spark, tmp):
    write_golden_files(tmp)
    swapped = SOURCE_COLUMNS[:4] + ["EndPrice", "StartPrice"] + SOURCE_COLUMNS[6:]
    row = TICKS[4][:4] + (TICKS[4][5], TICKS[4][4]) + TICKS[4][6:]
    write_csv(f"{tmp}/2021-04-18/swapped.csv", swapped, [row])
    with pytest.raises(Exception):
        read_ticks_csv(spark, tmp, [D(2021, 4, 18)], columns=SOURCE_COLUMNS).collect()


def test_header_drift_by_name(spark, tmp):
    write_golden_files(tmp)
    swapped = ["Time", "ISIN", "Date", "StartPrice", "MaxPrice", "MinPrice", "TradedVolume"]
    write_csv(f"{tmp}/2021-04-20/drift.csv", swapped,
              [("10:00", "AT0000A0E9W5", "2021-04-20", 30.0, 31.0, 29.0, 7)])
    df = read_ticks_csv(spark, tmp, days(D(2021, 4, 19), D(2021, 4, 20)), by_name=True)
    rows = {r["Date"]: r for r in df.collect() if r["Date"] == D(2021, 4, 20)}
    r = rows[D(2021, 4, 20)]
    assert (r["StartPrice"], r["MaxPrice"], r["MinPrice"], r["TradedVolume"]) == (30.0, 31.0, 29.0, 7)
    assert r["Mnemonic"] is None and r["EndPrice"] is None
    assert df.count() == 4


def test_na_words_and_nan_become_null(spark, tmp):
    rows = [("X", "NA", "2021-04-15", "09:00", "NaN", "null", "", "n/a", "5"),
            ("Y", "M", "2021-04-15", "09:00", "1.5", "2", "1", "3", "NULL")]
    write_csv(f"{tmp}/2021-04-15/a.csv", SOURCE_COLUMNS, rows)
    got = {r["ISIN"]: r for r in read_ticks_csv(spark, tmp).collect()}
    x = got["X"]
    assert x["Mnemonic"] is None and x["StartPrice"] is None and x["EndPrice"] is None
    assert x["MinPrice"] is None and x["MaxPrice"] is None and x["TradedVolume"] == 5
    assert got["Y"]["TradedVolume"] is None and got["Y"]["StartPrice"] == 1.5


def test_short_rows_kept_long_rows_fail(spark, tmp):
    d = f"{tmp}/short"
    os.makedirs(f"{d}/2021-04-15")
    with open(f"{d}/2021-04-15/a.csv", "w") as fh:
        fh.write(",".join(SOURCE_COLUMNS) + "\nX,M,2021-04-15,09:00,1.0,2.0\n")
    r = read_ticks_csv(spark, d).collect()
    assert len(r) == 1 and r[0]["EndPrice"] == 2.0 and r[0]["MinPrice"] is None
    d2 = f"{tmp}/long"
    os.makedirs(f"{d2}/2021-04-15")
    with open(f"{d2}/2021-04-15/a.csv", "w") as fh:
        fh.write(",".join(SOURCE_COLUMNS) + "\nX,M,2021-04-15,09:00,1,2,3,4,5,EXTRA\n")
    with pytest.raises(Exception, match="more fields"):
        read_ticks_csv(spark, d2).collect()


def test_delimiter_and_quotes(spark, tmp):
    os.makedirs(f"{tmp}/2021-04-15")
    with open(f"{tmp}/2021-04-15/a.csv", "w", encoding="utf-8") as fh:
        fh.write(";".join(SOURCE_COLUMNS) + "\n")
        fh.write('X;"Name ""quoted""";2021-04-15;09:00;1.0;2.0;0.5;2.5;10\n')
    r = read_ticks_csv(spark, tmp, sep=";").first()
    assert r["Mnemonic"] == 'Name "quoted"' and r["TradedVolume"] == 10


def test_multi_line_quoted_field(spark, tmp):
    os.makedirs(f"{tmp}/2021-04-15")
    with open(f"{tmp}/2021-04-15/a.csv", "w", encoding="utf-8") as fh:
        fh.write(",".join(SOURCE_COLUMNS) + "\n")
        fh.write('X,"two\nlines",2021-04-15,09:00,1.0,2.0,0.5,2.5,10\n')
    r = read_ticks_csv(spark, tmp, multi_line=True).collect()
    assert len(r) == 1 and r[0]["Mnemonic"] == "two\nlines"


def test_latin1_encoding(spark, tmp):
    os.makedirs(f"{tmp}/2021-04-15")
    with open(f"{tmp}/2021-04-15/a.csv", "w", encoding="latin-1") as fh:
        fh.write(",".join(SOURCE_COLUMNS) + "\n")
        fh.write("X,Zürich,2021-04-15,09:00,1.0,2.0,0.5,2.5,10\n")
    r = read_ticks_csv(spark, tmp, encoding="ISO-8859-1").first()
    assert r["Mnemonic"] == "Zürich"


def test_source_date_from_path(spark, tmp):
    write_golden_files(tmp)
    df = read_ticks_csv(spark, tmp, with_source_date=True)
    assert all(r["source_date"] == r["Date"] for r in df.collect())


def test_list_files_and_missing_prefix(spark, tmp):
    write_golden_files(tmp)
    listed = list_files(spark, date_glob(tmp, [D(2021, 4, 19)]))
    names = sorted(os.path.basename(r["path"]) for r in listed.collect())
    assert names == ["2021-04-19_07.csv", "2021-04-19_08.csv",
                     "2021-04-19_09.csv"]
    assert list_files(spark, f"{tmp}/wrong-prefix/*").count() == 0
    dated = listed.select(date_from_path("path").alias("d")).distinct().collect()
    assert [r["d"] for r in dated] == [D(2021, 4, 19)]


def test_file_headers_distributed(spark, tmp):
    write_golden_files(tmp)
    heads = file_headers(spark, date_glob(tmp, None)).select("header").distinct().collect()
    assert [r["header"] for r in heads] == [",".join(SOURCE_COLUMNS)]


def test_scan_prunes_columns(spark, tmp):
    from conftest import explain_text
    write_golden_files(tmp)
    df = read_ticks_csv(spark, tmp).select("ISIN", F.col("StartPrice"))
    plan = explain_text(df)
    assert "ReadSchema: struct<ISIN:string,StartPrice:string" in plan


def test_layouts_list_only_what_departs_from_the_most_common_one(spark, tmp):
    a, b, c = ["x", "y"], ["y", "x"], ["z"]
    for path, header in {"d1/f1.csv": a, "d1/f2.csv": a, "d2/f.csv": a, "d3/f.csv": a,
                         "d3/g.csv": b, "d4/g.csv": b, "flat.csv": a, "other.csv": c}.items():
        write_csv(f"{tmp}/{path}", header, [])
    first, *rest = csv_layouts(spark, tmp)
    assert first.rest and first.columns == ("x", "y")
    below = lambda paths: sorted(p.split(tmp, 1)[1] for p in paths)
    assert (below(first.folders), below(first.files)) == (["/d4"], ["/d3/g.csv", "/other.csv"])
    assert {lay.columns: (below(lay.folders), below(lay.files)) for lay in rest} == {
        ("y", "x"): (["/d4"], ["/d3/g.csv"]), ("z",): ([], ["/other.csv"])}


def test_list_prefix_semantics(spark, tmp):
    from dailybars.sources.files import list_prefix
    write_csv(f"{tmp}/prefix/test1.csv", ["col1", "col2"], [("valA", "valB")])
    write_csv(f"{tmp}/prefix/test2.csv", ["col1", "col2"], [("valA", "valB")])
    names = sorted(os.path.basename(r["path"]) for r in list_prefix(spark, tmp, "prefix/").collect())
    assert names == ["test1.csv", "test2.csv"]
    assert list_prefix(spark, tmp, "wrong-prefix/").count() == 0
    write_golden_files(f"{tmp}/src")
    write_csv(f"{tmp}/src/2021-04-170/x.csv", SOURCE_COLUMNS, [TICKS[2]])
    # A key prefix also matches the longer folder name, unlike the extract's glob.
    assert list_prefix(spark, f"{tmp}/src", "2021-04-17").count() == 3
    assert list_prefix(spark, f"{tmp}/src", "2021-04-19/2021-04-19_0").count() == 3


def test_utf8_bom_header(spark, tmp):
    os.makedirs(f"{tmp}/2021-04-15")
    with open(f"{tmp}/2021-04-15/a.csv", "w", encoding="utf-8-sig") as fh:
        fh.write(",".join(SOURCE_COLUMNS) + "\nX,M,2021-04-15,09:00,1.0,2.0,0.5,2.5,10\n")
    for by_name in (False, True):
        r = read_ticks_csv(spark, tmp, by_name=by_name).collect()
        assert [(x["ISIN"], x["TradedVolume"]) for x in r] == [("X", 10)], by_name
