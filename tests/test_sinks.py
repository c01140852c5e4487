"""Writers: empty guard, CSV / Parquet round trips, unsupported format, names."""

import datetime as dt
import math
import os

import pytest

from dailybars.errors import WrongFormatError
from dailybars.sinks import check_format, report_path, write_report, write_table
from dailybars.sources.files import read_csv_table, read_parquet


def small(spark):
    return spark.createDataFrame([("A", "B"), ("C", "D")], "col1 string, col2 string")


def test_empty_frame_writes_nothing(spark, tmp):
    empty = spark.createDataFrame([], "col1 string")
    assert write_table(empty, f"{tmp}/out", "csv") is False
    assert not os.path.exists(f"{tmp}/out")
    # Emptiness is tested before the format, as before.
    assert write_table(empty, f"{tmp}/out", "wrong_format") is False


def test_csv_round_trip(spark, tmp):
    assert write_table(small(spark), f"{tmp}/t.csv", "csv")
    back = read_csv_table(spark, f"{tmp}/t.csv", "col1 string, col2 string")
    assert sorted(tuple(r) for r in back.collect()) == [("A", "B"), ("C", "D")]


def test_parquet_round_trip(spark, tmp):
    assert write_table(small(spark), f"{tmp}/t.parquet", "parquet")
    back = read_parquet(spark, f"{tmp}/t.parquet")
    assert back.columns == ["col1", "col2"]
    assert sorted(tuple(r) for r in back.collect()) == [("A", "B"), ("C", "D")]


def test_wrong_format_raises(spark, tmp):
    with pytest.raises(WrongFormatError):
        write_table(small(spark), f"{tmp}/t", "wrong_format")
    with pytest.raises(WrongFormatError):
        check_format("json")


def test_report_path_has_no_colons():
    p = report_path("/r", "report1/daily", dt.datetime(2022, 3, 20, 12, 5, 7), "parquet")
    assert p == "/r/report1/daily_20220320T120507.parquet"


def test_percent_column_and_infinity_round_trip(spark, tmp):
    df = spark.createDataFrame([("X", math.inf), ("Y", None), ("Z", -math.inf)],
                               "ISIN string, `ChangePrevClosing%` double")
    for fmt in ("parquet", "csv"):
        path = write_report(df, tmp, "rep", fmt, dt.datetime(2022, 3, 20), by_date=False)
        if fmt == "parquet":
            back = read_parquet(spark, path)
        else:
            back = read_csv_table(spark, path, "ISIN string, `ChangePrevClosing%` double")
        got = {r["ISIN"]: r["ChangePrevClosing%"] for r in back.collect()}
        assert got == {"X": math.inf, "Y": None, "Z": -math.inf}, fmt


def test_by_date_rewrites_days(spark, tmp):
    first = spark.createDataFrame([("X", dt.date(2022, 3, 1), 1.0), ("X", dt.date(2022, 3, 2), 2.0)],
                                  "ISIN string, Date date, v double")
    again = spark.createDataFrame([("X", dt.date(2022, 3, 2), 3.0)], "ISIN string, Date date, v double")
    write_report(first, tmp, "rep", "parquet", dt.datetime(2022, 3, 2), by_date=True)
    write_report(again, tmp, "rep", "parquet", dt.datetime(2022, 3, 3), by_date=True)
    got = sorted((r["Date"].day, r["v"]) for r in read_parquet(spark, f"{tmp}/rep").collect())
    assert got == [(1, 1.0), (2, 3.0)]


def test_by_date_files_sorted_by_instrument(spark, tmp):
    rows = [(isin, dt.date(2022, 3, d), float(d)) for d in (1, 2) for isin in ("C", "A", "B", "D")]
    df = spark.createDataFrame(rows, "ISIN string, Date date, v double").repartition(3)
    write_report(df, tmp, "rep", "parquet", dt.datetime(2022, 3, 2), by_date=True,
                 sort_within=["ISIN"])
    import pyarrow.parquet as pq
    for day in ("2022-03-01", "2022-03-02"):
        folder = f"{tmp}/rep/Date={day}"
        files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        assert len(files) == 1
        assert pq.read_table(f"{folder}/{files[0]}").column("ISIN").to_pylist() == ["A", "B", "C", "D"]
