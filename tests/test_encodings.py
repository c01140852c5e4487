"""Files whose characters, and line feeds, are not single bytes."""

import datetime as dt
import json
import os
import subprocess
import sys

import pytest

from conftest import SOURCE_COLUMNS
from dailybars.config import JobConfig
from dailybars.errors import UnusableSourceError
from dailybars.plans.job import ReportJob
from dailybars.session import build_session
from dailybars.sources import layouts as L
from dailybars.sources.csv_ticks import read_ticks_csv
from dailybars.sources.files import read_parquet

DAY = dt.date(2022, 3, 18)
ROWS = ['X,"Müller, ""A"" & Co",2022-03-18,09:00,1,2,3,4,5', "Y,日本,2022-03-18,10:00,1,2,3,4,",
        "Z,ĀĂ😀,2022-03-18,11:00,1,2,3,4,7.0", "", "X,short,2022-03-18,12:00,8"]
NAMES = {"X": ['Müller, "A" & Co', "short"], "Y": ["日本"], "Z": ["ĀĂ😀"]}


def write(path, rows=ROWS, encoding="utf-8", header=SOURCE_COLUMNS, end="\n", mark=""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = mark + end.join([",".join(header), *rows]) + end
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))


def config(tmp, **kw):
    options = {k: kw.pop(k) for k in ("encoding", "by_name", "multi_line") if k in kw}
    return JobConfig(source_root=f"{tmp}/src", target_root=f"{tmp}/trg", ledger_path=f"{tmp}/meta",
                     first_extract_date=DAY, end_date=DAY, csv_options=options, **kw)


def names(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["ISIN"], []).append(r["Mnemonic"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("encoding, end", [("utf-8-sig", "\r\n"), ("UTF-16LE", "\r\n"),
                                           ("utf-16-be", "\n"), ("utf_16", "\n")])
@pytest.mark.parametrize("how", [{}, {"by_name": True}, {"multi_line": True}])
def test_same_rows_in_every_encoding(spark, tmp, encoding, how, end):
    write(f"{tmp}/src/2022-03-18/a.csv", encoding=encoding, end=end)
    ticks = read_ticks_csv(spark, f"{tmp}/src", encoding=encoding, with_source_date=True, **how)
    assert names(ticks) == NAMES
    rows = {(r["ISIN"], r["Time"]): r for r in ticks.collect()}
    assert rows["Y", "10:00"]["TradedVolume"] is None and rows["Z", "11:00"]["TradedVolume"] == 7
    assert rows["X", "12:00"]["MaxPrice"] is None
    assert {r["source_date"] for r in rows.values()} == {DAY}
    report = read_parquet(spark, ReportJob(spark, config(tmp, encoding=encoding, **how)).run())
    assert report.count() == 3


def test_marks_tell_the_order_of_bytes_file_by_file(spark, tmp):
    write(f"{tmp}/src/2022-03-18/le.csv", ROWS[:1], "utf-16-le", mark="﻿")
    write(f"{tmp}/src/2022-03-18/be.csv", ROWS[1:2], "utf-16-be", mark="﻿")
    write(f"{tmp}/src/2022-03-18/none.csv", ROWS[2:3], "utf-16-le")
    for by_name in (False, True):
        ticks = read_ticks_csv(spark, f"{tmp}/src", encoding="utf-16", by_name=by_name)
        assert sorted(names(ticks)) == ["X", "Y", "Z"]


def test_header_drift_in_utf16(spark, tmp):
    write(f"{tmp}/src/2022-03-18/a.csv", ROWS[:1], "utf-16")
    write(f"{tmp}/src/2022-03-18/b.csv", ["09:30,Q,2022-03-18,4.5"], "utf-16-be", mark="﻿",
          header=["Time", "ISIN", "Date", "StartPrice"])
    rows = {r["ISIN"]: r for r in read_ticks_csv(spark, f"{tmp}/src", encoding="utf-16",
                                                 by_name=True).collect()}
    assert (rows["Q"]["Time"], rows["Q"]["StartPrice"], rows["Q"]["EndPrice"]) == ("09:30", 4.5, None)
    with pytest.raises(ValueError, match="headers differ"):
        read_ticks_csv(spark, f"{tmp}/src", encoding="utf-16")


def test_large_utf16_file_is_split(spark, tmp):
    rows = [f"I{k},名{k % 7}Ā,2022-03-18,09:00,{k},2,3,4,5" for k in range(20_000)]
    write(f"{tmp}/src/2022-03-18/a.csv", rows, "utf-16-le")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100003")     # odd: inside characters
    try:
        ticks = read_ticks_csv(spark, f"{tmp}/src", encoding="utf-16-le")
        assert ticks.rdd.getNumPartitions() > 8
        found = sorted((r["ISIN"], r["Mnemonic"], r["StartPrice"]) for r in ticks.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == sorted((f"I{k}", f"名{k % 7}Ā", float(k)) for k in range(20_000))


def test_long_row_and_malformed_value_fail_in_utf16(spark, tmp):
    write(f"{tmp}/src/2022-03-18/a.csv", [ROWS[1] + ",9,9"], "utf-16-le")
    ticks = read_ticks_csv(spark, f"{tmp}/src", encoding="utf-16-le")
    for action in (ticks.collect, ticks.count, ticks.select("ISIN").collect):
        with pytest.raises(Exception, match="more fields than the header"):
            action()
    write(f"{tmp}/src/2022-03-18/a.csv", ["X,M,2022-03-18,09:00,1x,2,3,4,5"], "utf-16-le")
    with pytest.raises(Exception, match="malformed double in column StartPrice"):
        read_ticks_csv(spark, f"{tmp}/src", encoding="utf-16-le").collect()


def test_line_feed_bytes_inside_other_characters(spark, tmp):
    """U+0A41 followed by U+0100 holds the bytes of a line feed, off by one."""
    write(f"{tmp}/src/2022-03-18/a.csv", ["X,a䄊Āb,2022-03-18,09:00,1,2,3,4,5"], "utf-16-be")
    write(f"{tmp}/src/2022-03-18/b.csv", ["Y,aੁĀb,2022-03-18,09:00,1,2,3,4,5"], "utf-16-le")
    le = read_ticks_csv(spark, f"{tmp}/src", file_glob="b.csv", encoding="utf-16-le")
    with pytest.raises(Exception, match="torn|MALFORMED"):
        le.collect()
    whole = read_ticks_csv(spark, f"{tmp}/src", file_glob="b.csv", encoding="utf-16-le",
                           multi_line=True)
    assert names(whole) == {"Y": ["aੁĀb"]}


@pytest.mark.parametrize("encoding", ["latin-1", "latin_1", "ISO-8859-1", "l1"])
def test_python_names_of_encodings(spark, tmp, encoding):
    write(f"{tmp}/src/2022-03-18/a.csv", ROWS[:1], "latin-1")
    for how in ({}, {"by_name": True}, {"multi_line": True}):
        assert names(read_ticks_csv(spark, f"{tmp}/src", encoding=encoding, **how)) == {
            "X": NAMES["X"][:1]}


@pytest.mark.parametrize("encoding", ["cp1252", "no-such-thing", "utf-32"])
def test_what_cannot_be_read_is_refused_before_any_work(spark, tmp, encoding):
    write(f"{tmp}/src/2022-03-18/a.csv", ROWS[:1])
    with pytest.raises(ValueError, match="cannot be"):
        ReportJob(spark, config(tmp, encoding=encoding)).run()
    assert not os.path.exists(f"{tmp}/trg") and not os.path.exists(f"{tmp}/meta")


def test_wrong_encoding_never_records_the_day(spark, tmp):
    """Every pair of right and wrong encodings: the same report, or a failure
    before anything is written."""
    codes = ["utf-8", "utf-16-le", "utf-16-be", "utf-16", "latin-1"]
    for k, (written, read) in enumerate((a, b) for a in codes for b in codes if a != b):
        root = f"{tmp}/{k}"
        write(f"{root}/src/2022-03-18/a.csv", ["X,M,2022-03-18,09:00,1,2,3,4,5"], written)
        try:
            path = ReportJob(spark, config(root, encoding=read)).run()
        except Exception:
            assert not os.path.exists(f"{root}/trg") and not os.path.exists(f"{root}/meta")
        else:
            assert path and read_parquet(spark, path).count() == 1, (written, read)


def test_day_of_unusable_rows_fails_and_a_header_only_day_is_recorded(spark, tmp):
    end = DAY + dt.timedelta(days=2)
    write(f"{tmp}/src/2022-03-18/a.csv", ["X,M,2022-03-18,09:00,1,2,3,4,5"])
    write(f"{tmp}/src/2022-03-19/a.csv", [])
    write(f"{tmp}/src/2022-03-20/a.csv", [",M,2022-03-20,09:00,1,2,3,4,5", "X,M,,09:00,1,2,3,4,5"])
    cfg = JobConfig(source_root=f"{tmp}/src", target_root=f"{tmp}/trg", ledger_path=f"{tmp}/meta",
                    first_extract_date=DAY, end_date=end)
    with pytest.raises(UnusableSourceError, match=r"2022-03-20 \(2 rows\)"):
        ReportJob(spark, cfg).run()
    assert not os.path.exists(f"{tmp}/trg") and not os.path.exists(f"{tmp}/meta")
    # A day whose only usable tick has another date is the sender's business.
    write(f"{tmp}/src/2022-03-20/a.csv", ["Y,M,2022-03-18,09:00,1,2,3,4,5", ",,,,,,,,"])
    assert ReportJob(spark, cfg).run()
    from dailybars.streaming.ledger import read_ledger
    assert {r["source_date"] for r in read_ledger(spark, f"{tmp}/meta").collect()} == {
        "2022-03-18", "2022-03-19", "2022-03-20"}


def test_header_pass_does_not_read_the_files(tmp):
    """Bytes that the header pass reads, from Spark's event log of a session
    of its own."""
    code = """
import json, os, sys
sys.path.insert(0, os.getcwd())
from dailybars.session import build_session
from dailybars.sources.layouts import csv_layouts
log = sys.argv[1] + "/log"
os.makedirs(log)
spark = build_session("local[2]", 2, extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log,
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
for size in sys.argv[2:]:
    spark.sparkContext.setJobDescription(size)
    assert len(csv_layouts(spark, f"{sys.argv[1]}/{size}")) == 2
spark.stop()
stages, read = {}, {}
for line in open(log + "/" + os.listdir(log)[0]):
    event = json.loads(line)
    if event["Event"] == "SparkListenerJobStart":
        stages |= {s: event["Properties"].get("spark.job.description") for s in event["Stage IDs"]}
    elif event["Event"] == "SparkListenerTaskEnd":
        of = stages[event["Stage ID"]]
        read[of] = read.get(of, 0) + event["Task Metrics"]["Input Metrics"]["Bytes Read"]
print(json.dumps(read))
"""
    for n in (300_000, 1_200_000):
        write(f"{tmp}/{n}/2022-03-18/small.csv", ["1,2"], header=["p", "q"])
        write(f"{tmp}/{n}/2022-03-18/large.csv", ["X,M,2022-03-18,09:00,1,2,3,4,5"] * n)
    done = subprocess.run([sys.executable, "-c", code, tmp, "300000", "1200000"], text=True,
                          capture_output=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    read = json.loads(done.stdout.splitlines()[-1])
    assert os.path.getsize(f"{tmp}/1200000/2022-03-18/large.csv") > 30e6
    assert read["300000"] < 1e6 and read["1200000"] < 1e6, read


def test_headers_are_the_same_whatever_the_size(spark, tmp, monkeypatch):
    write(f"{tmp}/2022-03-18/a [1]{{2}}*.csv", ROWS[:3])
    write(f"{tmp}/2022-03-18/b.csv", ["1,2"], header=["p", "q"])
    write(f"{tmp}/2022-03-19_flat.csv", [], "utf-8-sig")
    write(f"{tmp}/2022-03-19/empty.csv", [], header=[])
    few = sorted(map(tuple, L.file_headers(spark, tmp).collect()))
    monkeypatch.setattr(L, "SMALL_FILE", 0)
    assert sorted(map(tuple, L.file_headers(spark, tmp).collect())) == few
    assert len(few) == 3


def test_build_session_is_shared(spark):
    assert build_session("local[4]", 4).sparkContext is spark.sparkContext
