import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dailybars.session import build_session  # noqa: E402

from dailybars.config import SOURCE_COLUMN_NAMES  # noqa: E402

SOURCE_COLUMNS = list(SOURCE_COLUMN_NAMES)

# The golden ticks (one instrument, five days, one file per
# hour) and the report rows that must come out of them.
TICKS = [
    ("AT0000A0E9W5", "SANT", "2021-04-15", "12:00", 20.19, 18.45, 18.20, 20.33, 877),
    ("AT0000A0E9W5", "SANT", "2021-04-16", "15:00", 18.27, 21.19, 18.27, 21.34, 987),
    ("AT0000A0E9W5", "SANT", "2021-04-17", "13:00", 20.21, 18.27, 18.21, 20.42, 633),
    ("AT0000A0E9W5", "SANT", "2021-04-17", "14:00", 18.27, 21.19, 18.27, 21.34, 455),
    ("AT0000A0E9W5", "SANT", "2021-04-18", "07:00", 20.58, 19.21, 18.89, 20.58, 9066),
    ("AT0000A0E9W5", "SANT", "2021-04-18", "08:00", 19.27, 21.14, 19.27, 21.14, 1220),
    ("AT0000A0E9W5", "SANT", "2021-04-19", "07:00", 23.58, 23.58, 23.58, 23.58, 1035),
    ("AT0000A0E9W5", "SANT", "2021-04-19", "08:00", 23.58, 24.22, 23.31, 24.34, 1028),
    ("AT0000A0E9W5", "SANT", "2021-04-19", "09:00", 24.22, 22.21, 22.21, 25.01, 1523),
]

REPORT = [
    ("AT0000A0E9W5", dt.date(2021, 4, 17), 20.21, 18.27, 18.21, 21.34, 1088, 10.62),
    ("AT0000A0E9W5", dt.date(2021, 4, 18), 20.58, 19.27, 18.89, 21.14, 10286, 1.83),
    ("AT0000A0E9W5", dt.date(2021, 4, 19), 23.58, 24.22, 22.21, 25.01, 3586, 14.58),
]


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def fmt(v):
    return "" if v is None else str(v)


def write_csv(path, header, rows, sep=","):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(sep.join(header) + "\n")
        for r in rows:
            fh.write(sep.join(fmt(v) for v in r) + "\n")


def write_golden_files(root, rows=TICKS, header=SOURCE_COLUMNS):
    """One file per tick: <root>/<date>/<date>_<hh>.csv"""
    for r in rows:
        date, hour = r[2], r[3][:2]
        write_csv(f"{root}/{date}/{date}_{hour}.csv", header, [r])


def ticks_df(spark, rows=TICKS):
    from pyspark.sql import functions as F
    schema = ("ISIN string, Mnemonic string, Date string, Time string, StartPrice double, "
              "EndPrice double, MinPrice double, MaxPrice double, TradedVolume long")
    return spark.createDataFrame(rows, schema).withColumn("Date", F.to_date("Date"))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def explain_text(df, mode="simple"):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
