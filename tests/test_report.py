"""Transform: golden report, change bases, NULL / tie / zero / rounding rules."""

import datetime as dt
import math

from pyspark.sql import functions as F

from conftest import REPORT, TICKS, explain_text, rows_of, ticks_df
from dailybars.config import ReportColumns
from dailybars.functions import pct_change, round_half_even
from dailybars.operators import (add_change, closing_price, daily_high, daily_low,
                                 daily_ohlcv, daily_volume, opening_price,
                                 ticks_with_open_close)
from dailybars.plans.report import daily_report

R = ReportColumns()


def test_golden_report(spark):
    # Input is the extract of 04-16 .. 04-19; report from 04-17.
    df = daily_report(ticks_df(spark, TICKS[1:]), dt.date(2021, 4, 17))
    assert df.columns == list(R.ordered)
    assert rows_of(df) == REPORT
    types = dict(df.dtypes)
    assert types["Date"] == "date" and types["DailyTradedVolume"] == "bigint"


def test_closing_basis(spark):
    df = daily_report(ticks_df(spark, TICKS[1:]), dt.date(2021, 4, 17), basis="closing")
    assert [r[R.change] for r in df.collect()] == [0.0, 5.47, 25.69]


def test_first_day_of_instrument_has_no_change(spark):
    df = daily_report(ticks_df(spark, TICKS[1:]))
    first = df.where(F.col("Date") == dt.date(2021, 4, 16)).first()
    assert first[R.change] is None


def test_empty_input_gives_empty_report(spark):
    df = daily_report(ticks_df(spark, []), dt.date(2021, 4, 17))
    assert df.count() == 0 and df.columns == list(R.ordered)


def test_previous_row_not_previous_calendar_day(spark):
    # 04-16 is followed by 04-19 in the data: the change uses 04-16.
    rows = [t for t in TICKS if t[2] in ("2021-04-16", "2021-04-19")]
    out = {r["Date"]: r[R.change] for r in daily_report(ticks_df(spark, rows)).collect()}
    assert out[dt.date(2021, 4, 19)] == round((23.58 - 18.27) / 18.27 * 100, 2)


def test_null_rules(spark):
    rows = [
        ("X1", "M", "2021-04-15", "09:00", None, 1.0, None, None, None),  # NULL price first
        ("X1", "M", "2021-04-15", "10:00", 5.0, 1.0, 4.0, 6.0, None),
        ("X1", "M", "2021-04-15", None, 9.0, 1.0, 3.0, 9.5, None),       # NULL time sorts last
        ("X1", "M", "2021-04-15", "11:00", 7.0, 1.0, 2.0, 8.0, None),
        (None, "M", "2021-04-15", "10:00", 1.0, 1.0, 1.0, 1.0, 5),       # NULL key dropped
        ("X1", "M", None, "10:00", 1.0, 1.0, 1.0, 1.0, 5),
    ]
    out = rows_of(daily_ohlcv(ticks_df(spark, rows)))
    assert out == [("X1", dt.date(2021, 4, 15), 5.0, 9.0, 2.0, 9.5, 0)]


def test_zero_previous_price(spark):
    rows = [
        ("Z", "M", "2021-04-15", "09:00", 0.0, 0.0, 0.0, 0.0, 1),
        ("Z", "M", "2021-04-16", "09:00", 0.0, 0.0, 0.0, 0.0, 1),
        ("Z", "M", "2021-04-17", "09:00", 2.0, 0.0, 0.0, 0.0, 1),
        ("N", "M", "2021-04-15", "09:00", 0.0, 0.0, 0.0, 0.0, 1),
        ("N", "M", "2021-04-16", "09:00", -1.0, 0.0, 0.0, 0.0, 1),
    ]
    out = {(r["ISIN"], r["Date"].day): r[R.change] for r in daily_report(ticks_df(spark, rows)).collect()}
    assert out[("Z", 15)] is None
    assert out[("Z", 16)] is None          # 0 / 0
    assert out[("Z", 17)] == math.inf      # 2 against a previous 0
    assert out[("N", 16)] == -math.inf


def test_zero_previous_positive_current(spark):
    rows = [("Z", "M", "2021-04-16", "09:00", 0.0, 0.0, 0.0, 0.0, 1),
            ("Z", "M", "2021-04-17", "09:00", 2.0, 0.0, 0.0, 0.0, 1)]
    out = [r[R.change] for r in daily_report(ticks_df(spark, rows)).collect()]
    assert out == [None, math.inf]


def test_round_half_even_matches_rint(spark):
    values = [0.125, 0.135, 2.675, 1.005, -0.125, 10.62499999, 1e-9, 123456.785]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_even(F.col("x"))).collect()]
    import numpy as np
    assert got == [float(np.round(v, 2)) for v in values]


def test_pct_change_null_and_zero(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (0.0, 0.0), (3.0, 0.0), (-3.0, 0.0),
                                (3.0, 2.0)], "c double, p double")
    got = [r[0] for r in df.select(pct_change(F.col("c"), F.col("p"))).collect()]
    assert got[:3] == [None, None, None]
    assert got[3] == math.inf and got[4] == -math.inf and got[5] == 50.0


def test_single_aggregates_agree_with_ohlcv(spark):
    ticks = ticks_df(spark)
    full = {(r[0], r[1]): r for r in daily_ohlcv(ticks).collect()}
    for fn, col in [(opening_price, R.opening), (closing_price, R.closing),
                    (daily_low, R.minimum), (daily_high, R.maximum), (daily_volume, R.volume)]:
        for r in fn(ticks).collect():
            assert r[col] == full[(r[0], r[1])][col]


def test_ticks_with_open_close(spark):
    out = ticks_with_open_close(ticks_df(spark)).where(F.col("Date") == dt.date(2021, 4, 19))
    vals = {(r["Time"], r["OpeningPrice"], r["ClosingPrice"]) for r in out.collect()}
    assert vals == {("07:00", 23.58, 24.22), ("08:00", 23.58, 24.22), ("09:00", 23.58, 24.22)}
    assert out.count() == 3


def test_tie_break_is_deterministic(spark):
    rows = [("T", "M", "2021-04-15", "09:00", 2.0, 0.0, 0.0, 0.0, 1),
            ("T", "M", "2021-04-15", "09:00", 1.0, 0.0, 0.0, 0.0, 1)]
    df = ticks_df(spark, rows).repartition(2)
    out = daily_ohlcv(df, tie_break=["StartPrice"]).first()
    assert (out[R.opening], out[R.closing]) == (1.0, 2.0)


def test_report_plan_is_hash_aggregate_and_one_window_exchange(spark):
    plan = explain_text(daily_report(ticks_df(spark), dt.date(2021, 4, 17)))
    assert "SortAggregate" not in plan
    assert plan.count("Exchange") == 2  # hash(ISIN, Date) for the aggregate, range(ISIN)


def test_change_rejects_unknown_basis(spark):
    import pytest
    with pytest.raises(ValueError):
        add_change(daily_ohlcv(ticks_df(spark)), basis="mid")


def test_props_k_fast_path_and_fallback(spark):
    from dailybars.sources.tables import props_k
    rows = [('{"k": 69}',), ('{"k":-3}',), ('{ "k" : 7 }',), ('{"a": {"k": 1}, "k": 2}',),
            ('{"k": "12"}',), ('{"j": 1}',), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "props string").select(props_k()).collect()]
    assert got == [69, -3, 7, 2, 12, None, None]


def test_time_key_orders_any_time_text_like_the_text(spark):
    import pytest
    from dailybars.functions import MISSING_TIME_KEY, time_key
    times = ["09:00", "9:00", "09:00:30", "09:00:30.5", "09:00:30.123456", "09:00:30.12345678", "23:59",
             "00:00", "0900", "0930", "", "17:30", "1730", "09:00:30.12345677", ":", "9", "99999999999999:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    keys = {r["t"]: r["k"] for r in df.select("t", time_key(F.col("t")).alias("k")).collect()}
    assert sorted(times, key=keys.get) == sorted(times)
    assert len(set(keys.values())) == len(times) and max(keys.values()) < MISSING_TIME_KEY
    missing = spark.range(1).select(time_key(F.lit(None).cast("string"))).first()[0]
    assert missing == MISSING_TIME_KEY
    for bad in ("ab:cd", "09:00:xx", "09:00:30.123456789", " 09:00"):
        with pytest.raises(Exception, match="cannot be ordered as a number"):
            spark.createDataFrame([(bad,)], "t string").select(time_key(F.col("t"))).collect()


def test_time_key_orders_like_text_for_fixed_width(spark):
    from dailybars.functions import time_key
    times = ["00:00", "00:01", "07:00", "09:59", "10:00", "12:30", "23:59"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    keys = [r[0] for r in df.select(time_key(F.col("t"))).collect()]
    assert keys == sorted(keys)


def test_ordered_report_is_globally_sorted_over_many_partitions(spark):
    from dailybars.sources.tables import event_ticks
    df = daily_report(event_ticks(spark, "/root/testdata/sf0.001"), ordered=True,
                      num_partitions=4)
    keys = [(r["ISIN"], r["Date"]) for r in df.collect()]
    assert len(keys) > 100 and keys == sorted(keys)
    assert df.rdd.getNumPartitions() > 1


def test_sort_globally(spark):
    from dailybars.operators import sort_globally
    from dailybars.sources.tables import event_ticks
    day = daily_ohlcv(event_ticks(spark, "/root/testdata/sf0.001"))
    keys = [(r["ISIN"], r["Date"]) for r in sort_globally(day, ["ISIN", "Date"], 4).collect()]
    assert keys == sorted(keys)


def test_time_key_timestamps(spark):
    import datetime as dt
    from dailybars.functions import MISSING_TIME_KEY, time_key
    rows = [(dt.datetime(2024, 1, 1, 9, 0, 0, 5),), (dt.datetime(2024, 1, 1, 23, 59),),
            (dt.datetime(2024, 1, 1, 0, 0),), (None,)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"t {kind}")
        keys = [r[0] for r in df.select(time_key(F.col("t"), df.schema["t"].dataType)).collect()]
        assert keys[2] < keys[0] < keys[1] < keys[3] == MISSING_TIME_KEY, kind
        assert keys[0] - keys[2] == 9 * 3600 * 1_000_000 + 5, kind
