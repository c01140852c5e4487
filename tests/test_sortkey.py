"""Numbers that order like the values they stand for."""

import datetime as dt
import struct
from decimal import Decimal
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import explain_text
from dailybars.functions import packed_order, sort_number
from dailybars.operators import daily_ohlcv

RNG = np.random.default_rng(11)


def doubles():
    bits = RNG.integers(0, 1 << 64, 3000, dtype=np.uint64)
    values = [struct.unpack("<d", int(b).to_bytes(8, "little"))[0] for b in bits]
    for e in range(-1074, 1024, 7):
        x = float(2.0) ** e
        values += [x, -x, np.nextafter(x, 0), np.nextafter(x, np.inf), -np.nextafter(x, np.inf)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308,
               float("inf"), float("-inf"), float("nan"), 0.1, 0.3, 1.0, 20.19, 2.2250738585072014e-308]
    return [float(v) for v in values] + [None]


def check(spark, kind, values, order):
    """The numbers, sorted, are strictly ascending over the distinct values."""
    frame = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", kind)]))
    number, size = sort_number(F.col("v"), kind)
    rows = sorted(((order(r.v), int(r.n)) for r in frame.select("v", number.alias("n")).collect()))
    for (a, x), (b, y) in pairwise(rows):
        assert (x == y) if a == b else (x < y), (a, b, x, y)
    assert all(0 <= n < size for _, n in rows)


def test_doubles_and_floats(spark):
    def order(v):
        return (-1, 0.0) if v is None else (1, 0.0) if v != v else (0, v + 0.0)
    check(spark, T.DoubleType(), doubles(), order)
    check(spark, T.FloatType(), [None if v is None else float(np.float32(v)) for v in doubles()
                                 if v is None or v != v or abs(v) < 3e38], order)


@pytest.mark.parametrize("kind, values", [
    (T.LongType(), [-2**63, 2**63 - 1, 0, -1, 1, None]), (T.IntegerType(), [-2**31, 2**31 - 1, 0, None]),
    (T.ShortType(), [-2**15, 2**15 - 1, 0, None]), (T.ByteType(), [-128, 127, 0, None]),
    (T.BooleanType(), [True, False, None]),
    (T.DateType(), [dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(1970, 1, 1), None]),
    (T.TimestampType(), [dt.datetime(1900, 1, 1), dt.datetime(2024, 1, 1, 9, 0, 0, 1), None]),
    (T.DecimalType(18, 4), [Decimal("-99999999999999.9999"), Decimal("99999999999999.9999"),
                            Decimal("0.0001"), None])])
def test_other_types(spark, kind, values):
    check(spark, kind, values, lambda v: (v is not None, v if v is not None else 0))


def test_several_columns_are_digits_of_one_number(spark):
    rows = [(t, int(a), None if b == 3 else int(b)) for t, a, b in
            zip([0, 1, 2**63 - 1] * 40, RNG.integers(-3, 3, 120), RNG.integers(0, 5, 120))]
    frame = spark.createDataFrame(rows, "t long, a int, b short")
    key = packed_order(F.col("t"), [(F.col("a"), T.IntegerType()), (F.col("b"), T.ShortType())])
    found = [(int(r.k), (r.t, r.a, -1 if r.b is None else r.b))
             for r in frame.select("*", key.alias("k")).collect()]
    for (x, a), (y, b) in pairwise(sorted(found)):
        assert (a == b) if x == y else (a < b)


def test_what_does_not_fit_is_left_to_a_struct():
    wide = [(F.col("a"), T.LongType()), (F.col("b"), T.ByteType())]
    assert packed_order(F.col("t"), wide) is None
    assert packed_order(F.col("t"), [(F.col("a"), T.StringType())]) is None
    assert packed_order(F.col("t"), [(F.col("a"), T.DecimalType(30, 2))]) is None


DAY = dt.date(2022, 3, 18)


@pytest.mark.parametrize("tie, plan", [(["EndPrice"], "HashAggregate"), (["seq"], "HashAggregate"),
                                       (["day", "flag"], "HashAggregate"), (["name"], "SortAggregate")])
def test_ties_of_one_time(spark, tie, plan):
    rows = [("X", DAY, "09:00", float(k), float((7 * k) % 20) - 9.5, 0.0, 0.0, 1, (7 * k) % 20 - 10,
             DAY + dt.timedelta(days=(7 * k) % 20 // 2), bool((7 * k) % 2), f"n{(7 * k) % 20:02}")
            for k in range(20)]
    ticks = spark.createDataFrame(
        rows, "ISIN string, Date date, Time string, StartPrice double, EndPrice double, "
              "MinPrice double, MaxPrice double, TradedVolume long, seq long, day date, flag boolean, "
              "name string").repartition(3)
    out = daily_ohlcv(ticks, tie_break=tie)
    assert plan in explain_text(out)
    r = out.first()
    order = sorted(range(20), key=lambda k: (7 * k) % 20)
    assert (r["OpeningPriceEur"], r["ClosingPriceEur"]) == (order[0], order[-1])
