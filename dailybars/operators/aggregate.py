"""Per instrument and day aggregates: open, close, low, high, volume.

One ``groupBy(ISIN, Date)`` computes all of them. Open and close are
``min_by``/``max_by`` over a number (the integer time key, or with tie-break
columns of fixed width one decimal of time and columns), which keeps the plan a
HashAggregate with a partial (map-side) aggregate: every map task ships at
most one row per (ISIN, Date) into the shuffle, so a hot instrument-day does
not concentrate raw ticks in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ReportColumns, SourceColumns
from ..functions import nan_to_null, packed_order, text_order_key, time_key

TIME_KEY = "_time_key"


def prepare_ticks(ticks: DataFrame, src: SourceColumns = SourceColumns(),
                  order_by_text: bool = False, tie_break: Sequence[str] = ()) -> DataFrame:
    """Drop rows without a group key (grouping ignores them) and add the key
    that orders ticks within a day: the integer time key, packed with the
    tie-break columns into one number where those have a fixed width. With
    ``order_by_text`` (the time's text, which takes any text) or a tie break by
    text it is a struct, which plans as SortAggregate. NaN prices are missing,
    whatever the source, also as tie break."""
    rows = _priced(ticks, src)
    ties = [(F.col(c), rows.schema[c].dataType) for c in tie_break]
    if order_by_text:
        key = text_order_key(F.col(src.time))
    else:
        key = time_key(F.col(src.time), ticks.schema[src.time].dataType)
        packed = packed_order(key, ties) if ties else None
        if packed is not None:
            key, ties = packed, []
    if ties:
        key = F.struct(key, *[c for c, _ in ties])
    return rows.withColumn(TIME_KEY, key)


def _priced(ticks: DataFrame, src: SourceColumns) -> DataFrame:
    floats = [f.name for f in ticks.schema if f.name in src.prices
              and f.dataType.typeName() in ("float", "double")]
    return ticks.na.drop(subset=[src.isin, src.date]).withColumns(
        {c: nan_to_null(F.col(c)) for c in floats})


def opening_price_expr(price: str) -> Column:
    """First non-missing price of the day by time."""
    p = F.col(price)
    return F.min_by(p, F.when(p.isNotNull(), F.col(TIME_KEY)))


def closing_price_expr(price: str) -> Column:
    """Last non-missing price of the day by time."""
    p = F.col(price)
    return F.max_by(p, F.when(p.isNotNull(), F.col(TIME_KEY)))


def volume_expr(volume: str) -> Column:
    """Sum of volume; a day with only missing volumes sums to 0."""
    return F.coalesce(F.sum(F.col(volume)), F.lit(0)).cast("long")


def _group(ticks: DataFrame, src: SourceColumns, trg: ReportColumns, ordered: bool = True,
           order_by_text: bool = False, tie_break: Sequence[str] = ()):
    """Group by (ISIN, Date) under report names; ``ordered`` adds the time
    key that open and close need."""
    rows = (prepare_ticks(ticks, src, order_by_text, tie_break) if ordered
            else _priced(ticks, src))
    return rows.groupBy(F.col(src.isin).alias(trg.isin), F.col(src.date).alias(trg.date))


def daily_ohlcv(ticks: DataFrame, src: SourceColumns = SourceColumns(),
                trg: ReportColumns = ReportColumns(),
                tie_break: Sequence[str] = (), order_by_text: bool = False) -> DataFrame:
    """One row per (ISIN, Date): opening, closing, low, high, volume.

    Opening and closing are both taken from the *start* price of the first
    and last tick, which is what the published reports contain."""
    return _group(ticks, src, trg, order_by_text=order_by_text, tie_break=tie_break).agg(
        opening_price_expr(src.start_price).alias(trg.opening),
        closing_price_expr(src.start_price).alias(trg.closing),
        F.min(src.min_price).alias(trg.minimum),
        F.max(src.max_price).alias(trg.maximum),
        volume_expr(src.traded_volume).alias(trg.volume),
    )


def opening_price(ticks: DataFrame, src: SourceColumns = SourceColumns(),
                  trg: ReportColumns = ReportColumns(), tie_break: Sequence[str] = (),
                  order_by_text: bool = False) -> DataFrame:
    return _group(ticks, src, trg, order_by_text=order_by_text, tie_break=tie_break).agg(
        opening_price_expr(src.start_price).alias(trg.opening))


def closing_price(ticks: DataFrame, src: SourceColumns = SourceColumns(),
                  trg: ReportColumns = ReportColumns(), tie_break: Sequence[str] = (),
                  order_by_text: bool = False) -> DataFrame:
    return _group(ticks, src, trg, order_by_text=order_by_text, tie_break=tie_break).agg(
        closing_price_expr(src.start_price).alias(trg.closing))


def daily_low(ticks: DataFrame, src: SourceColumns = SourceColumns(),
              trg: ReportColumns = ReportColumns()) -> DataFrame:
    return _group(ticks, src, trg, False).agg(F.min(src.min_price).alias(trg.minimum))


def daily_high(ticks: DataFrame, src: SourceColumns = SourceColumns(),
               trg: ReportColumns = ReportColumns()) -> DataFrame:
    return _group(ticks, src, trg, False).agg(F.max(src.max_price).alias(trg.maximum))


def daily_volume(ticks: DataFrame, src: SourceColumns = SourceColumns(),
                 trg: ReportColumns = ReportColumns()) -> DataFrame:
    return _group(ticks, src, trg, False).agg(
        volume_expr(src.traded_volume).alias(trg.volume))


def first_date(dates: DataFrame, column: str, alias: str = "first_date") -> DataFrame:
    """Scalar minimum of a date column (one row; NULL when there are none)."""
    return dates.agg(F.min(column).alias(alias))
