"""The daily report: ticks in, one rounded row per instrument and day out.

Physical plan (see ``explain``)::

    scan -> partial HashAggregate(ISIN, Date) -> Exchange hash(ISIN, Date)
         -> final HashAggregate -> Exchange range(ISIN) -> Sort -> Window(lag)
         -> Project(round) -> Filter(Date >= extract date)

Two exchanges: the first carries partial aggregates (at most one row per key
per map task), the second one row per instrument-day. The range exchange
serves both the window (clustered by ISIN) and a globally ordered output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ReportColumns, SourceColumns
from ..functions import round_half_even
from ..operators import daily_ohlcv, from_date, range_cluster
from ..operators.window import change_expr, with_previous


def report_schema(trg: ReportColumns = ReportColumns()) -> T.StructType:
    double = T.DoubleType()
    return T.StructType([
        T.StructField(trg.isin, T.StringType()), T.StructField(trg.date, T.DateType()),
        T.StructField(trg.opening, double), T.StructField(trg.closing, double),
        T.StructField(trg.minimum, double), T.StructField(trg.maximum, double),
        T.StructField(trg.volume, T.LongType()), T.StructField(trg.change, double)])


def round_floats(df: DataFrame, columns: Sequence[str], decimals: int = 2) -> DataFrame:
    return df.withColumns({c: round_half_even(F.col(f"`{c}`"), decimals) for c in columns})


def daily_report(ticks: DataFrame, extract_date: dt.date | None = None,
                 basis: str = "opening", src: SourceColumns = SourceColumns(),
                 trg: ReportColumns = ReportColumns(), ordered: bool = True,
                 tie_break: Sequence[str] = (), order_by_text: bool = False,
                 num_partitions: int | None = None,
                 look_back_days: int | None = 1) -> DataFrame:
    """Build the report from ticks.

    ``extract_date``: first date to report. Only ticks from ``look_back_days``
    before it on are read (None: all); those days feed the change of the first
    reported day. ``basis``: "opening" compares opening prices
    (the default report), "closing" closing prices. ``ordered``: output
    globally sorted by (ISIN, Date) through a range exchange; without it the
    window uses a hash exchange and the output order is undefined.
    """
    if extract_date is not None and look_back_days is not None:
        ticks = from_date(ticks, src.date, extract_date - dt.timedelta(days=look_back_days))
    day = daily_ohlcv(ticks, src, trg, tie_break, order_by_text)
    if ordered:
        day = range_cluster(day, trg.isin, num_partitions)
    prev = with_previous(day, trg, basis)
    # Change, rounding and column order in one projection.
    columns = {c: F.col(f"`{c}`") for c in trg.ordered}
    columns[trg.change] = change_expr(trg, basis)
    report = prev.select(*[round_half_even(e).alias(c) if c in trg.floats else e.alias(c)
                           for c, e in columns.items()])
    if extract_date is not None:
        report = from_date(report, trg.date, extract_date)
    return report
