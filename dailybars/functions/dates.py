"""Date parsing, formatting and calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DATE_FORMAT


def parse_date(c: Column, fmt: str = DATE_FORMAT, strict: bool = True) -> Column:
    """Text to DateType. ``strict`` fails the job on a malformed value, naming
    it, whatever the session's ANSI setting; otherwise it becomes NULL."""
    parsed = F.try_to_date(c, fmt)
    if not strict:
        return parsed
    error = F.raise_error(F.concat(F.lit("malformed date: "), c))
    return F.coalesce(parsed, F.when(c.isNotNull(), error))


def format_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    return F.date_format(c, fmt)


def date_series(spark: SparkSession, start: dt.date, end: dt.date,
                name: str = "day") -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive, ascending; no rows if
    ``start > end``. Built from ``spark.range`` so it is split into tasks."""
    n = max(0, (end - start).days + 1)
    return spark.range(0, n).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))

