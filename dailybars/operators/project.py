"""Projection and date filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the configured columns in the configured order; a missing column
    raises (Spark's analysis error names it)."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def from_date(df: DataFrame, column: str, first: dt.date) -> DataFrame:
    """Rows with ``column >= first``. Apply it *after* the change window: the
    day before ``first`` is read only to feed the change of ``first``."""
    return df.where(F.col(column) >= F.lit(first))

