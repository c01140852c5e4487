"""DataFrame operators of the report: aggregates, windows, set operations."""

from .aggregate import (
    TIME_KEY, closing_price, daily_high, daily_low, daily_ohlcv, daily_volume,
    first_date, opening_price, prepare_ticks,
)
from .ordering import range_cluster, sort_globally
from .project import from_date, project
from .setops import missing_dates, union_by_name
from .window import add_change, ticks_with_open_close

__all__ = [
    "TIME_KEY", "closing_price", "daily_high", "daily_low", "daily_ohlcv",
    "daily_volume", "first_date", "opening_price", "prepare_ticks",
    "range_cluster", "sort_globally", "from_date", "project",
    "missing_dates", "union_by_name", "add_change",
    "ticks_with_open_close",
]
