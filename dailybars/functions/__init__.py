"""Column functions: rounding, percent change, dates, time and sort keys."""

from .dates import date_series, format_date, parse_date
from .numeric import nan_to_null, pct_change, round_half_even
from .sortkey import packed_order, sort_number
from .timekey import MISSING_TIME_KEY, text_order_key, time_key

__all__ = [
    "date_series", "format_date", "parse_date",
    "nan_to_null", "pct_change", "round_half_even", "MISSING_TIME_KEY",
    "packed_order", "sort_number", "text_order_key", "time_key",
]
