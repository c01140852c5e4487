"""Integer ordering key for the time of a tick within its day.

``min_by``/``max_by`` with a string key plan as SortAggregate; with a long key
they plan as HashAggregate with a map-side partial aggregate. A text time
("HH:MM", "0930", "HH:MM:SS.ffffff", ...) is packed into a long that orders
exactly like the text: its characters become digits of base 13, the shorter
text first. That holds up to 17 characters (eight digits of a second's
fraction). A longer text, or one with other characters, fails the job with the
value named; ``order_by_text`` orders by the text itself and takes any text.
Timestamps become microseconds since the epoch, which orders the same way
within a day and needs no field extraction.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

# A missing time sorts after every real time (ordering keys are NULL-skipped
# by min_by/max_by, so it needs a value): the largest long.
MISSING_TIME_KEY = 2 ** 63 - 1

# The characters of a time in text order, and their digits in base 13 (0 is
# the end of the text). 13 ** 17 < 2 ** 63.
_CHARACTERS = ".0123456789:"
_DIGITS = "123456789ABC"
_WIDTH = 17

_EPOCH = dt.datetime(1970, 1, 1)


def _text_key(text: Column) -> Column:
    packed = F.conv(F.rpad(F.translate(text, _CHARACTERS, _DIGITS), _WIDTH, "0"), 13, 10)
    fits = (F.length(text) <= _WIDTH) & (F.translate(text, _CHARACTERS, "") == "")
    error = F.raise_error(F.concat(
        F.lit("tick time cannot be ordered as a number, use order_by_text: "), text))
    return F.when(fits, packed.cast("long")).when(text.isNotNull(), error)


def time_key(c: Column, data_type: DataType = StringType()) -> Column:
    """Long ordering key of a tick's time; MISSING_TIME_KEY for NULL.
    Timestamp: microseconds since the epoch (``unix_micros``, or for a
    zone-less timestamp the microsecond difference to the epoch, which
    involves no time zone). Text: packed in text order."""
    if isinstance(data_type, TimestampType):
        key = F.unix_micros(c)
    elif isinstance(data_type, TimestampNTZType):
        key = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), c)
    else:
        key = _text_key(c.cast("string"))
    return F.coalesce(key, F.lit(MISSING_TIME_KEY))


def text_order_key(c: Column) -> Column:
    """Ordering key for any text: missing last, then the text itself."""
    return F.struct(c.isNull(), c.cast("string"))
