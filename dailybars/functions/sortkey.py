"""Order-preserving numbers for values, to order by several columns at once.

``min_by`` and ``max_by`` over a struct plan as SortAggregate; over one number
they plan as HashAggregate with a map-side partial aggregate. Columns of fixed
width (boolean, integers, dates, timestamps, short decimals, floats) map to the
numbers 1 .. ``size`` - 1 in their order, NULL to 0 as it sorts first, and
several columns make the digits of one decimal(38). What does not fit (texts,
more than 64 bits of columns behind the time) is left to a struct.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Doubles by exponent (-1074 .. 1023, subnormal ones included) and 52 bits of
# mantissa, for both signs, and zero, infinities and NaN.
_EXPONENTS = 1023 + 1074 + 1
_MANTISSAS = 1 << 52
_HALF = _EXPONENTS * _MANTISSAS + 1       # positive finite doubles and infinity
_MOST = 10 ** 38 - 1
_LONG = 1 << 63


def _number(value: int) -> Column:
    return F.lit(Decimal(value))


def _whole(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def _double_number(c: Column) -> Column:
    """1 for minus infinity up to 2 * _HALF + 2 for NaN."""
    size = F.abs(c)
    rough = F.floor(F.log2(size)).cast("int")
    # The logarithm is rounded: the exponent may be off by one at its borders.
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    low = F.greatest(rough - 1, F.lit(-1074))
    exponent = F.when(size < power(F.greatest(rough, F.lit(-1074))), low).when(
        (rough < 1023) & (size >= power(F.least(rough + 1, F.lit(1023)))), rough + 1).otherwise(rough)
    mantissa = ((size / power(exponent) - 1) * float(_MANTISSAS)).cast("long")
    finite = _whole(exponent + 1074) * _number(_MANTISSAS) + _whole(mantissa) + 1
    place = (F.when(c == 0, _number(0))
             .when(size == float("inf"), _number(_HALF)).otherwise(finite))
    signed = _number(_HALF + 1) + F.when(c < 0, -place).otherwise(place)
    return F.when(F.isnan(c), _number(2 * _HALF + 2)).otherwise(signed)


def sort_number(c: Column, kind: T.DataType) -> tuple[Column, int] | None:
    """(number from 0, how many there are) in the order of a column's values,
    NULL first; None for a type without a fixed width."""
    if isinstance(kind, T.BooleanType):
        value, least, size = c.cast("int"), 0, 2
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(kind)]
        value, least, size = c, -(1 << bits - 1), 1 << bits
    elif isinstance(kind, T.DateType):
        value, least, size = F.unix_date(c), -(1 << 31), 1 << 32
    elif isinstance(kind, T.TimestampType):
        value, least, size = F.unix_micros(c), -_LONG, 1 << 64
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        # As an integer of its smallest unit.
        value = (c * _number(10 ** kind.scale)).cast("decimal(20,0)")
        least, size = -(10 ** kind.precision), 2 * 10 ** kind.precision + 1
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(_double_number(c.cast("double")), _number(0)), 2 * _HALF + 3
    else:
        return None
    return F.coalesce(_whole(value) + _number(1 - least), _number(0)), size + 1


def packed_order(first: Column, others: Sequence[tuple[Column, T.DataType]]) -> Column | None:
    """One decimal that orders as (first, others...), or None if it would not
    fit; ``first`` is a long that is never NULL."""
    numbers = [sort_number(c, kind) for c, kind in others]
    if any(n is None for n in numbers):
        return None
    key, room = _whole(first) - _number(_LONG >> 1), _LONG >> 1
    for value, size in numbers:
        key, room = key * _number(size) + value, room * size + size
    # A first value may lie below zero by less than the range has to spare.
    return key.cast("decimal(38,0)") if room <= _MOST else None
