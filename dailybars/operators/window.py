"""Change against the previous trading day, and per-day values on ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ReportColumns, SourceColumns
from ..functions import pct_change
from ..session import scratch_dir
from .aggregate import closing_price_expr, opening_price_expr, prepare_ticks

BASES = ("opening", "closing")
PREVIOUS = "_previous"
_N = "_n"
_HOT = "_hot"
_HOT_OPEN = "_hot_open"
_HOT_CLOSE = "_hot_close"
_KEY = "_join_key"
# Bytes of a day row besides its instrument's text: the row's fixed part (date,
# two prices, length of the text, null bits) and its slot in a hash table.
_ROW_BYTES = 96


def _base(trg: ReportColumns, basis: str) -> str:
    if basis not in BASES:
        raise ValueError(f"basis must be one of {BASES}, got {basis!r}")
    return trg.opening if basis == "opening" else trg.closing


def with_previous(day: DataFrame, trg: ReportColumns = ReportColumns(),
                  basis: str = "opening") -> DataFrame:
    """``day`` plus the previous row's opening (or closing) price of the same
    instrument ordered by date, in column ``_previous``.

    The window holds one row per trading day of an instrument, so its size is
    bounded by the calendar, not by the tick volume."""
    base = _base(trg, basis)
    by_instrument = Window.partitionBy(trg.isin).orderBy(trg.date)
    # Materialised once: the change expression reads it three times.
    return day.withColumn(PREVIOUS, F.lag(F.col(base), 1).over(by_instrument))


def change_expr(trg: ReportColumns = ReportColumns(), basis: str = "opening") -> Column:
    """The change column over a frame from ``with_previous``."""
    return pct_change(F.col(_base(trg, basis)), F.col(PREVIOUS))


def add_change(day: DataFrame, trg: ReportColumns = ReportColumns(),
               basis: str = "opening") -> DataFrame:
    """Percent change of the opening (or closing) price against the previous
    row of the same instrument ordered by date: the previous day *with data*,
    not the previous calendar day. The first row of an instrument gets NULL."""
    prev = with_previous(day, trg, basis)
    return prev.select(*[F.col(f"`{c}`") for c in day.columns],
                       change_expr(trg, basis).alias(trg.change))


def _day_table(ticks: DataFrame, src: SourceColumns, opening: str, closing: str,
               tie_break: Sequence[str], order_by_text: bool) -> tuple[DataFrame, int]:
    """(open, close and tick count per key, bytes of its rows), written to the
    shared folder. The bytes are counted from the values, not estimated."""
    spark = ticks.sparkSession
    path = scratch_dir(spark, "day-prices")
    (prepare_ticks(ticks, src, order_by_text, tie_break)
     .groupBy(src.isin, src.date)
     .agg(opening_price_expr(src.start_price).alias(opening),
          closing_price_expr(src.start_price).alias(closing),
          F.count(F.lit(1)).alias(_N))
     .write.parquet(path))
    day = spark.read.parquet(path)
    key_bytes = F.octet_length(F.col(src.isin).cast("string"))
    size = day.agg(F.sum(key_bytes + F.lit(_ROW_BYTES)).alias("size")).first().size
    return day, int(size or 0)


def ticks_with_open_close(ticks: DataFrame, src: SourceColumns = SourceColumns(),
                          opening: str = "OpeningPrice", closing: str = "ClosingPrice",
                          hot_rows: int = 1_000_000, max_hot_keys: int = 100_000,
                          buckets: int | None = None, tie_break: Sequence[str] = (),
                          order_by_text: bool = False,
                          broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Every tick with its day's opening and closing price attached.

    Not a window over (ISIN, Date), which would put every tick of a hot
    instrument-day into one task. Instead one aggregate per (ISIN, Date)
    (partial before its shuffle) gives open, close and the tick count. This day
    table is written to the shared folder, so the ticks are read twice in all:
    the few columns of the aggregate, and then every column for the output.

    A day table of at most ``broadcast_bytes`` (counted over its rows) is
    broadcast: no tick is shuffled or sorted, and no key can be hot. A larger
    one is joined in two parts:

    1. keys with more than ``hot_rows`` ticks are hot, but no more than the
       ``max_hot_keys`` largest of them, so their day rows are a broadcast of
       proven size and are attached to the ticks map-side;
    2. the remaining (cold) keys are attached by a shuffle join on (join key,
       Date) of two plain shuffles, whose partitions adaptive execution can
       split if more keys than ``max_hot_keys`` are hot. The join key of a cold
       tick is its ISIN; a hot tick's is its ISIN, a NUL character and a
       bucket number from a hash of the whole tick, which matches no day row,
       so hot ticks are distributed over the shuffle instead of landing in one
       task. (A constant bucket column on the day side would be folded into
       a post-join filter by the optimizer, leaving the shuffle on the hot key.)

    ``buckets`` defaults to 8 x ``spark.sql.shuffle.partitions``: bucket
    numbers reach partitions through a hash, and many more buckets than
    partitions keep the hot rows close to evenly spread.
    """
    keys = [src.isin, src.date]
    day, size = _day_table(ticks, src, opening, closing, tie_break, order_by_text)
    columns = [F.col(f"`{c}`") for c in ticks.columns]
    if size <= broadcast_bytes:
        small = F.broadcast(day.select(*keys, opening, closing))
        return ticks.join(small, on=keys, how="left").select(*columns, opening, closing)
    spark = ticks.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # At most max_hot_keys rows: a broadcast of proven size.
    hot = F.broadcast(day.where(F.col(_N) > hot_rows).orderBy(F.desc(_N), *keys)
                      .limit(max_hot_keys).select(
        *keys, F.col(opening).alias(_HOT_OPEN), F.col(closing).alias(_HOT_CLOSE),
        F.lit(True).alias(_HOT)))
    # A hot tick's join key matches no day row, so the cold side is the whole table.
    cold = day.select(F.col(src.isin).alias(_KEY), src.date, opening, closing)
    # From the row's values, not its place: a retried task must deal alike.
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets))
    spread = F.concat(F.coalesce(F.col(src.isin), F.lit("")), F.lit("\u0000"),
                      bucket.cast("string"))
    # Ticks without a key match no day row either; spread them too, since
    # NULL keys would all hash into one partition.
    unmatched = F.col(src.isin).isNull() | F.col(src.date).isNull()
    marked = (ticks.join(hot, on=keys, how="left")
              .withColumn(_KEY, F.when(F.col(_HOT) | unmatched, spread)
                          .otherwise(F.col(src.isin))))
    joined = marked.join(cold, on=[_KEY, src.date], how="left")
    return joined.select(
        *columns,
        F.when(F.col(_HOT), F.col(_HOT_OPEN)).otherwise(F.col(opening)).alias(opening),
        F.when(F.col(_HOT), F.col(_HOT_CLOSE)).otherwise(F.col(closing)).alias(closing))
