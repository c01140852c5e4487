"""Globally ordered output without collecting it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def range_cluster(df: DataFrame, lead: str, num_partitions: int | None = None) -> DataFrame:
    """Range-partition by the leading key. A following window partitioned by
    ``lead`` reuses this exchange, and its sort within partitions then makes
    the output globally ordered."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, lead)
    return df.repartitionByRange(lead)


def sort_globally(df: DataFrame, keys: Sequence[str],
                  num_partitions: int | None = None) -> DataFrame:
    """Range partitions on the first key, sorted within partitions by all
    keys: part files come out in key order, one exchange, no driver work.

    Rows with the same leading key always land in one partition, so the order
    is total. Use it on aggregated data (one row per key and day), not on raw
    ticks."""
    return range_cluster(df, keys[0], num_partitions).sortWithinPartitions(*keys)
