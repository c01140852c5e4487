"""Union by name and the calendar-minus-ledger difference."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its row count is known to be at most this.
BROADCAST_MAX_ROWS = 1_000_000


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union all, aligned by column name; a column missing in one input is
    NULL there. Duplicates are kept."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def missing_dates(calendar: DataFrame, recorded: DataFrame, column: str = "day",
                  recorded_bound: int | None = None) -> DataFrame:
    """Calendar dates that are not in ``recorded`` (a set difference).

    ``recorded`` is de-duplicated first. Pass ``recorded_bound`` when its row
    count is known not to exceed it (for example after restricting it to the
    calendar's range); then it is broadcast, otherwise Spark chooses the join
    from the sizes it sees at run time."""
    right = recorded.select(F.col(column)).distinct()
    if recorded_bound is not None and recorded_bound <= BROADCAST_MAX_ROWS:
        right = F.broadcast(right)
    return calendar.join(right, on=column, how="left_anti")
