"""Report and table writers."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import OUTPUT_FORMATS
from ..errors import WrongFormatError

log = logging.getLogger(__name__)


def check_format(fmt: str) -> None:
    if fmt not in OUTPUT_FORMATS:
        log.warning("output format %r refused", fmt)
        raise WrongFormatError(f"unsupported output format {fmt!r}; use one of {OUTPUT_FORMATS}")


def report_path(root: str, key: str, run_ts: dt.datetime, fmt: str) -> str:
    """``<root>/<key>_<yyyyMMddTHHmmss>.<fmt>``: a new folder per run. The
    time stamp has no colons, which Hadoop paths cannot glob."""
    return f"{root.rstrip('/')}/{key}_{run_ts:%Y%m%dT%H%M%S}.{fmt}"


def write_table(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists",
                partition_by: Sequence[str] = (), dynamic_overwrite: bool = False,
                arrange: Callable[[DataFrame], DataFrame] | None = None) -> bool:
    """Write ``df`` as ``fmt`` unless it has no rows; return whether it wrote.

    An empty frame writes nothing, whatever the format (Spark alone would
    write an empty part file). The frame is persisted so the emptiness test
    and the write compute it once; a lost cached block is recomputed from its
    lineage. ``arrange`` lays the persisted rows out for the write (outside
    the cache, where adaptive execution can split and join partitions)."""
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if cached.isEmpty():
            log.info("no rows for %s: nothing written", path)
            return False
        check_format(fmt)
        writer = (arrange(cached) if arrange else cached).write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if dynamic_overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        if fmt == "csv":
            writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        else:
            writer.parquet(path)
        log.info("wrote %s as %s", path, fmt)
        return True
    finally:
        cached.unpersist()


def write_report(report: DataFrame, root: str, key: str, fmt: str, run_ts: dt.datetime,
                 date_col: str = "Date", by_date: bool = False,
                 sort_within: Sequence[str] = ()) -> str | None:
    """``per run`` (default): a new folder per run. ``by_date``: one
    ``Date=...`` folder per day under ``<root>/<key>``, rewritten when a run
    covers the day again, so reruns do not duplicate days.

    For ``by_date`` the rows are first rebalanced by date and sorted by
    ``sort_within``: a small day is written by one task into one file, a large
    one is split over several tasks by adaptive execution. Writing straight
    from instrument-partitioned data would make every task write a file for
    every date."""
    if by_date:
        path = f"{root.rstrip('/')}/{key}"
        # Sorting by (date, ...) also satisfies the writer's own required
        # ordering by the partition column, so it adds no second sort.
        written = write_table(
            report, path, fmt, mode="overwrite", partition_by=[date_col], dynamic_overwrite=True,
            arrange=lambda df: df.hint("rebalance", F.col(date_col)).sortWithinPartitions(
                date_col, *sort_within))
    else:
        path = report_path(root, key, run_ts, fmt)
        written = write_table(report, path, fmt)
    return path if written else None
