"""The processed-dates ledger and incremental run planning.

The ledger is a folder of CSV part files (``source_date``,
``datetime_of_processing``); each run *appends* one part file, so concurrent
runs cannot overwrite each other's rows. Duplicate dates are harmless: the
planner reads the ledger as a set. ``compact_ledger`` puts the part files' rows
into a snapshot (``streaming.snapshots``), so that planning reads a bounded
number of files however many runs there were.

Planning (``plan_dates``): with ``start = first_date - 1``,

* no ledger: report from ``first_date``, read ``start .. end``;
* a ledger with a gap in ``first_date .. end``: report from the earliest
  missing date ``g``, read ``g - 1 .. end`` (one look-back day for the
  change of ``g``);
* no gap: nothing to do (report date 2200-01-01, nothing to read).

The dates to read are always one contiguous range, so the plan is three dates
and the driver never holds a date list it did not compute from them.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DATE_FORMAT, LEDGER_DATE_COL, LEDGER_TIME_COL, NOTHING_TO_DO_DATE
from ..errors import WrongLedgerError
from ..functions import date_series, parse_date
from ..operators import missing_dates, union_by_name
from ..sources.csv_ticks import read_csv_by_name
from ..sources.files import list_files
from ..sources.layouts import Layout, csv_layouts
from . import snapshots

log = logging.getLogger(__name__)

LEDGER_COLUMNS = (LEDGER_DATE_COL, LEDGER_TIME_COL)
LEDGER_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"


@dataclass(frozen=True)
class DatePlan:
    """What one run reads, reports and records."""

    extract_date: dt.date          # first date to report
    start: dt.date                 # first date to read (one look-back day)
    end: dt.date                   # last date to read

    @property
    def dates(self) -> list[dt.date]:
        """Dates to read, ascending (empty when start > end)."""
        n = (self.end - self.start).days + 1
        return [self.start + dt.timedelta(days=i) for i in range(max(0, n))]

    @property
    def record_dates(self) -> list[dt.date]:
        """Dates the run records in the ledger: the read dates from the
        report date on, including dates without files."""
        return [d for d in self.dates if d >= self.extract_date]

    @property
    def is_empty(self) -> bool:
        return self.start > self.end


def nothing_to_do(end: dt.date) -> DatePlan:
    # start > end, so no dates are read or recorded.
    return DatePlan(NOTHING_TO_DO_DATE, NOTHING_TO_DO_DATE, end)


def _layouts(spark: SparkSession, path: str,
             snapshot: snapshots.Snapshot | None = None) -> list[Layout] | None:
    """The layouts of the part files that the snapshot does not cover."""
    return csv_layouts(spark, path, within=snapshot.uncovered() if snapshot else None)


def ledger_columns(spark: SparkSession, path: str) -> list[list[str]] | None:
    """The header of every ledger part file that no snapshot covers (distinct),
    or None when there is none."""
    layouts = _layouts(spark, path, snapshots.newest(spark, path))
    return None if layouts is None else [list(lay.columns) for lay in layouts]


def check_ledger_columns(columns: list[str]) -> None:
    """Fail unless a part file has each ledger column once, in any order, and
    no other; the message says what is missing, extra or doubled."""
    faults = {
        "missing": [c for c in LEDGER_COLUMNS if c not in columns],
        "extra": [c for c in columns if c not in LEDGER_COLUMNS],
        "doubled": sorted({c for c in columns if columns.count(c) > 1}),
    }
    found = "; ".join(f"{kind}: {', '.join(names)}" for kind, names in faults.items() if names)
    if found:
        raise WrongLedgerError(f"ledger columns {columns}: {found}")


def check_ledger(spark: SparkSession, path: str) -> None:
    """Fail unless rows can be appended at ``path``: it is missing, or a folder
    whose part files all have the ledger's columns. A job asks before it
    writes its report."""
    files = list_files(spark, path)
    bare = path.split("://", 1)[-1].split(":", 1)[-1].rstrip("/")
    if not files.where(F.col("path").endswith(bare)).isEmpty():
        raise WrongLedgerError(
            f"the ledger {path} is a single file, to which nothing can be appended; "
            "move it into a folder and name the folder")
    for columns in ledger_columns(spark, path) or []:
        check_ledger_columns(columns)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger rows (as text), or None when there is no ledger yet. Part
    files are aligned by column name, whatever their column order; those that
    the newest snapshot covers are not read."""
    return _ledger_of(spark, path, snapshots.newest(spark, path))


def _ledger_of(spark: SparkSession, path: str,
               snapshot: snapshots.Snapshot | None) -> DataFrame | None:
    layouts = _layouts(spark, path, snapshot)
    for lay in layouts or []:
        if LEDGER_DATE_COL not in lay.columns:
            raise WrongLedgerError(f"ledger at {path} has no {LEDGER_DATE_COL} column")
    if snapshot is None:
        return None if layouts is None else read_csv_by_name(spark, path, {}, layouts=layouts)
    kept = snapshot.rows(spark, LEDGER_COLUMNS)
    if not layouts:
        return kept
    return union_by_name([kept, read_csv_by_name(spark, path, {}, layouts=layouts,
                                                 within=snapshot.uncovered())])


def ledger_parts(spark: SparkSession, path: str) -> int:
    """How many part files a reader of the ledger opens besides the snapshot."""
    snapshot = snapshots.newest(spark, path)
    parts = snapshots.part_files(spark, path)
    return (parts if snapshot is None
            else parts.where(~F.col("path").isin(list(snapshot.covered)))).count()


def compact_ledger(spark: SparkSession, path: str) -> bool:
    """Put all part files into a new snapshot; True if there was anything to do.
    Rows appended meanwhile stay in their own files; equal rows are kept once."""
    before = snapshots.newest(spark, path)
    # The files are listed before their rows are read: one that comes between is
    # read twice at worst, never left out.
    files = [r.path for r in snapshots.part_files(spark, path).collect()]
    if before is not None and set(files) <= set(before.covered):
        return False
    listed = F.col("_metadata.file_path").isin(files)
    if before is not None:
        listed &= before.uncovered()
    layouts = csv_layouts(spark, path, within=listed)
    if layouts is None:
        return False
    for lay in layouts:
        check_ledger_columns(list(lay.columns))
    rows = read_csv_by_name(spark, path, {}, layouts=layouts, within=listed).select(*LEDGER_COLUMNS)
    if before is not None:
        rows = before.rows(spark, LEDGER_COLUMNS).unionByName(rows)
    snapshots.commit(spark, path, rows.distinct(), files)
    removed = snapshots.remove_superseded(spark, path, before)
    log.info("ledger %s: %d part files in a snapshot, %d old files removed", path, len(files), removed)
    return True


def ledger_days(ledger: DataFrame, column: str = LEDGER_DATE_COL) -> DataFrame:
    """The recorded dates as DateType in column ``day``; a malformed date
    fails the job (it would be silently skipped otherwise)."""
    return ledger.select(parse_date(F.col(column)).alias("day"))


def missing_days(spark: SparkSession, ledger: DataFrame, first_date: dt.date,
                 end_date: dt.date) -> DataFrame:
    """Dates in ``first_date .. end_date`` that the ledger does not hold."""
    wanted = date_series(spark, first_date, end_date, "day")
    n = max(0, (end_date - first_date).days + 1)
    recorded = (ledger_days(ledger)
                .where(F.col("day").between(F.lit(first_date), F.lit(end_date))))
    # ``recorded`` is restricted to the calendar range: at most n distinct dates.
    return missing_dates(wanted, recorded, "day", recorded_bound=n)


def plan_frame(spark: SparkSession, ledger: DataFrame | None, first_date: dt.date,
               end_date: dt.date) -> DataFrame:
    """The plan as a frame: one row per date to read (``day``), each with the
    first date to report (``extract_date``). No rows when there is nothing
    to do. The earliest gap enters as a scalar subquery, so nothing is
    collected."""
    start = first_date - dt.timedelta(days=1)
    calendar = date_series(spark, start, end_date, "day")
    if ledger is None:
        return calendar.withColumn("extract_date", F.lit(first_date))
    gap = missing_days(spark, ledger, first_date, end_date).agg(F.min("day")).scalar()
    return (calendar.where(F.col("day") >= F.date_sub(gap, 1))
            .withColumn("extract_date", gap))


def plan_dates(spark: SparkSession, ledger_path: str, first_date: dt.date,
               end_date: dt.date) -> DatePlan:
    """Plan one run from the ledger at ``ledger_path``."""
    ledger = read_ledger(spark, ledger_path)
    start = first_date - dt.timedelta(days=1)
    if ledger is None:
        return DatePlan(first_date, start, end_date)
    gap = missing_days(spark, ledger, first_date, end_date).agg(F.min("day")).first()[0]
    if gap is None:
        return nothing_to_do(end_date)
    return DatePlan(gap, gap - dt.timedelta(days=1), end_date)


def ledger_rows(dates: DataFrame, processed_at: dt.datetime, column: str = "day") -> DataFrame:
    """Ledger rows for the dates in ``column`` (date or text), all stamped
    with one processing time."""
    source = F.col(column)
    if dict(dates.dtypes)[column] == "date":
        source = F.date_format(source, DATE_FORMAT)
    return dates.select(source.cast("string").alias(LEDGER_DATE_COL),
                        F.lit(f"{processed_at:{LEDGER_TIME_FORMAT}}").alias(LEDGER_TIME_COL))


def union_ledger(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept (the ledger as the next run sees it)."""
    return old.select(*LEDGER_COLUMNS).unionByName(new.select(*LEDGER_COLUMNS))


def append_ledger(spark: SparkSession, path: str, rows: DataFrame) -> bool:
    """Append ledger rows; the existing ledger's columns are checked first.
    Nothing is written when there are no rows. Returns whether it wrote."""
    check_ledger(spark, path)
    rows = rows.select(*LEDGER_COLUMNS)
    if rows.isEmpty():
        log.info("No dates to record in %s", path)
        return False
    # One part file per run: the rows are at most the run's calendar days.
    (rows.coalesce(1).write.mode("append").option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))
    log.info("Ledger %s updated", path)
    return True


def record_dates(spark: SparkSession, path: str, dates: list[str] | list[dt.date],
                 processed_at: dt.datetime) -> bool:
    """Record the given dates (text is kept as given, even if malformed)."""
    frame = spark.createDataFrame([(str(d),) for d in dates], "day string")
    return append_ledger(spark, path, ledger_rows(frame, processed_at))


def record_plan(spark: SparkSession, path: str, plan: DatePlan,
                processed_at: dt.datetime) -> bool:
    """Record ``plan.extract_date .. plan.end`` (built by Spark, not listed)."""
    # Empty when the plan is (its start, hence this, lies after its end).
    days = date_series(spark, max(plan.extract_date, plan.start), plan.end, "day")
    return append_ledger(spark, path, ledger_rows(days, processed_at))


__all__ = [
    "DatePlan", "LEDGER_COLUMNS", "append_ledger", "check_ledger", "check_ledger_columns",
    "compact_ledger", "ledger_columns", "ledger_days", "ledger_parts", "ledger_rows", "missing_days", "nothing_to_do", "plan_dates", "plan_frame",
    "read_ledger", "record_dates", "record_plan", "union_ledger",
]
