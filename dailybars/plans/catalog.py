"""Registered queries: one per operator, each reading the given tables.

Ticks come from ``events`` (mapping in ``sources.tables``). CSV sources,
written reports and ledgers are *derived* from the tables by Spark and
written below ``spark.checkpoint.dir``, then read back by the operator under
test, so every query's work grows with the tables.

The derived ledger holds the days a previous run "processed": all but the quiet
days, whose event count is more than one standard deviation below the mean.
Its first gap lies strictly inside the planned range at every scale, so a
planner that ignores the ledger, or one that reads no further than its first
day, gives other rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig, ReportColumns, SourceColumns
from ..functions import date_series, format_date, parse_date, pct_change, round_half_even
from ..operators import (add_change, closing_price, daily_high, daily_low, daily_ohlcv,
                         daily_volume, first_date, opening_price, project,
                         ticks_with_open_close)
from ..session import scratch_dir
from ..sinks import write_table
from ..sources.csv_ticks import read_ticks_csv
from ..sources.files import (date_from_path, list_files, list_prefix, read_csv_table, read_parquet,
                             read_ticks_parquet)
from ..sources.tables import event_ticks, event_ticks_text_time, read_table
from ..errors import WrongFormatError, WrongLedgerError
from ..streaming.ledger import (DatePlan, append_ledger, check_ledger_columns, compact_ledger,
                                ledger_days, ledger_rows, missing_days, plan_frame, read_ledger,
                                union_ledger)
from .job import ReportJob
from .report import daily_report, report_schema, round_floats

SRC = SourceColumns()
TRG = ReportColumns()

# Query parameters (the oracle SQL uses the same values).
FIRST_DATE = dt.date(2024, 1, 10)
END_DATE = dt.date(2024, 1, 30)
LATER_DATE = dt.date(2024, 1, 20)
DRIFT_DATE = dt.date(2024, 1, 16)
AFTER_DATE = dt.date(2030, 1, 2)
PREFIX = "2024-01-1"
PREVIOUS_RUN = dt.datetime(2024, 1, 30, 6, 0, 0)
THIS_RUN = dt.datetime(2024, 1, 31, 6, 0, 0)
V1_COLUMNS = ("ISIN", "Date", "Time", "StartPrice", "MaxPrice", "MinPrice", "EndPrice",
              "TradedVolume")
# Column order of the second CSV layout (header drift): reordered, and
# Mnemonic and EndPrice are missing.
DRIFT_COLUMNS = ("Time", "ISIN", "Date", "StartPrice", "MaxPrice", "MinPrice", "TradedVolume")

def _write_tick_csv(frame: DataFrame, path: str, columns, mode: str = "errorifexists",
                    encoding: str = "UTF-8", rows: int | None = None) -> None:
    """One folder of CSV files per date; with ``rows`` 0 files of headers only."""
    if rows == 0:
        days = [r.day for r in frame.select(F.date_format(SRC.date, "yyyy-MM-dd").alias("day"))
                .distinct().collect()]
        for day in days:
            (frame.where(F.lit(False)).select(*columns).coalesce(1).write.mode(mode)
             .option("header", True).csv(f"{path}/day={day}"))
        return
    (frame.withColumn("day", F.date_format(SRC.date, "yyyy-MM-dd"))
     .select(*columns, "day").write.mode(mode).partitionBy("day")
     .option("header", True).option("encoding", encoding).csv(path))


def tick_csv_root(spark: SparkSession, sf_dir: str) -> str:
    """Event ticks as CSV files, one folder per date (``day=<date>``)."""
    path = scratch_dir(spark, "tick-csv")
    _write_tick_csv(event_ticks_text_time(spark, sf_dir), path, SRC.columns)
    return path


def drift_csv_root(spark: SparkSession, sf_dir: str) -> str:
    """Event ticks as CSV with a header change from DRIFT_DATE on."""
    path = scratch_dir(spark, "drift-csv")
    ticks = event_ticks_text_time(spark, sf_dir)
    _write_tick_csv(ticks.where(F.col(SRC.date) < F.lit(DRIFT_DATE)), path, SRC.columns)
    _write_tick_csv(ticks.where(F.col(SRC.date) >= F.lit(DRIFT_DATE)), path,
                    DRIFT_COLUMNS, mode="append")
    return path


def utf16_csv_root(spark: SparkSession, sf_dir: str) -> str:
    """Event ticks as UTF-16 files: little-endian ones without a mark before
    DRIFT_DATE, then such with a mark (and the other order of bytes)."""
    path = scratch_dir(spark, "utf16-csv")
    ticks = event_ticks_text_time(spark, sf_dir)
    _write_tick_csv(ticks.where(F.col(SRC.date) < F.lit(DRIFT_DATE)), path, SRC.columns,
                    encoding="UTF-16LE")
    _write_tick_csv(ticks.where(F.col(SRC.date) >= F.lit(DRIFT_DATE)), path, SRC.columns,
                    mode="append", encoding="UTF-16")
    return path


def parquet_ticks_root(spark: SparkSession, sf_dir: str) -> str:
    """Event ticks as Parquet partitioned by Date."""
    path = scratch_dir(spark, "tick-parquet")
    event_ticks(spark, sf_dir).write.partitionBy(SRC.date).parquet(path)
    return path


def csv_ticks(spark: SparkSession, sf_dir: str, dates=None, **kw) -> DataFrame:
    return read_ticks_csv(spark, tick_csv_root(spark, sf_dir), dates, date_dir="day={date}",
                          **kw)


def previous_ledger(spark: SparkSession, sf_dir: str, quiet_days: bool = False,
                    processed_at: dt.datetime = PREVIOUS_RUN) -> DataFrame:
    """Ledger rows for all days but the quiet ones (or for all days)."""
    daily = (read_table(spark, sf_dir, "events")
             .groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n")))
    if not quiet_days:
        least = daily.agg(F.avg("n") - F.stddev_samp("n")).scalar()
        daily = daily.where(F.col("n") >= least)
    return ledger_rows(daily.select("day"), processed_at)


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as four-price bars: supplier per ship date."""
    li = read_table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select(
        F.col("l_suppkey").cast("string").alias(SRC.isin),
        F.to_date("l_shipdate").alias(SRC.date),
        F.col("l_extendedprice").alias(SRC.start_price),
        net.alias(SRC.min_price),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias(SRC.max_price),
        F.col("l_quantity").cast("long").alias(SRC.traded_volume),
    )


def report_ticks(spark: SparkSession, sf_dir: str, first: dt.date = FIRST_DATE) -> DataFrame:
    """The ticks that a report from ``first`` on needs: its dates and one
    look-back day, cut by a bound that the Parquet scan gets."""
    return event_ticks(spark, sf_dir, since=first - dt.timedelta(days=1))


def _last_day(spark: SparkSession, sf_dir: str) -> dt.date:
    return read_table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]


# --- queries ---------------------------------------------------------------

def q_daily_report(spark, sf):
    # Order is a property of the written files (the job orders them) or of a
    # final sort; the report itself skips the range exchange. See
    # q_report_sorted for the ordered plan.
    return daily_report(report_ticks(spark, sf), FIRST_DATE, ordered=False)


def q_daily_report_csv(spark, sf):
    # The report needs seven of nine columns: the pruned CSV path.
    return daily_report(csv_ticks(spark, sf), FIRST_DATE, ordered=False)


def q_report_empty(spark, sf):
    # Dates without ticks: a typed report without rows.
    return daily_report(event_ticks(spark, sf, since=AFTER_DATE), AFTER_DATE)


def q_list_prefix(spark, sf):
    # A key prefix covers ten dates; the result is the dates that have files.
    listed = list_prefix(spark, tick_csv_root(spark, sf), f"day={PREFIX}")
    return listed.select(date_from_path("path", "day={date}").alias("day")).distinct()


def q_extract_no_files(spark, sf):
    return csv_ticks(spark, sf, [AFTER_DATE])


def q_scan_ticks(spark, sf):
    return csv_ticks(spark, sf)


def q_scan_ticks_utf16(spark, sf):
    return read_ticks_csv(spark, utf16_csv_root(spark, sf), date_dir="day={date}",
                          encoding="utf-16")


def q_extract_dates(spark, sf):
    plan = DatePlan(FIRST_DATE, FIRST_DATE - dt.timedelta(days=1), END_DATE)
    return csv_ticks(spark, sf, plan.dates, with_source_date=True)


def q_extract_dates_parquet(spark, sf):
    plan = DatePlan(FIRST_DATE, FIRST_DATE - dt.timedelta(days=1), END_DATE)
    return read_ticks_parquet(spark, parquet_ticks_root(spark, sf), plan.dates, SRC.date)


def q_read_report(spark, sf):
    path = scratch_dir(spark, "report-parquet")
    write_table(daily_report(report_ticks(spark, sf), FIRST_DATE), path, "parquet")
    return read_parquet(spark, path)


def q_read_report_csv(spark, sf):
    path = scratch_dir(spark, "report-csv")
    write_table(daily_report(report_ticks(spark, sf), FIRST_DATE), path, "csv")
    schema = ("ISIN string, Date date, OpeningPriceEur double, ClosingPriceEur double, "
              "MinimumPriceEur double, MaximumPriceEur double, DailyTradedVolume bigint, "
              "`ChangePrevClosing%` double")
    return read_csv_table(spark, path, schema)


def q_project_ticks(spark, sf):
    return project(event_ticks(spark, sf), V1_COLUMNS)


def q_report_from_date(spark, sf):
    return daily_report(report_ticks(spark, sf, LATER_DATE), LATER_DATE)


def q_report_sorted(spark, sf):
    # Globally ordered by (ISIN, Date) with no extra exchange: the range
    # exchange on ISIN also serves the change window.
    return daily_report(report_ticks(spark, sf), FIRST_DATE, basis="closing", ordered=True)


def q_daily_ohlcv(spark, sf):
    return daily_ohlcv(event_ticks(spark, sf))


def q_daily_ohlcv_tie_break(spark, sf):
    # Times cut to the hour: many ticks of an instrument-day share one.
    ticks = event_ticks(spark, sf).withColumn(SRC.time, F.date_trunc("hour", SRC.time))
    return daily_ohlcv(ticks, tie_break=(SRC.start_price,))


def q_opening_price(spark, sf):
    return opening_price(event_ticks(spark, sf))


def q_closing_price(spark, sf):
    return closing_price(event_ticks(spark, sf))


def q_daily_low(spark, sf):
    return daily_low(lineitem_ticks(spark, sf))


def q_daily_high(spark, sf):
    return daily_high(lineitem_ticks(spark, sf))


def q_daily_volume(spark, sf):
    return daily_volume(lineitem_ticks(spark, sf))


def _change(spark, sf, basis):
    day = add_change(daily_ohlcv(event_ticks(spark, sf)), TRG, basis)
    return round_floats(day.select(TRG.isin, TRG.date, TRG.opening, TRG.closing,
                                   F.col(f"`{TRG.change}`")), [TRG.change])


def q_change_opening_basis(spark, sf):
    return _change(spark, sf, "opening")


def q_change_closing_basis(spark, sf):
    return _change(spark, sf, "closing")


def q_ticks_with_open_close(spark, sf):
    return ticks_with_open_close(event_ticks(spark, sf))


def q_union_ticks(spark, sf):
    return read_ticks_csv(spark, drift_csv_root(spark, sf), date_dir="day={date}", by_name=True,
                          with_source_date=True).select(*SRC.columns, "source_date")


def q_ledger_union(spark, sf):
    old = previous_ledger(spark, sf)
    new = ledger_rows(plan_frame(spark, old, FIRST_DATE, END_DATE)
                      .where(F.col("day") >= F.col("extract_date")).select("day"), THIS_RUN)
    return union_ledger(old, new)


def q_ledger_missing_dates(spark, sf):
    return missing_days(spark, previous_ledger(spark, sf), FIRST_DATE, END_DATE)


def q_ledger_first_gap(spark, sf):
    return first_date(q_ledger_missing_dates(spark, sf), "day", "first_gap")


def q_plan_dates(spark, sf):
    return plan_frame(spark, previous_ledger(spark, sf), FIRST_DATE, END_DATE)


def q_plan_dates_no_ledger(spark, sf):
    # First run: the end of the plan is the last day of the events.
    return plan_frame(spark, None, FIRST_DATE, _last_day(spark, sf))


def q_plan_dates_complete(spark, sf):
    # Every day is recorded: nothing to read.
    return plan_frame(spark, previous_ledger(spark, sf, quiet_days=True), FIRST_DATE,
                      _last_day(spark, sf))


def q_ledger_noop(spark, sf):
    """A ledger before and after a run that has nothing to record."""
    path = scratch_dir(spark, "ledger-noop")
    append_ledger(spark, path, previous_ledger(spark, sf, quiet_days=True))
    plan = q_plan_dates_complete(spark, sf)
    append_ledger(spark, path, ledger_rows(plan.select("day"), THIS_RUN))
    return read_ledger(spark, path)


def q_ledger_dates_to_record(spark, sf):
    plan = q_plan_dates(spark, sf)
    return ledger_rows(plan.where(F.col("day") >= F.col("extract_date")).select("day"),
                       THIS_RUN)


def q_round_half_even(spark, sf):
    li = read_table(spark, sf, "lineitem")
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", round_half_even(charge).alias("charge"))


def q_pct_change(spark, sf):
    day = daily_ohlcv(event_ticks(spark, sf))
    change = pct_change(F.col(TRG.closing), F.col(TRG.opening))
    return day.select(TRG.isin, TRG.date, round_half_even(change).alias("intraday_change"))


def q_parse_date(spark, sf):
    ledger = previous_ledger(spark, sf)
    return ledger.select("source_date", parse_date(F.col("source_date")).alias("day"))


def q_format_date(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", format_date(F.to_date("ts")).alias("date_text"),
                     format_date(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


def q_date_series(spark, sf):
    first = read_table(spark, sf, "events").agg(F.min(F.to_date("ts"))).first()[0]
    return date_series(spark, first - dt.timedelta(days=1), _last_day(spark, sf))


def q_ledger_days(spark, sf):
    return ledger_days(previous_ledger(spark, sf))


def q_ledger_scan(spark, sf):
    path = scratch_dir(spark, "ledger")
    append_ledger(spark, path, previous_ledger(spark, sf))
    return read_ledger(spark, path)


def q_ledger_compacted(spark, sf):
    """A ledger of two snapshots and a later run's part file."""
    path = scratch_dir(spark, "ledger-compacted")
    old = previous_ledger(spark, sf)
    for k in range(2):
        append_ledger(spark, path, old.where(F.col("source_date").substr(9, 2).cast("int") % 3 == k))
        compact_ledger(spark, path)
    append_ledger(spark, path, old.where(F.col("source_date").substr(9, 2).cast("int") % 3 == 2))
    return read_ledger(spark, path)


def q_scan_skips_empty_files(spark, sf):
    """Tick files beside files that hold a header only: rows per source date."""
    root = tick_csv_root(spark, sf)
    _write_tick_csv(event_ticks_text_time(spark, sf), root, SRC.columns, mode="append", rows=0)
    ticks = read_ticks_csv(spark, root, date_dir="day={date}", with_source_date=True)
    return ticks.groupBy("source_date").agg(F.count(F.lit(1)).alias("n"))


def q_empty_write_leaves_nothing(spark, sf):
    """Files below the target after a write of dates with, and of dates without
    ticks."""
    out = []
    for name, first in (("some", FIRST_DATE), ("none", AFTER_DATE)):
        path = scratch_dir(spark, f"guard-{name}")
        wrote = write_table(daily_report(report_ticks(spark, sf, first), first), path, "parquet")
        listed = list_files(spark, f"{path}/")
        out.append(listed.agg((F.count("path") > 0).alias("has_files")).select(
            F.lit(name).alias("target"), F.lit(wrote).alias("wrote"), "has_files"))
    return out[0].unionByName(out[1])


def q_wrong_format(spark, sf):
    """What a write in each asked format says: nothing, or which fault. The
    check of an empty frame comes first."""
    rows = daily_report(report_ticks(spark, sf), FIRST_DATE)
    none = daily_report(report_ticks(spark, sf, AFTER_DATE), AFTER_DATE)
    out = []
    for case, frame, fmt in (("csv", rows, "csv"), ("parquet", rows, "parquet"),
                             ("orc", rows, "orc"), ("orc, no rows", none, "orc")):
        try:
            write_table(frame, scratch_dir(spark, "format"), fmt)
            fault = "none"
        except WrongFormatError:
            fault = "wrong format"
        out.append((case, fault))
    return spark.createDataFrame(out, "asked string, fault string").withColumn(
        "report_rows", rows.agg(F.count(F.lit(1))).scalar())


def q_ledger_faults(spark, sf):
    """What the check of a ledger's columns says, for ledgers made from the
    previous one."""
    ledger = previous_ledger(spark, sf)
    cases = {"as it is": ledger, "turned round": ledger.select(*reversed(ledger.columns)),
             "renamed": ledger.withColumnRenamed("source_date", "wrong_column"),
             "one more": ledger.withColumn("more", F.lit("x")),
             "one less": ledger.select("source_date")}
    out = []
    for case, frame in cases.items():
        try:
            check_ledger_columns(frame.columns)
            fault = "none"
        except WrongLedgerError as err:
            fault = str(err.args[0]).split("]: ")[1]
        out.append((case, fault))
    return spark.createDataFrame(out, "ledger string, fault string").withColumn(
        "days", ledger.agg(F.count(F.lit(1))).scalar())


def q_etl_job(spark, sf):
    """The whole job on derived data: plan from a ledger with gaps, extract
    the CSV tick files of the planned dates, report, write, record. Returns
    the written report. Each call runs in fresh folders (the job appends)."""
    ledger = scratch_dir(spark, "etl-ledger")
    append_ledger(spark, ledger, previous_ledger(spark, sf))
    cfg = JobConfig(source_root=tick_csv_root(spark, sf),
                    target_root=scratch_dir(spark, "etl-target"), ledger_path=ledger,
                    first_extract_date=FIRST_DATE, end_date=END_DATE,
                    date_dir="day={date}")
    path = ReportJob(spark, cfg, THIS_RUN).run()
    if path is None:
        return spark.createDataFrame([], report_schema(TRG))
    return read_parquet(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_report": q_daily_report,
    "daily_report_csv": q_daily_report_csv,
    "report_empty": q_report_empty,
    "list_prefix": q_list_prefix,
    "extract_no_files": q_extract_no_files,
    "scan_ticks": q_scan_ticks,
    "scan_ticks_utf16": q_scan_ticks_utf16,
    "extract_dates": q_extract_dates,
    "extract_dates_parquet": q_extract_dates_parquet,
    "read_report": q_read_report,
    "read_report_csv": q_read_report_csv,
    "project_ticks": q_project_ticks,
    "report_from_date": q_report_from_date,
    "report_sorted": q_report_sorted,
    "daily_ohlcv": q_daily_ohlcv,
    "daily_ohlcv_tie_break": q_daily_ohlcv_tie_break,
    "opening_price": q_opening_price,
    "closing_price": q_closing_price,
    "daily_low": q_daily_low,
    "daily_high": q_daily_high,
    "daily_volume": q_daily_volume,
    "change_opening_basis": q_change_opening_basis,
    "change_closing_basis": q_change_closing_basis,
    "ticks_with_open_close": q_ticks_with_open_close,
    "union_ticks": q_union_ticks,
    "ledger_union": q_ledger_union,
    "ledger_missing_dates": q_ledger_missing_dates,
    "ledger_first_gap": q_ledger_first_gap,
    "ledger_days": q_ledger_days,
    "ledger_scan": q_ledger_scan,
    "etl_job": q_etl_job,
    "ledger_noop": q_ledger_noop,
    "ledger_compacted": q_ledger_compacted,
    "ledger_faults": q_ledger_faults,
    "scan_skips_empty_files": q_scan_skips_empty_files,
    "empty_write_leaves_nothing": q_empty_write_leaves_nothing,
    "wrong_format": q_wrong_format,
    "plan_dates": q_plan_dates,
    "plan_dates_no_ledger": q_plan_dates_no_ledger,
    "plan_dates_complete": q_plan_dates_complete,
    "ledger_dates_to_record": q_ledger_dates_to_record,
    "round_half_even": q_round_half_even,
    "pct_change": q_pct_change,
    "parse_date": q_parse_date,
    "format_date": q_format_date,
    "date_series": q_date_series,
}
