"""The batch job: plan from the ledger, extract, transform, load.

Run on a cluster with ``spark-submit -m dailybars.plans.job ...`` (or
``python -m dailybars.plans.job``); every parameter is a command-line
argument. Load writes the report first and the ledger second, so a crash in
between reruns those dates next time (at least once), never skips them. Before
either is written, the dates to record are reconciled with the files: a date
whose files hold rows of which none is usable fails the run. A run claims the
ledger (``streaming.claims``), so that two at a time cannot report the same
dates, and finishes what a killed run left between the two writes.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..errors import UnusableSourceError
from ..sinks import check_format, report_path, write_report
from ..session import apply_scale_defaults, size_shuffle
from ..sources.csv_ticks import empty_ticks, read_ticks_csv, tick_types
from ..sources.files import input_bytes, read_ticks_parquet
from ..streaming import claims
from ..streaming.ledger import (DatePlan, check_ledger, compact_ledger, ledger_parts,
                                plan_dates, record_plan)
from .report import daily_report

log = logging.getLogger(__name__)


class ReportJob:
    """One run. Planning happens at construction, like the original job."""

    def __init__(self, spark: SparkSession, cfg: JobConfig, now: dt.datetime | None = None):
        check_format(cfg.report_format)          # fail before any Spark job
        for name, value, allowed in (("source_format", cfg.source_format, ("csv", "parquet")),
                                     ("write_mode", cfg.write_mode, ("per_run", "by_date")),
                                     ("change_basis", cfg.change_basis, ("opening", "closing"))):
            if value not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, got {value!r}")
        self.spark = spark
        self.cfg = cfg
        self.now = now or dt.datetime.now()      # one processing time per run
        # A ledger that the run could not append to is refused before it reads
        # or writes anything.
        check_ledger(spark, cfg.ledger_path)
        self.claim: claims.Claim | None = None
        self.plan: DatePlan = plan_dates(spark, cfg.ledger_path,
                                         cfg.first_extract_date, cfg.end_date)
        log.info("plan: report from %s, read %s .. %s", self.plan.extract_date,
                 self.plan.start, self.plan.end)

    def _read(self, dates: list[dt.date]) -> DataFrame | None:
        """The ticks of the dates, with ``source_date``."""
        cfg = self.cfg
        if cfg.source_format == "parquet":
            ticks = read_ticks_parquet(self.spark, cfg.source_root, dates, cfg.source.date)
            return None if ticks is None else ticks.withColumn("source_date",
                                                               F.col(cfg.source.date))
        return read_ticks_csv(self.spark, cfg.source_root, dates, date_dir=cfg.date_dir,
                              file_glob=cfg.file_glob, src=cfg.source, with_source_date=True,
                              **cfg.csv_options)

    def extract(self) -> DataFrame:
        cfg = self.cfg
        empty = empty_ticks(self.spark, list(cfg.source.columns), tick_types(cfg.source))
        if self.plan.is_empty:
            return empty
        ticks = self._read(self.plan.dates)
        if ticks is None:
            return empty
        total = input_bytes(ticks)
        n = size_shuffle(self.spark, total, cfg.max_shuffle_partitions)
        log.info("input %d bytes -> %d initial shuffle partitions", total, n)
        return ticks

    def reconcile(self, report: DataFrame) -> None:
        """Fail if a date that the run would record has files with rows but
        none with an instrument and a date.

        Dates that the report holds are proven by it. Only the others (holidays,
        empty files, dates without files) are read again, so in the usual run
        next to nothing is. The dates are at most the plan's calendar days."""
        src, trg = self.cfg.source, self.cfg.report
        held = {r[0] for r in report.select(trg.date).distinct().collect()}
        absent = [d for d in self.plan.record_dates if d not in held]
        ticks = self._read(absent) if absent else None
        if ticks is None:
            return
        usable = F.col(src.isin).isNotNull() & F.col(src.date).isNotNull()
        found = (ticks.groupBy("source_date")
                 .agg(F.count(F.lit(1)).alias("rows"), F.count_if(usable).alias("usable"))
                 .where("rows > 0 and usable = 0").orderBy("source_date").collect())
        if found:
            days = ", ".join(f"{r.source_date} ({r.rows} rows)" for r in found)
            raise UnusableSourceError(
                f"files hold rows but no tick with {src.isin} and {src.date}: {days}; check their "
                "encoding, delimiter and columns. Nothing was written or recorded")

    def transform(self, ticks: DataFrame) -> DataFrame:
        cfg = self.cfg
        from ..operators import project
        # by_date output is clustered by date at write time, so a range
        # exchange by instrument would be wasted there.
        ordered = cfg.ordered_output and cfg.write_mode != "by_date"
        return daily_report(project(ticks, cfg.source.columns), self.plan.extract_date,
                            cfg.change_basis, cfg.source, cfg.report, ordered=ordered,
                            tie_break=cfg.tie_break, order_by_text=cfg.order_by_text)

    def load(self, report: DataFrame) -> str | None:
        cfg = self.cfg
        report = report.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.reconcile(report)
            path = self._write(report)
        finally:
            report.unpersist()
        record_plan(self.spark, cfg.ledger_path, self.plan, self.now)
        if 0 < cfg.compact_ledger_after < ledger_parts(self.spark, cfg.ledger_path):
            compact_ledger(self.spark, cfg.ledger_path)
        return path

    def _write(self, report: DataFrame) -> str | None:
        cfg = self.cfg
        # A report by date rewrites folders that earlier runs committed, so its
        # mark proves nothing; a run that died there is planned again.
        if self.claim is not None and cfg.write_mode != "by_date":
            path = report_path(cfg.target_root, cfg.report_key, self.now, cfg.report_format)
            self.claim = claims.announce(self.spark, cfg.ledger_path, self.claim, path,
                                         max(self.plan.extract_date, self.plan.start), self.plan.end)
        return write_report(report, cfg.target_root, cfg.report_key, cfg.report_format,
                            self.now, cfg.report.date, by_date=cfg.write_mode == "by_date",
                            sort_within=[cfg.report.isin])

    def run(self) -> str | None:
        """Claim the ledger, extract, transform, load. With nothing to do there
        is nothing to claim. The dates are planned again under the claim: another
        run may have recorded some since."""
        if self.plan.is_empty:
            return self._run()
        cfg = self.cfg
        self.claim, dead = claims.take(self.spark, cfg.ledger_path, cfg.stale_claim_hours)
        try:
            if dead is not None and claims.published(self.spark, dead):
                log.warning("recording %s .. %s, reported in %s by run %s", dead.first, dead.last,
                            dead.report, dead.run)
                record_plan(self.spark, cfg.ledger_path, DatePlan(
                    _date(dead.first), _date(dead.first), _date(dead.last)), self.now)
            self.plan = plan_dates(self.spark, cfg.ledger_path, cfg.first_extract_date, cfg.end_date)
            return self._run()
        finally:
            claims.release(self.spark, cfg.ledger_path, self.claim)

    def _run(self) -> str | None:
        """The shuffle sizing applies to this run's jobs only; the session
        setting is restored afterwards."""
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        before = self.spark.conf.get(key, None)
        try:
            return self.load(self.transform(self.extract()))
        finally:
            if before is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, before)


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def main(argv: list[str] | None = None) -> str | None:
    p = argparse.ArgumentParser(description="Daily trading report")
    p.add_argument("--source-root", required=True)
    p.add_argument("--target-root", required=True)
    p.add_argument("--ledger-path", required=True)
    p.add_argument("--first-extract-date", type=_date, required=True)
    p.add_argument("--end-date", type=_date, default=dt.date.today())
    p.add_argument("--report-key", default="report1/daily_report")
    p.add_argument("--format", default="parquet", dest="report_format")
    p.add_argument("--basis", default="opening", choices=["opening", "closing"])
    p.add_argument("--write-mode", default="per_run", choices=["per_run", "by_date"])
    p.add_argument("--source-format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--date-dir", default="{date}")
    p.add_argument("--file-glob", default="*", help="names of the files to read")
    p.add_argument("--tie-break", action="append", default=[], metavar="COLUMN",
                   help="orders ticks of the same time (can be repeated)")
    p.add_argument("--text-time", action="store_true", help="order times as text")
    p.add_argument("--max-shuffle-partitions", type=int, default=100_000)
    p.add_argument("--compact-ledger-after", type=int, default=200, metavar="FILES",
                   help="ledger part files beyond which they are compacted (0: never)")
    p.add_argument("--stale-claim-hours", type=float, default=24.0,
                   help="age at which the claim of a run that did not end is taken over")
    p.add_argument("--by-name", action="store_true", help="allow header drift")
    p.add_argument("--multi-line", action="store_true", help="quoted line breaks")
    p.add_argument("--sep", default=",", help="CSV field delimiter")
    p.add_argument("--encoding", default="utf-8", help="CSV file encoding")
    p.add_argument("--unordered", action="store_true",
                   help="skip ordering the written report by (ISIN, Date)")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO,
                        format="dailybars - %(asctime)s - %(levelname)s %(message)s")
    cfg = JobConfig(
        source_root=args.source_root, target_root=args.target_root,
        ledger_path=args.ledger_path, first_extract_date=args.first_extract_date,
        end_date=args.end_date, report_key=args.report_key,
        report_format=args.report_format, change_basis=args.basis,
        write_mode=args.write_mode, source_format=args.source_format,
        tie_break=tuple(args.tie_break), order_by_text=args.text_time,
        max_shuffle_partitions=args.max_shuffle_partitions,
        compact_ledger_after=args.compact_ledger_after, stale_claim_hours=args.stale_claim_hours,
        ordered_output=not args.unordered, date_dir=args.date_dir, file_glob=args.file_glob,
        csv_options={"by_name": args.by_name, "multi_line": args.multi_line,
                     "sep": args.sep, "encoding": args.encoding})
    spark = SparkSession.builder.appName("dailybars").getOrCreate()
    apply_scale_defaults(spark)
    return ReportJob(spark, cfg).run()


if __name__ == "__main__":
    main()
