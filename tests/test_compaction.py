"""Ledger snapshots: fewer files, the same rows, whoever writes meanwhile."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from dailybars.errors import WrongLedgerError
from dailybars.streaming import snapshots
from dailybars.streaming.ledger import (append_ledger, compact_ledger, ledger_parts, ledger_rows,
                                        plan_dates, read_ledger, record_dates)

NOW = dt.datetime(2022, 3, 20, 6)
FIRST = dt.date(2022, 1, 1)


def record(spark, path, *days):
    record_dates(spark, path, [str(FIRST + dt.timedelta(days=d)) for d in days], NOW)


def days_of(spark, path):
    return sorted((dt.date.fromisoformat(r.source_date) - FIRST).days
                  for r in read_ledger(spark, path).collect())


def test_snapshots_and_later_parts_are_one_ledger(spark, tmp):
    path = f"{tmp}/meta"
    for d in range(4):
        record(spark, path, d)
    assert compact_ledger(spark, path) and not compact_ledger(spark, path)
    assert days_of(spark, path) == [0, 1, 2, 3] and ledger_parts(spark, path) == 0
    record(spark, path, 4, 5)
    assert days_of(spark, path) == [0, 1, 2, 3, 4, 5] and ledger_parts(spark, path) == 1
    assert plan_dates(spark, path, FIRST, FIRST + dt.timedelta(days=7)).extract_date == (
        FIRST + dt.timedelta(days=6))
    # The second snapshot removes what the first one had covered.
    assert compact_ledger(spark, path)
    record(spark, path, 6)
    assert days_of(spark, path) == list(range(7))
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 2


def test_planning_opens_few_files_after_many_runs(spark, tmp):
    """A thousand part files, as that many runs leave them."""
    path = f"{tmp}/meta"
    os.makedirs(path)
    for d in range(1000):
        with open(f"{path}/part-00000-{d}.csv", "w") as fh:
            fh.write(f"source_date,datetime_of_processing\n{FIRST + dt.timedelta(days=d)},x\n")
    assert ledger_parts(spark, path) == 1000
    compact_ledger(spark, path)
    record(spark, path, 1001)
    assert ledger_parts(spark, path) == 1
    files = read_ledger(spark, path).select(F.input_file_name()).distinct().count()
    assert files == 2
    assert plan_dates(spark, path, FIRST, FIRST + dt.timedelta(days=1001)).extract_date == (
        FIRST + dt.timedelta(days=1000))


def test_append_between_listing_and_commit_is_kept(spark, tmp, monkeypatch):
    path = f"{tmp}/meta"
    record(spark, path, 0)
    real = snapshots.commit

    def late(spark, ledger, rows, covered):
        record(spark, path, 1)
        return real(spark, ledger, rows, covered)

    monkeypatch.setattr(snapshots, "commit", late)
    compact_ledger(spark, path)
    monkeypatch.undo()
    assert days_of(spark, path) == [0, 1]
    compact_ledger(spark, path)
    assert days_of(spark, path) == [0, 1]


def test_two_compactions_at_once_lose_nothing(spark, tmp, monkeypatch):
    path = f"{tmp}/meta"
    record(spark, path, 0)
    compact_ledger(spark, path)
    record(spark, path, 1)
    real, nested = snapshots.commit, []

    def other_first(spark, ledger, rows, covered):
        if not nested:
            nested.append(True)
            record(spark, path, 2)
            compact_ledger(spark, path)       # a whole other compaction in between
        return real(spark, ledger, rows, covered)

    monkeypatch.setattr(snapshots, "commit", other_first)
    compact_ledger(spark, path)
    monkeypatch.undo()
    assert sorted(set(days_of(spark, path))) == [0, 1, 2]
    record(spark, path, 3)
    compact_ledger(spark, path)
    compact_ledger(spark, path)
    assert sorted(set(days_of(spark, path))) == [0, 1, 2, 3]


def test_crashed_compaction_counts_for_nothing(spark, tmp):
    path = f"{tmp}/meta"
    record(spark, path, 0, 1)
    compact_ledger(spark, path)
    record(spark, path, 2)
    compact_ledger(spark, path)
    name = sorted(os.listdir(f"{path}/_snapshots"))[-1]
    os.remove(f"{path}/_snapshots/{name}/covers/_SUCCESS")
    assert days_of(spark, path) == [0, 1, 2]       # the first snapshot and the part file
    record(spark, path, 3)
    compact_ledger(spark, path)
    assert days_of(spark, path) == [0, 1, 2, 3]


def test_moved_ledger_reads_rows_twice_rather_than_never(spark, tmp):
    record(spark, f"{tmp}/a", 0)
    compact_ledger(spark, f"{tmp}/a")
    record(spark, f"{tmp}/a", 1)
    shutil.copytree(f"{tmp}/a", f"{tmp}/b")
    assert sorted(set(days_of(spark, f"{tmp}/b"))) == [0, 1]


def test_wrong_columns_are_not_compacted(spark, tmp):
    path = f"{tmp}/meta"
    record(spark, path, 0)
    with open(f"{path}/z.csv", "w") as fh:
        fh.write("wrong_column,datetime_of_processing\nx,y\n")
    with pytest.raises(WrongLedgerError):
        compact_ledger(spark, path)
    assert not os.path.exists(f"{path}/_snapshots")


def test_no_ledger_and_empty_appends(spark, tmp):
    path = f"{tmp}/meta"
    assert not compact_ledger(spark, path) and read_ledger(spark, path) is None
    rows = spark.createDataFrame([], "day string")
    assert not append_ledger(spark, path, ledger_rows(rows, NOW))
    assert not compact_ledger(spark, path)


def test_job_compacts_beyond_its_limit(spark, tmp):
    from dailybars.config import JobConfig
    from dailybars.plans.job import ReportJob
    path = f"{tmp}/meta"
    for d in range(3):
        record(spark, path, d)
    cfg = JobConfig(source_root=f"{tmp}/src", target_root=f"{tmp}/trg", ledger_path=path,
                    first_extract_date=FIRST, end_date=FIRST + dt.timedelta(days=4),
                    compact_ledger_after=3)
    ReportJob(spark, cfg, NOW).run()
    assert ledger_parts(spark, path) == 0 and days_of(spark, path) == [0, 1, 2, 3, 4]
