"""One run at a time publishes; a killed one is finished or run again."""

import datetime as dt
import os

import pytest

from conftest import write_golden_files
from dailybars.config import JobConfig
from dailybars.errors import RunInProgressError
from dailybars.plans import job as J
from dailybars.plans.job import ReportJob
from dailybars.streaming import claims
from dailybars.streaming.ledger import read_ledger

FIRST, LAST = dt.date(2021, 4, 16), dt.date(2021, 4, 19)
NOW = dt.datetime(2021, 4, 20, 6)


class Killed(BaseException):
    """The process ends: nothing of it runs any more."""


@pytest.fixture()
def cfg(tmp):
    write_golden_files(f"{tmp}/src")
    return JobConfig(source_root=f"{tmp}/src", target_root=f"{tmp}/trg", ledger_path=f"{tmp}/meta",
                     first_extract_date=FIRST, end_date=LAST)


def reports(cfg):
    folder = f"{cfg.target_root}/report1"
    return sorted(os.listdir(folder)) if os.path.exists(folder) else []


def recorded(spark, cfg):
    ledger = read_ledger(spark, cfg.ledger_path)
    return [] if ledger is None else sorted(r.source_date for r in ledger.collect())


DAYS = [str(FIRST + dt.timedelta(days=k)) for k in range(4)]


def kill(spark, cfg, monkeypatch, at):
    """A run that ends at a function of the job, its claim left behind."""
    def die(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(J, at, die)
        m.setattr(claims, "release", lambda *_: None)
        with pytest.raises(Killed):
            ReportJob(spark, cfg, NOW).run()


def later(cfg, **kw):
    return JobConfig(**{**cfg.__dict__, **kw})


def test_claim_is_released_after_success_and_failure(spark, cfg):
    ReportJob(spark, cfg, NOW).run()
    assert claims.held(spark, cfg.ledger_path) is None and recorded(spark, cfg) == DAYS
    bad = later(cfg, end_date=LAST + dt.timedelta(days=1))
    os.makedirs(f"{cfg.source_root}/2021-04-20")
    with open(f"{cfg.source_root}/2021-04-20/a.csv", "w") as fh:
        fh.write("a,b\n1,2\n")
    with pytest.raises(Exception):
        ReportJob(spark, bad, NOW).run()
    assert claims.held(spark, cfg.ledger_path) is None


def test_second_run_on_the_same_gap_is_refused(spark, cfg, monkeypatch):
    other = ReportJob(spark, cfg, NOW + dt.timedelta(minutes=1))
    seen = []
    real = J.write_report

    def meanwhile(*args, **kw):
        with pytest.raises(RunInProgressError, match="has claimed the ledger"):
            other.run()
        seen.append(True)
        return real(*args, **kw)

    monkeypatch.setattr(J, "write_report", meanwhile)
    ReportJob(spark, cfg, NOW).run()
    monkeypatch.undo()
    assert seen and len(reports(cfg)) == 1
    # Planned before, run after: the dates are planned again, nothing is left.
    assert other.run() is None and len(reports(cfg)) == 1 and recorded(spark, cfg) == DAYS


def test_crash_between_report_and_ledger_is_finished(spark, cfg, monkeypatch):
    kill(spark, cfg, monkeypatch, "record_plan")
    assert len(reports(cfg)) == 1 and recorded(spark, cfg) == []
    claim = claims.held(spark, cfg.ledger_path)
    assert claim.report.endswith(reports(cfg)[0]) and (claim.first, claim.last) == (DAYS[0], DAYS[-1])
    with pytest.raises(RunInProgressError):
        ReportJob(spark, cfg, NOW + dt.timedelta(hours=1)).run()
    assert ReportJob(spark, later(cfg, stale_claim_hours=0.0), NOW + dt.timedelta(hours=1)).run() is None
    assert len(reports(cfg)) == 1 and recorded(spark, cfg) == DAYS
    assert claims.held(spark, cfg.ledger_path) is None


def test_crash_before_the_report_is_run_again(spark, cfg, monkeypatch):
    kill(spark, cfg, monkeypatch, "write_report")
    assert reports(cfg) == [] and recorded(spark, cfg) == []
    path = ReportJob(spark, later(cfg, stale_claim_hours=0.0), NOW + dt.timedelta(hours=1)).run()
    assert path and len(reports(cfg)) == 1 and recorded(spark, cfg) == DAYS


def test_report_without_its_mark_is_run_again(spark, cfg, monkeypatch):
    kill(spark, cfg, monkeypatch, "record_plan")
    os.remove(f"{cfg.target_root}/report1/{reports(cfg)[0]}/_SUCCESS")
    path = ReportJob(spark, later(cfg, stale_claim_hours=0.0), NOW + dt.timedelta(hours=1)).run()
    assert path and len(reports(cfg)) == 2 and recorded(spark, cfg) == DAYS


def test_by_date_reports_are_run_again(spark, cfg, monkeypatch):
    by_date = later(cfg, write_mode="by_date")
    kill(spark, by_date, monkeypatch, "record_plan")
    assert claims.held(spark, cfg.ledger_path).report is None
    again = later(by_date, stale_claim_hours=0.0)
    path = ReportJob(spark, again, NOW + dt.timedelta(hours=1)).run()
    assert spark.read.parquet(path).count() == 3 + 1 and recorded(spark, cfg) == DAYS


def test_nothing_to_do_claims_nothing(spark, cfg):
    ReportJob(spark, cfg, NOW).run()
    assert ReportJob(spark, cfg, NOW).run() is None
    assert claims.held(spark, cfg.ledger_path) is None
    assert not os.path.exists(f"{cfg.ledger_path}/_runs")


def test_claims_are_no_part_of_the_ledger(spark, cfg):
    claim, dead = claims.take(spark, cfg.ledger_path, 24.0)
    assert dead is None and read_ledger(spark, cfg.ledger_path) is None
    claims.release(spark, cfg.ledger_path, claims.Claim("other", claim.started))
    assert claims.held(spark, cfg.ledger_path) == claim
