"""Claims: of the runs on one ledger at most one publishes at a time.

Every run plans from the ledger's first gap on, so two runs at the same time
would report the same dates. A run therefore creates the file ``_runs/claim`` of
the ledger before it plans and removes it at the end, also when it fails. The
claim says which report goes with which dates before that report is written.

A run that was killed leaves its claim. Once that is older than the limit, the
next run takes it over: if the claimed report was committed (its success mark is
there), its dates are recorded now and not reported twice; if not, they are
planned again. So after a crash between the two writes the report and the ledger
agree again. The report is still written before the ledger.

Creating a file that must not exist is atomic on HDFS; on object stores that
cannot do it, two runs may still both start.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..errors import RunInProgressError
from .snapshots import DONE, file_system

log = logging.getLogger(__name__)

FOLDER = "_runs"


@dataclass(frozen=True)
class Claim:
    run: str
    started: str                     # UTC, ISO format
    report: str | None = None        # the report this run writes, and its dates
    first: str | None = None
    last: str | None = None

    def age_hours(self, now: dt.datetime) -> float:
        return (now - dt.datetime.fromisoformat(self.started)).total_seconds() / 3600


def _path(ledger: str, name: str = "claim") -> str:
    return f"{ledger.rstrip('/')}/{FOLDER}/{name}"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _write(spark: SparkSession, path: str, claim: Claim, overwrite: bool) -> bool:
    """False if the file is there and must not be."""
    fs, target = file_system(spark, path)
    try:
        stream = fs.create(target, overwrite)
    except Py4JJavaError as err:
        if "FileAlreadyExists" in str(err.java_exception):
            return False
        raise
    try:
        stream.write(bytearray(json.dumps(asdict(claim)), "utf-8"))
    finally:
        stream.close()
    return True


def held(spark: SparkSession, ledger: str) -> Claim | None:
    """The claim on a ledger, if there is one."""
    fs, path = file_system(spark, _path(ledger))
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return Claim(**json.loads(bytes(stream.readAllBytes()).decode("utf-8")))
    finally:
        stream.close()


def take(spark: SparkSession, ledger: str, stale_hours: float) -> tuple[Claim, Claim | None]:
    """(own claim, the claim of a dead run that it replaces). Fails while
    another run's claim is younger than ``stale_hours``."""
    mine = Claim(uuid.uuid4().hex, _now().isoformat(timespec="seconds"))
    if _write(spark, _path(ledger), mine, overwrite=False):
        return mine, None
    other = held(spark, ledger)
    if other is not None:
        if other.age_hours(_now()) < stale_hours:
            raise RunInProgressError(
                f"run {other.run} has claimed the ledger {ledger} since {other.started} UTC; it is "
                f"taken over once that is {stale_hours:g} hours ago, or remove {_path(ledger)}")
        # Only one run can move the dead one's claim away.
        fs, old = file_system(spark, _path(ledger))
        if not fs.rename(old, file_system(spark, _path(ledger, f"dead-{other.run}"))[1]):
            raise RunInProgressError(f"another run takes over the ledger {ledger} just now")
        log.warning("run %s of %s left its claim; taken over", other.run, other.started)
    if not _write(spark, _path(ledger), mine, overwrite=False):
        raise RunInProgressError(f"another run has claimed the ledger {ledger} just now")
    return mine, other


def announce(spark: SparkSession, ledger: str, claim: Claim, report: str, first: dt.date,
             last: dt.date) -> Claim:
    """Say which report is about to be written for which dates."""
    said = Claim(claim.run, claim.started, report, first.isoformat(), last.isoformat())
    _write(spark, _path(ledger), said, overwrite=True)
    return said


def published(spark: SparkSession, dead: Claim) -> bool:
    """Whether a dead run's report was committed."""
    if dead.report is None:
        return False
    fs, mark = file_system(spark, f"{dead.report}/{DONE}")
    return fs.exists(mark)


def release(spark: SparkSession, ledger: str, claim: Claim) -> None:
    """Remove the claim, if it is still this run's, and the folders that were
    made for it if they hold nothing: a failed first run leaves no ledger."""
    now = held(spark, ledger)
    if now is None or now.run != claim.run:
        return
    fs, path = file_system(spark, _path(ledger))
    fs.delete(path, False)
    for folder in (path.getParent(), path.getParent().getParent()):
        if len(fs.listStatus(folder)):
            break
        fs.delete(folder, False)
