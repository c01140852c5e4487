"""Snapshots of the ledger: one file instead of the many that runs appended.

A snapshot is a folder ``_snapshots/<number>-<random>`` of the ledger with its
``rows`` and, written last, the paths of the part files they come from
(``covers``). The success mark of ``covers`` commits it: readers take the
committed snapshot with the highest name, and of the part files those that it
does not cover. So they see the same rows before and after, whatever was
appended meanwhile, and a compaction that dies leaves nothing that counts.

A compaction deletes only what its predecessor had covered, never what it covers
itself: two at once, which start from the same predecessor, both hold its rows.
A reader whose files vanish under it fails, and can run again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import list_files

FOLDER = "_snapshots"
DONE = "_SUCCESS"


@dataclass(frozen=True)
class Snapshot:
    path: str
    covered: tuple[str, ...]

    def rows(self, spark: SparkSession, columns: tuple[str, ...]) -> DataFrame:
        schema = ", ".join(f"{c} string" for c in columns)
        return spark.read.option("header", True).schema(schema).csv(f"{self.path}/rows")

    def uncovered(self) -> Column:
        return ~F.col("_metadata.file_path").isin(list(self.covered))


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, ledger: str) -> list[str]:
    """The committed snapshots' names, oldest first."""
    fs, folder = file_system(spark, f"{ledger.rstrip('/')}/{FOLDER}")
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder)]
    mark = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(p.getName() for p in found if fs.exists(mark(mark(p, "covers"), DONE)))


def newest(spark: SparkSession, ledger: str) -> Snapshot | None:
    names = _names(spark, ledger)
    if not names:
        return None
    path = f"{ledger.rstrip('/')}/{FOLDER}/{names[-1]}"
    covered = spark.read.text(f"{path}/covers").collect()
    return Snapshot(path, tuple(r.value for r in covered))


def part_files(spark: SparkSession, ledger: str) -> DataFrame:
    """(path) of the visible part files."""
    return list_files(spark, f"{ledger.rstrip('/')}/").select("path")


def commit(spark: SparkSession, ledger: str, rows: DataFrame, covered: list[str]) -> Snapshot:
    """Write a snapshot of rows and of what they cover; the second write commits
    it."""
    names = _names(spark, ledger)
    number = int(names[-1].split("-")[0]) + 1 if names else 1
    path = f"{ledger.rstrip('/')}/{FOLDER}/{number:010d}-{uuid.uuid4().hex[:12]}"
    rows.coalesce(1).write.option("header", True).csv(f"{path}/rows")
    (spark.createDataFrame([(p,) for p in covered], "path string").coalesce(1)
     .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").text(f"{path}/covers"))
    return Snapshot(path, tuple(covered))


def remove_superseded(spark: SparkSession, ledger: str, before: Snapshot | None) -> int:
    """Delete the part files that the predecessor ``before`` covered and the
    snapshots older than it; returns how many files and folders."""
    if before is None:
        return 0
    older = [n for n in _names(spark, ledger) if n < before.path.rsplit("/", 1)[1]]
    gone = [*before.covered, *(f"{ledger.rstrip('/')}/{FOLDER}/{n}" for n in older)]
    removed = 0
    for name in gone:
        fs, path = file_system(spark, name)
        removed += bool(fs.delete(path, True))
    return removed
