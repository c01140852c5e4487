"""Header layouts of CSV files, found without reading the files.

The header pass opens each file's beginning only. Files up to ``SMALL_FILE``
bytes are packed into tasks and read (a filter on file metadata keeps that scan
from opening the others); of each larger file the first lines are taken by a
job of their own, which stops after them, ``AT_ONCE`` of these at a time. So the
bytes read do not grow with the files.

A layout is a header and a character set. Files are told apart by folders and
names on the file listing again, so a layout's scan opens its own files only.
Only what departs from the most common layout reaches the driver: one row per
folder whose files agree, one per file of folders that mix layouts.
"""

from __future__ import annotations

import codecs
import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_FILE = 4 << 20
AT_ONCE = 16
# Lines of a large file among which its first line that is not blank must be.
FIRST_LINES = 20

# Names of character sets that Spark reads, by Python's name.
CHARSETS = {
    "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1", "utf-8": "UTF-8", "utf-8-sig": "UTF-8",
    "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE", "utf-16": "UTF-16", "utf-32": "UTF-32",
}
# Those whose line feed is not one byte, and the marks files may begin with.
WIDE = ("UTF-16LE", "UTF-16BE", "UTF-16", "UTF-32")
SPLITTABLE = {"UTF-16LE": "utf-16-le", "UTF-16BE": "utf-16-be"}
MARKS = {codecs.BOM_UTF16_LE: "UTF-16LE", codecs.BOM_UTF16_BE: "UTF-16BE"}


def charset(spark: SparkSession, encoding: str, multi_line: bool = False) -> str:
    """The character set's name in Spark, for a name that Python or Spark
    knows. What cannot be read is refused here, before any work."""
    try:
        name = codecs.lookup(encoding).name
    except LookupError:
        name = None
    found = CHARSETS.get(name)
    if found is None and spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "true":
        found = encoding          # any set that the JVM knows; its lines end in one byte
    if found is None:
        raise ValueError(f"encoding {encoding!r} cannot be read; use one of {sorted(CHARSETS)}")
    if found == "UTF-32" and not multi_line:
        raise ValueError("UTF-32 files cannot be split into lines; read them with multi_line")
    return found


def is_missing_path(err: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err)


def folder_of(path: str = "_metadata.file_path") -> Column:
    """A file's folder, without a regular expression (it may run per row)."""
    p = F.col(path)
    return F.substring(p, F.lit(1), F.length(p) - F.length(F.substring_index(p, "/", -1)) - 1)


@dataclass(frozen=True)
class Layout:
    """Files with one header and character set: those in ``folders`` and
    ``files``, or with ``rest`` all but those."""

    columns: tuple[str, ...]
    charset: str
    folders: tuple[str, ...] = ()
    files: tuple[str, ...] = ()
    rest: bool = False

    def selector(self) -> Column | None:
        """A filter on file metadata; None takes every file."""
        if self.rest and not self.folders and not self.files:
            return None
        mine = (folder_of().isin(list(self.folders))
                | F.col("_metadata.file_path").isin(list(self.files)))
        return ~mine if self.rest else mine


def _first_line(raw: bytes, name: str) -> tuple[str, str]:
    """(header, character set) from the first line's bytes."""
    if name == "UTF-16":
        # Without a mark, the order of bytes is the one Python takes.
        name = MARKS.get(raw[:2], "UTF-16LE")
    if name in SPLITTABLE:
        # A line cut at the other order's line feed has half a character more.
        text = raw[: len(raw) // 2 * 2].decode(SPLITTABLE[name])
    else:
        text = raw.decode("utf-8" if name == "UTF-8" else name)
    return text.lstrip("﻿").rstrip("\r\n"), name


def _takes_first_lines(name: str):
    def run(batches):
        seen = set()
        for batch in batches:
            out = []
            for path, block, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if block == 0 and path not in seen and raw.strip(b"\r\n\x00"):
                    seen.add(path)
                    out.append((path, *_first_line(raw, name)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in zip(*out)],
                    names=["path", "header", "charset"])

    return run


_HEADERS = "path string, header string, charset string"


def file_headers(spark: SparkSession, paths: str, charset_name: str = "UTF-8",
                 file_glob: str | None = None, within: Column | None = None) -> DataFrame:
    """(path, header, charset) of every file that has a line, of those that the
    metadata filter ``within`` takes."""
    def lines(paths: str, glob: str | None) -> DataFrame:
        reader = spark.read.option("recursiveFileLookup", True)
        if charset_name in WIDE:
            # The other order's files are cut elsewhere, never before their mark.
            reader = reader.option("encoding", "UTF-16BE" if charset_name == "UTF-16BE"
                                   else "UTF-16LE").option("lineSep", "\n")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        text = reader.text(paths)
        return (text if within is None else text.where(within)).select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("raw"), F.col("_metadata.file_size").alias("size"))

    def of_large_file(path: str) -> list[tuple[str, str, str]]:
        for r in lines(_literal(path), None).limit(FIRST_LINES).collect():
            raw = bytes(r.raw)
            if raw.strip(b"\r\n\x00"):
                return [(r.path, *_first_line(raw, charset_name))]
        return []

    small = lines(paths, file_glob).where(F.col("size") <= SMALL_FILE).drop("size").mapInArrow(
        _takes_first_lines(charset_name), _HEADERS)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if file_glob:
        listed = listed.option("pathGlobFilter", file_glob)
    listed = listed.load(paths).where(F.col("length") > SMALL_FILE)
    large = [r.path for r in (listed if within is None else listed.where(within))
             .select("path").collect()]
    if not large:
        return small
    with ThreadPoolExecutor(AT_ONCE) as pool:
        found = [row for rows in pool.map(of_large_file, large) for row in rows]
    return small.unionByName(spark.createDataFrame(found, _HEADERS))


def _literal(path: str) -> str:
    """A path as a glob that matches itself only."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def csv_layouts(spark: SparkSession, paths: str, charset_name: str = "UTF-8", sep: str = ",",
                file_glob: str | None = None, within: Column | None = None) -> list[Layout] | None:
    """The layouts of the files (that the metadata filter ``within`` takes), the
    most common one first; None when nothing matches."""
    try:
        heads = file_headers(spark, paths, charset_name, file_glob, within).select(
            "path", folder_of("path").alias("folder"),
            F.struct("header", "charset").alias("kind")).persist()
    except AnalysisException as err:
        if is_missing_path(err):
            return None
        raise
    try:
        kinds = heads.groupBy("kind").count().orderBy(F.desc("count"), "kind").collect()
        others: list[tuple] = []
        if len(kinds) > 1:
            common = heads.sparkSession.createDataFrame([(kinds[0].kind,)], schema=(
                "kind struct<header string, charset string>"))
            folders = heads.groupBy("folder").agg(F.count_distinct("kind").alias("n"),
                                                  F.min("kind").alias("kind"))
            whole = folders.where("n = 1").join(common, "kind", "left_anti")
            mixed = heads.join(folders.where("n > 1").select("folder"), "folder", "left_semi")
            others = [*((r.kind, r.folder, None) for r in whole.collect()),
                      *((r.kind, None, r.path)
                        for r in mixed.join(common, "kind", "left_anti").collect())]
    finally:
        heads.unpersist()
    if not kinds:
        return None

    def columns(kind) -> tuple[str, ...]:
        return tuple(next(csv.reader([kind.header], delimiter=sep)))

    def named(kind, place: int) -> tuple[str, ...]:
        return tuple(sorted(o[place] for o in others if o[0] == kind and o[place] is not None))

    rest = Layout(columns(kinds[0].kind), kinds[0].kind.charset,
                  tuple(sorted(f for _, f, _ in others if f is not None)),
                  tuple(sorted(p for _, _, p in others if p is not None)), rest=True)
    return [rest, *(Layout(columns(k.kind), k.kind.charset, named(k.kind, 1), named(k.kind, 2))
                    for k in kinds[1:])]
