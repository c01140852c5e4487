"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir


_SHIPPED: set[str] = set()


# Rows and bytes per Arrow batch where the session has Spark's defaults: texts
# are long, and a batch is held in memory on both sides.
BATCH_ROWS = 1024
BATCH_BYTES = 4 << 20
# Rows of a thin table (ids or digests) that may be broadcast.
BROADCAST_ROWS = 1_000_000


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application
    (``addPyFile``), for sessions not started with ``--py-files``; and bound
    the rows and bytes of an Arrow batch, in a session that has not set them
    (the setting stays, since plans are run after the query is built)."""
    for key, default, bound in (("maxRecordsPerBatch", 10_000, BATCH_ROWS),
                                ("maxBytesPerBatch", 64 << 20, BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key).rstrip("b") == str(default):
            spark.conf.set(key, bound)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "library.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(frame: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back: the
    lineage is cut, and a lost executor costs no recomputation. The schema is
    given, so an empty table reads back too. A frame of bounded size goes into
    at most ``parts`` files."""
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    (frame if parts is None else frame.coalesce(parts)).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def row_key(text: str = "text") -> F.Column:
    """128-bit key of a row's id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                                  F.lit("|"), F.coalesce(F.col(text), F.lit("")))))


def without(frame: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """The rows of ``frame`` whose key is not in ``removed`` (a written table of
    keys). The removed ones are broadcast if they are few enough by their count,
    so wide rows stay where they are; else both sides are shuffled."""
    few = removed.count() <= BROADCAST_ROWS
    return frame.join(F.broadcast(removed) if few else removed, key, "left_anti")


def only(frame: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``frame`` joined with ``wanted`` (a written table, unique by key), the
    latter broadcast if it has few enough rows by its count."""
    few = wanted.count() <= BROADCAST_ROWS
    return frame.join(F.broadcast(wanted) if few else wanted, key)


def packed(frame: DataFrame, name: str = "doc") -> F.Column:
    """All columns of a frame as one struct, safe from name clashes."""
    return F.struct(*[frame[quoted(c)].alias(c) for c in frame.columns]).alias(name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unpacked(frame: DataFrame, columns: list[str], name: str = "doc") -> DataFrame:
    return frame.select(*[F.col(name).getField(c).alias(c) for c in columns])


def numbered(frame: DataFrame) -> DataFrame:
    """The frame with its columns named c0, c1, ...: what a Python function
    adds cannot clash with them."""
    return frame.toDF(*[f"c{k}" for k in range(len(frame.columns))])


def renamed_back(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)])


def fold(column: str, parts: int) -> F.Column:
    """crc32 of the id's text modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string")) % parts


def give_back_memory() -> None:
    """Return what a worker has freed to the system: workers live on between
    tasks, and a task's high-water mark would stay with them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # a C library without it
        pass


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = 1 << 20, max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches so that each has at most ``max_bytes`` of text (one
    longer text is a slice of its own) and at most ``max_rows`` rows."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(np.asarray(size, dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + max_bytes, side="right"))
            stop = min(max(stop, start + 1), start + max_rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    give_back_memory()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; NULL counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
