"""File listing and Parquet report reading."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])


def input_bytes(frame: DataFrame) -> int:
    """Bytes of the files that a frame scans, from its file indexes (nothing
    is listed again)."""
    leaves = frame._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size()))


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """(path, length, modificationTime) of every file matching ``glob``.

    ``binaryFile`` reads file contents only when ``content`` is selected, so
    this is a listing. No match gives an empty frame."""
    try:
        return (spark.read.format("binaryFile").load(glob)
                .select("path", "length", "modificationTime"))
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return spark.createDataFrame([], _LISTING)
        raise


def list_prefix(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Files whose path below ``root`` starts with ``prefix`` (object-store
    key prefix semantics: ``2021-04-17`` also matches ``2021-04-170/...``),
    with (path, length, modificationTime). Matched folders are listed
    recursively. No match gives an empty frame."""
    glob = f"{root.rstrip('/')}/{prefix}*"
    try:
        return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .load(glob).select("path", "length", "modificationTime"))
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return spark.createDataFrame([], _LISTING)
        raise


def date_from_path(path: str = "_metadata.file_path", date_dir: str = "{date}",
                   root: str | None = None) -> F.Column:
    """The ``yyyy-MM-dd`` date of a file: in the first name below ``root``
    (folder or flat file), or without ``root`` in the name of the file's
    folder, which starts with ``date_dir`` with ``{date}`` filled in. Plain
    string functions (no regular expression), since this runs once per row."""
    if root is None:
        name = F.substring_index(F.substring_index(F.col(path), "/", -2), "/", 1)
    else:
        below = "/" + root.split("://", 1)[-1].split(":", 1)[-1].strip("/") + "/"
        name = F.substring_index(F.substring_index(F.col(path), below, -1), "/", 1)
    start = date_dir.index("{date}") + 1
    return F.try_to_date(F.substring(name, start, 10), "yyyy-MM-dd")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV table with a header, checked against ``schema`` by name."""
    return (spark.read.option("header", True).option("enforceSchema", False)
            .option("quote", '"').option("escape", '"').schema(schema).csv(path))


def read_ticks_parquet(spark: SparkSession, root: str, dates=None,
                       date_col: str = "Date") -> DataFrame | None:
    """Ticks stored as Parquet partitioned by date (``root/Date=yyyy-MM-dd``).

    Only the folders of ``dates`` are globbed (with ``basePath``, so the date
    stays a partition column): the file index lists just those folders
    instead of the whole table. Columns are aligned by name over all files
    (``mergeSchema``), so a column that only some files have is kept. None
    when no folder matches."""
    reader = spark.read.option("basePath", root).option("mergeSchema", True)
    if dates is None:
        paths = f"{root.rstrip('/')}/{date_col}=*"
    else:
        names = ",".join(sorted({d.isoformat() for d in dates}))
        paths = f"{root.rstrip('/')}/{date_col}={{{names}}}"
    try:
        return reader.parquet(paths)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return None
        raise
