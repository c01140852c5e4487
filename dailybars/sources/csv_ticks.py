"""CSV tick files of trading dates: ``<root>/<date>...``.

One scan over a glob replaces reading file by file. A date's files are all
files below ``root`` whose first name is the date, or the date followed by
something that is no digit: date folders at any depth, and flat files such as
``<date>_09.csv``. Any suffix counts (``file_glob`` can restrict names); names
that start with ``_`` or ``.`` are invisible to Spark. Rules (checked in the
tests):

* Every column is read as text, then the missing-value words become NULL and
  the typed columns are cast by name (Spark's CSV ``nullValue`` takes a single
  word). NaN prices become NULL, whole numbers may be written as decimals, and
  any other malformed value fails the job, whatever the ANSI setting.
* ``enforceSchema=False``: each file's header must equal the expected column
  list in order; a file with swapped columns fails instead of being read by
  position into the wrong columns.
* ``by_name=True`` handles header drift: files are grouped by header, each
  group is scanned with its own layout and the groups are unioned by name
  (a column missing in a group is NULL there). It costs a look at each file's
  beginning (``sources.layouts``), so it is off by default.
* ``encoding`` takes Python's and Spark's names. UTF-16 files are cut at their
  own two-byte line feeds and stay splittable; with ``utf-16`` each file's mark
  tells the order of its bytes. What cannot be read is refused before any work.
* Short rows keep their missing trailing fields as NULL; long rows fail, also
  when a query needs few columns or none: the parser always sees whole rows.
* No matching file gives an empty, typed frame.
* ``multi_line`` allows quoted line breaks but makes files unsplittable; keep
  it off for large files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NA_WORDS, SourceColumns
from ..functions import nan_to_null
from .files import date_from_path
from .layouts import WIDE, Layout, charset, csv_layouts, is_missing_path

_CORRUPT = "_corrupt_record"


def tick_types(src: SourceColumns = SourceColumns()) -> dict[str, T.DataType]:
    """Types of the known tick columns; any other column stays text."""
    types: dict[str, T.DataType] = {src.date: T.DateType(),
                                    src.traded_volume: T.LongType()}
    for p in src.prices:
        types[p] = T.DoubleType()
    return types


def tick_schema(columns: Sequence[str], types: Mapping[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(c, types.get(c, T.StringType()), True)
                         for c in columns])


_ANY_DATE = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"


def date_folders(root: str, dates: Sequence[dt.date] | None, date_dir: str = "{date}") -> str:
    """Glob of the dates' folders and flat files: ``root/{d1,d2,..}{,[^0-9]*}``.
    A name that goes on with a digit (``2021-04-170``) does not match, unlike
    a plain string prefix.

    It resolves with one listing of ``root``; Spark's file index then lists
    the matched folders in parallel (a distributed job beyond a few dozen
    folders). Names are selected with ``pathGlobFilter``."""
    names = _ANY_DATE if dates is None else (
        "{" + ",".join(sorted({d.isoformat() for d in dates})) + "}")
    return f"{root.rstrip('/')}/{date_dir.format(date=names)}{{,[^0-9]*}}"


def date_glob(root: str, dates: Sequence[dt.date] | None, date_dir: str = "{date}",
              file_glob: str = "*.csv") -> str:
    """Glob of the files in the dates' folders (for listings)."""
    return f"{date_folders(root, dates, date_dir)}/{file_glob}"


def _reader(spark: SparkSession, encoding: str, sep: str, multi_line: bool,
            file_glob: str | None = None):
    reader = (spark.read.option("header", True).option("encoding", encoding)
              .option("sep", sep).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"')
              .option("recursiveFileLookup", True))
    return reader.option("pathGlobFilter", file_glob) if file_glob else reader


def header_of(spark: SparkSession, paths: str | Sequence[str], encoding: str = "utf-8",
              sep: str = ",", file_glob: str | None = None,
              multi_line: bool = False) -> list[str] | None:
    """Column names from the header line of the first file (reads one line)."""
    try:
        return _reader(spark, encoding, sep, multi_line, file_glob).csv(paths).columns
    except AnalysisException as err:
        if is_missing_path(err):
            return None
        raise


def _field_count(row: Column, sep: str) -> Column:
    """Fields of a CSV row's text: separators outside quoted fields, plus one."""
    bare = F.regexp_replace(row, f'(^|\\Q{sep}\\E)"(?:[^"]|"")*"', "$1")
    rest = F.replace(bare, F.lit(sep), F.lit(""))
    return (F.length(bare) - F.length(rest)) / len(sep) + 1


def _cast(column: str, text: Column, data_type: T.DataType) -> Column:
    """Text to a type; a malformed value fails the job and is named."""
    if isinstance(data_type, T.StringType):
        return text
    error = F.when(text.isNotNull(), F.raise_error(F.concat(
        F.lit(f"malformed {data_type.simpleString()} in column {column}: "), text)))
    value = text.try_cast(data_type)
    if isinstance(data_type, T.IntegralType):
        # "877.0" is what a column with missing values is often written as.
        number = text.try_cast("decimal(38,6)")
        value = F.coalesce(value, F.when(number == F.floor(number), number.try_cast(data_type)))
    value = F.coalesce(value, error)
    return nan_to_null(value) if isinstance(data_type, T.FractionalType) else value


def _typed(raw: DataFrame, columns: Sequence[str], types: Mapping[str, T.DataType],
           sep: str, added: Mapping[str, Column]) -> DataFrame:
    """Fail on rows with extra fields, missing words to NULL, cast by name."""
    na = list(NA_WORDS)

    # A corrupt row is short (trailing fields NULL, allowed) or long. The check
    # is one filter, so no projection can prune it away; it names a column
    # besides the corrupt record, without which Spark refuses the query.
    corrupt = F.col(_CORRUPT)
    error = F.raise_error(F.concat(
        F.lit("CSV row has more fields than the header: "), corrupt,
        F.lit(" (first field "), F.coalesce(F.col(f"`{columns[0]}`"), F.lit("")), F.lit(")")))
    too_long = corrupt.isNotNull() & (_field_count(corrupt, sep) > len(columns))
    checked = raw.where(F.when(too_long, error).otherwise(F.lit(True)))

    def clean(c: str) -> Column:
        text = F.col(f"`{c}`")
        text = F.when(text.isin(na), F.lit(None)).otherwise(text)
        return _cast(c, text, types.get(c, T.StringType())).alias(c)

    return checked.select(*[clean(c) for c in columns],
                          *[value.alias(name) for name, value in added.items()])


def _raw_rows(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], name: str,
              sep: str, multi_line: bool, file_glob: str | None) -> DataFrame:
    """The files' rows as text, with the corrupt record, by Spark's CSV reader."""
    text_schema = T.StructType(
        [T.StructField(c, T.StringType(), True) for c in columns]
        + [T.StructField(_CORRUPT, T.StringType(), True)])
    # Without parser pruning every field of a row is seen, so a long row is
    # noticed whatever columns the query needs.
    return (_reader(spark, name, sep, multi_line, file_glob)
            .option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", _CORRUPT)
            .schema(text_schema).csv(paths))


def _wide_lines(spark: SparkSession, paths: str | Sequence[str], name: str,
                file_glob: str | None) -> DataFrame:
    """Decoded lines (column ``value``) of files whose line feed has two bytes.

    Splits are cut at the two bytes of a line feed. The same bytes may also be
    the halves of two neighbouring characters; such a cut leaves an odd number
    of bytes, which fails the job. Malformed text fails in ``decode``."""
    reader = (spark.read.option("encoding", name).option("lineSep", "\n")
              .option("recursiveFileLookup", True))
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    raw = F.col("value").cast("binary")
    torn = F.raise_error(F.concat(F.lit(f"a line is torn in its {name} text (the bytes of a line "
                                        "feed in other characters), use multi_line: "),
                                  F.col("_metadata.file_path")))
    text = F.decode(F.when(F.octet_length(raw) % 2 == 0, raw).otherwise(torn), name)
    lines = reader.text(paths).withColumn("value", F.rtrim(F.ltrim(text, F.lit("\ufeff")),
                                                           F.lit("\r")))
    return lines.where(F.col("value") != "")


def _wide_rows(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], name: str,
               sep: str, file_glob: str | None) -> DataFrame:
    """As ``_raw_rows`` for character sets with a two-byte line feed. A line
    that equals the header is one: its date could not be read as data."""
    fields = [f"f{k}" for k in range(len(columns))]
    schema = ", ".join(f"{f} string" for f in fields) + f", {_CORRUPT} string"
    row = F.from_csv("value", schema, {
        "sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT})
    header = F.lit(True)
    for f, c in zip(fields, columns):
        header &= F.col(f"row.{f}").eqNullSafe(F.lit(c))
    return (_wide_lines(spark, paths, name, file_glob).withColumn("row", row).where(~header)
            .withColumns({**{c: F.col(f"row.{f}") for f, c in zip(fields, columns)},
                          _CORRUPT: F.col(f"row.{_CORRUPT}")}))


def _scan(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
          types: Mapping[str, T.DataType], encoding: str, sep: str,
          multi_line: bool, file_glob: str | None = None,
          added: Mapping[str, Column] | None = None, files: Column | None = None) -> DataFrame:
    """One scan of the files that the metadata filter ``files`` selects;
    ``added`` columns may use the scan's ``_metadata``."""
    if encoding in WIDE and not multi_line:
        raw = _wide_rows(spark, paths, columns, encoding, sep, file_glob)
    else:
        raw = _raw_rows(spark, paths, columns, encoding, sep, multi_line, file_glob)
    if files is not None:
        raw = raw.where(files)
    return _typed(raw, columns, types, sep, added or {})


def empty_ticks(spark: SparkSession, columns: Sequence[str],
                types: Mapping[str, T.DataType]) -> DataFrame:
    return spark.createDataFrame([], tick_schema(columns, types))


def read_ticks_csv(spark: SparkSession, root: str, dates: Sequence[dt.date] | None = None,
                   *, date_dir: str = "{date}", file_glob: str = "*",
                   columns: Sequence[str] | None = None,
                   types: Mapping[str, T.DataType] | None = None,
                   src: SourceColumns = SourceColumns(), encoding: str = "utf-8",
                   sep: str = ",", multi_line: bool = False, by_name: bool = False,
                   with_source_date: bool = False) -> DataFrame:
    """Read the tick files of ``dates`` (all dates if None).

    ``columns``: the files' header, in order; read from one file if None.
    ``with_source_date`` adds ``source_date``, the date in the file's path.
    """
    encoding = charset(spark, encoding, multi_line)
    types = dict(types) if types is not None else tick_types(src)
    folders = date_folders(root, dates, date_dir)
    added = {"source_date": date_from_path("_metadata.file_path", date_dir, root)
             } if with_source_date else {}
    df = None
    if by_name:
        df = read_csv_by_name(spark, folders, types, encoding, sep, multi_line,
                              file_glob=file_glob, added=added)
    elif encoding in WIDE and not multi_line:
        layouts = csv_layouts(spark, folders, encoding, sep, file_glob)
        headers = {lay.columns for lay in layouts or ()} | ({tuple(columns)} if columns else set())
        if layouts and len(headers) > 1:
            raise ValueError(f"the files' headers differ, use by_name: {sorted(headers)}")
        df = read_csv_by_name(spark, folders, types, encoding, sep, layouts=layouts or [],
                              file_glob=file_glob, added=added)
    else:
        if columns is None:
            columns = header_of(spark, folders, encoding, sep, file_glob, multi_line)
        if columns:
            try:
                df = _scan(spark, folders, columns, types, encoding, sep, multi_line, file_glob,
                           added=added)
            except AnalysisException as err:
                if not is_missing_path(err):
                    raise
    if df is None:
        df = empty_ticks(spark, columns or list(src.columns), types)
        if with_source_date:
            df = df.withColumn("source_date", F.lit(None).cast("date"))
    return df


def read_csv_by_name(spark: SparkSession, paths: str, types: Mapping[str, T.DataType],
                     encoding: str = "UTF-8", sep: str = ",", multi_line: bool = False,
                     layouts: list[Layout] | None = None, file_glob: str | None = None,
                     added: Mapping[str, Column] | None = None,
                     within: Column | None = None) -> DataFrame | None:
    """One scan per header layout, unioned by column name; ``within`` selects
    files by their metadata."""
    if layouts is None:
        layouts = csv_layouts(spark, paths, encoding, sep, file_glob, within)
    if not layouts:
        return None

    def files(lay: Layout) -> Column | None:
        both = [c for c in (lay.selector(), within) if c is not None]
        return reduce(and_, both) if both else None

    frames = [_scan(spark, paths, lay.columns, types, encoding if multi_line else lay.charset, sep,
                    multi_line, file_glob, added=added, files=files(lay))
              for lay in layouts]
    from ..operators import union_by_name
    return union_by_name(frames)
