"""Column names, formats and job parameters.

Every function in the package takes its column names from these frozen
dataclasses, so a source with other names only needs another instance.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values down to NA_WORDS: they must stay equal to the existing reports,
# ledgers and source files that this engine reads and writes. NA_WORDS are the
# words read as missing in CSV input (the pandas read_csv default list).
SOURCE_COLUMN_NAMES = (
    "ISIN", "Mnemonic", "Date", "Time", "StartPrice", "EndPrice",
    "MinPrice", "MaxPrice", "TradedVolume",
)
REPORT_COLUMN_NAMES = (
    "ISIN", "Date", "OpeningPriceEur", "ClosingPriceEur", "MinimumPriceEur",
    "MaximumPriceEur", "DailyTradedVolume", "ChangePrevClosing%",
)
LEDGER_DATE_COL = "source_date"
LEDGER_TIME_COL = "datetime_of_processing"
DATE_FORMAT = "yyyy-MM-dd"
NOTHING_TO_DO_DATE = dt.date(2200, 1, 1)
OUTPUT_FORMATS = ("csv", "parquet")
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


@dataclass(frozen=True)
class SourceColumns:
    """Names of the tick (intraday bar) columns."""

    isin: str = "ISIN"
    mnemonic: str = "Mnemonic"
    date: str = "Date"
    time: str = "Time"
    start_price: str = "StartPrice"
    end_price: str = "EndPrice"
    min_price: str = "MinPrice"
    max_price: str = "MaxPrice"
    traded_volume: str = "TradedVolume"
    # Columns kept by the projection step, in order.
    columns: tuple[str, ...] = SOURCE_COLUMN_NAMES

    @property
    def prices(self) -> tuple[str, ...]:
        return (self.start_price, self.end_price, self.min_price, self.max_price)


@dataclass(frozen=True)
class ReportColumns:
    """Names of the daily report columns."""

    isin: str = "ISIN"
    date: str = "Date"
    opening: str = "OpeningPriceEur"
    closing: str = "ClosingPriceEur"
    minimum: str = "MinimumPriceEur"
    maximum: str = "MaximumPriceEur"
    volume: str = "DailyTradedVolume"
    change: str = "ChangePrevClosing%"

    @property
    def ordered(self) -> tuple[str, ...]:
        return (self.isin, self.date, self.opening, self.closing, self.minimum,
                self.maximum, self.volume, self.change)

    @property
    def floats(self) -> tuple[str, ...]:
        return (self.opening, self.closing, self.minimum, self.maximum, self.change)


@dataclass(frozen=True)
class JobConfig:
    """Parameters of one report run (what the YAML file held before).

    ``source_root`` holds the trading dates' CSV files: everything below it
    whose first name starts with a date (``date_dir``, ``{date}`` is replaced
    by ``yyyy-MM-dd``), in folders at any depth or as flat files.
    ``target_root`` receives the reports; ``ledger_path`` the processed-dates
    ledger (a folder of CSV part files).
    """

    source_root: str
    target_root: str
    ledger_path: str
    first_extract_date: dt.date
    end_date: dt.date
    report_key: str = "report1/daily_report"
    report_format: str = "parquet"
    change_basis: str = "opening"
    # "per_run": a new folder per run, like the original job;
    # "by_date": one Date=... partition per day, rewritten on rerun.
    write_mode: str = "per_run"
    # Write the report globally ordered by (ISIN, Date) (one range exchange
    # that also serves the change window); False skips its sampling pass.
    ordered_output: bool = True
    # "csv": date folders of CSV files; "parquet": Parquet partitioned by Date.
    source_format: str = "csv"
    date_dir: str = "{date}"
    file_glob: str = "*"
    # Columns that order ticks of the same time, and whether times are ordered
    # as text (any text) instead of as numbers.
    tie_break: tuple[str, ...] = ()
    order_by_text: bool = False
    max_shuffle_partitions: int = 100_000
    # A run that finds more ledger part files than this compacts them (0: never).
    compact_ledger_after: int = 200
    # Hours after which the claim of a run that did not end is taken over.
    stale_claim_hours: float = 24.0
    csv_options: dict = field(default_factory=dict)
    source: SourceColumns = SourceColumns()
    report: ReportColumns = ReportColumns()
