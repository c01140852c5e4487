"""Sources: CSV tick files, Parquet tables, file listings, the given tables."""

from .csv_ticks import date_folders, read_csv_by_name, read_ticks_csv, tick_types
from .files import (date_from_path, list_files, list_prefix, read_csv_table, read_parquet,
                    read_ticks_parquet)
from .tables import event_ticks, read_table, ticks_from_events

__all__ = [
    "date_folders", "read_csv_by_name", "read_ticks_csv", "tick_types",
    "date_from_path", "list_files", "list_prefix", "read_csv_table", "read_parquet",
    "read_ticks_parquet", "event_ticks", "read_table", "ticks_from_events",
]
