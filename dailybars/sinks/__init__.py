"""Sinks: report and table writers."""

from .writers import check_format, report_path, write_report, write_table

__all__ = ["check_format", "report_path", "write_report", "write_table"]
