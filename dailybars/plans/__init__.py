"""Plans: the report transform and the batch job.

The job is ``plans.job`` (``python -m dailybars``); the registered queries
live in ``plans.catalog`` and their SQL in ``plans.oracle``.
"""

from .report import daily_report, report_schema

__all__ = ["daily_report", "report_schema"]
