"""Incremental processing: the processed-dates ledger and run planning."""

from .ledger import (DatePlan, append_ledger, compact_ledger, plan_dates, plan_frame,
                     read_ledger, record_dates, record_plan, union_ledger)

__all__ = ["DatePlan", "append_ledger", "compact_ledger", "plan_dates", "plan_frame", "read_ledger",
           "record_dates", "record_plan", "union_ledger"]
