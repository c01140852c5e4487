"""Daily trading report engine on Spark.

Intraday trade bars (ticks) in, one row per instrument and day out: opening
and closing price, low, high, traded volume and percent change against the
previous trading day. Runs are planned from a ledger of processed dates.
"""

__version__ = "0.1.0"
