"""Throughput on a larger tick set derived from the given events table.

    python scripts/scale_probe.py <scratch_dir> [copies] [sf_dir]

Writes ``copies`` copies of the event ticks (instrument ids made distinct
per copy) as Parquet once, then times the report and ticks-with-open/close
on it (noop sink, median of 3 after a warm-up).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from dailybars.operators import daily_ohlcv, ticks_with_open_close  # noqa: E402
from dailybars.plans.report import daily_report  # noqa: E402
from dailybars.session import build_session  # noqa: E402
from dailybars.sources.tables import event_ticks  # noqa: E402


def main():
    out = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    sf = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "16g"})
    path = f"{out}/ticks-x{copies}"
    if not os.path.exists(path):
        ticks = event_ticks(spark, sf)
        big = (ticks.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
               .withColumn("ISIN", F.concat_ws("-", "ISIN", F.col("copy").cast("string")))
               .drop("copy"))
        big.repartition(16).write.parquet(path)
    ticks = spark.read.parquet(path)
    n = ticks.count()

    def run(df):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    cases = {
        "daily_report": lambda: daily_report(spark.read.parquet(path), dt.date(2024, 1, 10)),
        "daily_ohlcv": lambda: daily_ohlcv(spark.read.parquet(path)),
        "ticks_with_open_close": lambda: ticks_with_open_close(spark.read.parquet(path)),
    }
    res = {}
    for name, build in cases.items():
        run(build())
        res[name] = round(statistics.median(run(build()) for _ in range(3)), 3)
    print(json.dumps({"ticks": n, "seconds": res,
                      "ticks_per_sec": {k: round(n / v) for k, v in res.items()}}))


if __name__ == "__main__":
    main()
