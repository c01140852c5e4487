"""A hot instrument-day holding a third of all ticks."""

import contextlib
import datetime as dt

from pyspark.sql import functions as F

from conftest import explain_text
from dailybars.operators import daily_ohlcv, ticks_with_open_close
from dailybars.plans.report import daily_report
from dailybars.sources.tables import event_ticks

SF = "/root/testdata/sf0.01"
HOT_DAY = dt.date(2024, 1, 15)


def hot_ticks(spark):
    """Event ticks where every third event belongs to instrument HOT on one
    day (time of day kept, so the ticks stay ordered)."""
    t = event_ticks(spark, SF)
    hot = (F.col("StartPrice") * 100).cast("long") % 3 == 0
    return t.select(
        F.when(hot, F.lit("HOT")).otherwise(F.col("ISIN")).alias("ISIN"), "Mnemonic",
        F.when(hot, F.lit(HOT_DAY)).otherwise(F.col("Date")).alias("Date"),
        F.when(hot, F.to_timestamp_ntz(F.concat(F.lit("2024-01-15 "),
                                                F.date_format("Time", "HH:mm:ss.SSSSSS"))))
        .otherwise(F.col("Time")).alias("Time"),
        "StartPrice", "EndPrice", "MinPrice", "MaxPrice", "TradedVolume")


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def expected_open_close(ticks):
    pdf = ticks.toPandas().sort_values("Time", kind="mergesort")
    g = pdf.groupby(["ISIN", "Date"])["StartPrice"]
    return {k: (v.iloc[0], v.iloc[-1]) for k, v in g}


def test_hot_key_report_is_correct(spark):
    ticks = hot_ticks(spark)
    n_hot = ticks.where(F.col("ISIN") == "HOT").count()
    assert n_hot * 3 >= ticks.count() * 0.9
    exp = expected_open_close(ticks)
    for r in daily_ohlcv(ticks).collect():
        assert (r["OpeningPriceEur"], r["ClosingPriceEur"]) == exp[(r["ISIN"], r["Date"])]
    hot = daily_report(ticks).where(F.col("ISIN") == "HOT").collect()
    assert len(hot) == 1


def test_hot_key_aggregate_is_partial_before_shuffle(spark):
    plan = explain_text(daily_ohlcv(hot_ticks(spark)))
    assert "partial_min_by" in plan and "SortAggregate" not in plan


def test_hot_key_is_broadcast_and_spread(spark):
    ticks = hot_ticks(spark)
    # Small thresholds so HOT (about a third of the ticks) counts as hot.
    out = ticks_with_open_close(ticks, hot_rows=100, max_hot_keys=10, buckets=8, broadcast_bytes=0)
    rows = out.collect()
    plan = explain_text(out)
    assert "BroadcastHashJoin" in plan
    exp = expected_open_close(ticks)
    assert len(rows) == ticks.count()
    assert all((r["OpeningPrice"], r["ClosingPrice"]) == exp[(r["ISIN"], r["Date"])] for r in rows)


def test_hot_key_tasks_are_balanced(spark):
    ticks = hot_ticks(spark)
    out = ticks_with_open_close(ticks, hot_rows=100, max_hot_keys=10, buckets=64, broadcast_bytes=0)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.enabled": "false",
                        "spark.sql.shuffle.partitions": "8"}):
        # Use the attached columns, or the optimizer drops the joins.
        per_task = out.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n"), F.sum("OpeningPrice"), F.sum("ClosingPrice"))
        sizes = [r["n"] for r in per_task.collect()]
        n = ticks.count()
    # Without the split one partition would hold at least a third of the rows.
    assert max(sizes) < n / 3


def test_hot_and_cold_paths_agree_with_plain_join(spark):
    ticks = hot_ticks(spark)
    split = ticks_with_open_close(ticks, hot_rows=100, max_hot_keys=10, broadcast_bytes=0)
    plain = ticks_with_open_close(ticks, broadcast_bytes=0)     # nothing is hot here
    assert split.columns == plain.columns
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_keyless_ticks_are_spread(spark):
    t = event_ticks(spark, SF)
    third = (F.col("StartPrice") * 100).cast("long") % 3 == 0
    ticks = t.withColumn("ISIN", F.when(third, F.lit(None).cast("string")).otherwise(F.col("ISIN")))
    out = ticks_with_open_close(ticks, buckets=64, broadcast_bytes=0)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.enabled": "false",
                        "spark.sql.shuffle.partitions": "8"}):
        per_task = out.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n"), F.sum("OpeningPrice"), F.sum("ClosingPrice"))
        sizes = [r["n"] for r in per_task.collect()]
    n = ticks.count()
    assert sum(sizes) == n and max(sizes) < n / 3
    nulls = out.where(F.col("ISIN").isNull())
    assert nulls.count() > 0
    assert nulls.where(F.col("OpeningPrice").isNotNull() | F.col("ClosingPrice").isNotNull()).count() == 0


def test_small_day_table_is_broadcast_by_its_counted_size(spark):
    ticks = hot_ticks(spark)
    whole = ticks_with_open_close(ticks)
    plan = explain_text(whole)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    n_days = ticks.select("ISIN", "Date").distinct().count()
    for limit, split in ((n_days * 110, False), (n_days * 90, True)):
        plan = explain_text(ticks_with_open_close(ticks, broadcast_bytes=limit))
        assert ("_join_key" in plan) == split
    split = ticks_with_open_close(ticks, hot_rows=100, max_hot_keys=10, broadcast_bytes=0)
    assert split.exceptAll(whole).count() == 0 and whole.exceptAll(split).count() == 0
