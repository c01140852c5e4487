"""Ledger: planning cases, appends, column checks, first run."""

import datetime as dt
import os

import pytest

from dailybars.errors import WrongLedgerError
from dailybars.streaming.ledger import (DatePlan, append_ledger, ledger_rows, plan_dates,
                                        plan_frame, read_ledger, record_dates, record_plan)

END = dt.date(2022, 3, 20)
RUN = dt.datetime(2022, 3, 20, 12, 0, 0)


def d(day):
    return dt.date(2022, 3, day)


def days(first, last):
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def write_ledger(path, header, rows, name="part-00000.csv"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


HEADER = ["source_date", "datetime_of_processing"]


@pytest.mark.parametrize("first, exp_min, exp_first", [
    (d(19), d(19), d(18)),
    (d(16), d(18), d(17)),
    (d(13), d(13), d(12)),
])
def test_plan_with_gap(spark, tmp, first, exp_min, exp_first):
    write_ledger(tmp, HEADER, [("2022-03-17", "2022-03-20"), ("2022-03-16", "2022-03-20")])
    plan = plan_dates(spark, tmp, first, END)
    assert plan.extract_date == exp_min
    assert plan.dates == days(exp_first, END)


def test_plan_complete_ledger_is_nothing_to_do(spark, tmp):
    write_ledger(tmp, HEADER, [("2022-03-20", "2022-03-20"), ("2022-03-19", "2022-03-20")])
    plan = plan_dates(spark, tmp, d(20), END)
    assert plan.extract_date == dt.date(2200, 1, 1)
    assert plan.dates == [] and plan.record_dates == []


def test_plan_without_ledger(spark, tmp):
    plan = plan_dates(spark, f"{tmp}/none", d(18), END)
    assert plan.extract_date == d(18)
    assert plan.dates == days(d(17), END)
    assert plan.record_dates == days(d(18), END)


def test_plan_past_the_end(spark, tmp):
    write_ledger(tmp, HEADER, [("2022-03-17", "2022-03-20")])
    assert plan_dates(spark, tmp, d(21), END).dates == []
    no_ledger = plan_dates(spark, f"{tmp}/none", d(21), END)
    assert no_ledger.extract_date == d(21) and no_ledger.dates == [END]
    assert no_ledger.record_dates == []


def test_plan_ledger_without_date_column_raises_key_error(spark, tmp):
    write_ledger(tmp, ["wrong_column", "datetime_of_processing"], [("2022-03-17", "2022-03-20")])
    with pytest.raises(KeyError):
        plan_dates(spark, tmp, d(19), END)


def test_plan_malformed_ledger_date_raises(spark, tmp):
    write_ledger(tmp, HEADER, [("2022-0317", "2022-03-20")])
    with pytest.raises(Exception, match="malformed date"):
        plan_dates(spark, tmp, d(19), END)


def test_plan_frame_agrees_with_plan(spark, tmp):
    write_ledger(tmp, HEADER, [("2022-03-17", "2022-03-20"), ("2022-03-16", "2022-03-20")])
    ledger = read_ledger(spark, tmp)
    for first in (d(13), d(16), d(19), d(20)):
        plan = plan_dates(spark, tmp, first, END)
        rows = plan_frame(spark, ledger, first, END).orderBy("day").collect()
        assert [r["day"] for r in rows] == plan.dates
        assert {r["extract_date"] for r in rows} <= {plan.extract_date}
    assert plan_frame(spark, None, d(18), END).count() == 4


def test_plan_reads_duplicates_and_other_column_order(spark, tmp):
    write_ledger(tmp, ["datetime_of_processing", "source_date"],
                 [("2022-03-20", "2022-03-17"), ("2022-03-20", "2022-03-17")])
    write_ledger(tmp, HEADER, [("2022-03-18", "2022-03-21")], name="part-00001.csv")
    plan = plan_dates(spark, tmp, d(17), END)
    assert plan.extract_date == d(19)


def test_first_run_creates_ledger_with_text_kept(spark, tmp):
    path = f"{tmp}/ledger"
    assert record_dates(spark, path, ["2021-04-16", "202104-17"], RUN)
    got = read_ledger(spark, path).orderBy("source_date").collect()
    assert [r["source_date"] for r in got] == ["2021-04-16", "202104-17"]
    assert {r["datetime_of_processing"] for r in got} == {"2022-03-20 12:00:00"}


def test_empty_list_writes_nothing(spark, tmp):
    path = f"{tmp}/ledger"
    assert record_dates(spark, path, [], RUN) is False
    assert not os.path.exists(path)


def test_append_keeps_old_rows(spark, tmp):
    path = f"{tmp}/ledger"
    write_ledger(path, HEADER, [("2021-04-12", "2022-03-19 10:00:00"),
                                ("2021-04.13", "2022-03-19 10:00:00")])
    record_dates(spark, path, ["2021-04-16", "2021-04-17"], RUN)
    got = sorted(r["source_date"] for r in read_ledger(spark, path).collect())
    assert got == ["2021-04-12", "2021-04-16", "2021-04-17", "2021-04.13"]


def test_append_to_wrong_ledger_raises(spark, tmp):
    path = f"{tmp}/ledger"
    write_ledger(path, ["wrong_column", "datetime_of_processing"], [("2021-04-12", "x")])
    with pytest.raises(WrongLedgerError):
        record_dates(spark, path, ["2021-04-16"], RUN)


def test_record_plan_records_extract_date_to_end(spark, tmp):
    path = f"{tmp}/ledger"
    record_plan(spark, path, DatePlan(d(18), d(17), END), RUN)
    got = sorted(r["source_date"] for r in read_ledger(spark, path).collect())
    assert got == ["2022-03-18", "2022-03-19", "2022-03-20"]
    assert record_plan(spark, path, DatePlan(dt.date(2200, 1, 1), dt.date(2200, 1, 1), END),
                       RUN) is False


def test_ledger_rows_from_dates(spark):
    df = spark.createDataFrame([(d(18),)], "day date")
    r = ledger_rows(df, RUN).first()
    assert (r["source_date"], r["datetime_of_processing"]) == ("2022-03-18", "2022-03-20 12:00:00")


def test_append_ledger_rejects_nothing_on_empty(spark, tmp):
    path = f"{tmp}/ledger"
    empty = spark.createDataFrame([], "source_date string, datetime_of_processing string")
    assert append_ledger(spark, path, empty) is False
