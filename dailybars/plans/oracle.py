"""DuckDB SQL computing the same result as each registered query.

Runs on the given tables as views. Rounding is ``round_even(x*100, 0)/100``
(half to even on the scaled double, like ``rint``); percent change spells
out the zero cases because DuckDB gives NaN for 0/0 where the report has
NULL.
"""

from __future__ import annotations

TICKS = """
ticks AS (
  SELECT CAST(user_id AS VARCHAR) AS "ISIN", event_type AS "Mnemonic",
         CAST(ts AS DATE) AS "Date", ts AS "Time",
         value AS "StartPrice", value AS "EndPrice", value AS "MinPrice", value AS "MaxPrice",
         CAST(props->>'$.k' AS BIGINT) AS "TradedVolume"
  FROM events)"""

TEXT_TICKS = """
text_ticks AS (
  SELECT "ISIN", "Mnemonic", "Date", strftime("Time", '%H:%M:%S.%f') AS "Time",
         "StartPrice", "EndPrice", "MinPrice", "MaxPrice", "TradedVolume"
  FROM ticks)"""

DAY = """
day AS (
  SELECT "ISIN", "Date",
         arg_min("StartPrice", "Time") FILTER (WHERE "StartPrice" IS NOT NULL) AS o,
         arg_max("StartPrice", "Time") FILTER (WHERE "StartPrice" IS NOT NULL) AS c,
         min("MinPrice") AS lo, max("MaxPrice") AS hi,
         CAST(coalesce(sum("TradedVolume"), 0) AS BIGINT) AS vol
  FROM ticks WHERE "ISIN" IS NOT NULL AND "Date" IS NOT NULL
  GROUP BY "ISIN", "Date")"""

LINE_TICKS = """
line_ticks AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS "ISIN", CAST(l_shipdate AS DATE) AS "Date",
         l_extendedprice * (1 - l_discount) AS "MinPrice",
         l_extendedprice * (1 + l_tax) AS "MaxPrice",
         CAST(l_quantity AS BIGINT) AS "TradedVolume"
  FROM lineitem)"""

# Ledger of all days but the quiet ones (more than one standard deviation below the mean).
LEDGER = """
daily_n AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
ledger AS (
  SELECT strftime(day, '%Y-%m-%d') AS source_date,
         '2024-01-30 06:00:00' AS datetime_of_processing
  FROM daily_n WHERE n >= (SELECT avg(n) - stddev_samp(n) FROM daily_n)),
wanted AS (
  SELECT CAST(d AS DATE) AS day
  FROM generate_series(DATE '2024-01-10', DATE '2024-01-30', INTERVAL 1 DAY) g(d)),
missing AS (
  SELECT day FROM wanted
  WHERE day NOT IN (SELECT CAST(source_date AS DATE) FROM ledger)),
plan AS (
  SELECT CAST(d AS DATE) AS day, (SELECT min(day) FROM missing) AS extract_date
  FROM generate_series(DATE '2024-01-09', DATE '2024-01-30', INTERVAL 1 DAY) g(d)
  WHERE CAST(d AS DATE) >= (SELECT min(day) FROM missing) - INTERVAL 1 DAY)"""


def _round(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def _change(cur: str, prev: str, rounded: bool = True) -> str:
    body = _round(f"({cur} - {prev}) / {prev} * 100") if rounded \
        else f"({cur} - {prev}) / {prev} * 100"
    return (f"CASE WHEN {prev} IS NULL OR {cur} IS NULL THEN NULL "
            f"WHEN {prev} = 0 THEN CASE WHEN {cur} > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN {cur} < 0 THEN CAST('-inf' AS DOUBLE) END "
            f"ELSE {body} END")


def _report(from_date: str, basis: str = "o", order: bool = False) -> str:
    return f"""
WITH {TICKS}, {DAY},
w AS (SELECT *, lag({basis}) OVER (PARTITION BY "ISIN" ORDER BY "Date") AS prev
      FROM day WHERE "Date" >= DATE '{from_date}' - INTERVAL 1 DAY)
SELECT "ISIN", "Date",
       {_round('o')} AS "OpeningPriceEur", {_round('c')} AS "ClosingPriceEur",
       {_round('lo')} AS "MinimumPriceEur", {_round('hi')} AS "MaximumPriceEur",
       vol AS "DailyTradedVolume", {_change(basis, 'prev')} AS "ChangePrevClosing%"
FROM w WHERE "Date" >= DATE '{from_date}'
{'ORDER BY "ISIN", "Date"' if order else ''}"""


def _change_query(basis: str) -> str:
    return f"""
WITH {TICKS}, {DAY},
w AS (SELECT *, lag({basis}) OVER (PARTITION BY "ISIN" ORDER BY "Date") AS prev FROM day)
SELECT "ISIN", "Date", o AS "OpeningPriceEur", c AS "ClosingPriceEur",
       {_change(basis, 'prev')} AS "ChangePrevClosing%"
FROM w"""


ORACLE_SQL: dict[str, str] = {
    "daily_report": _report("2024-01-10"),
    "daily_report_csv": _report("2024-01-10"),
    "report_empty": _report("2030-01-02"),
    "list_prefix": f"""WITH {TICKS}
SELECT DISTINCT "Date" AS day FROM ticks WHERE strftime("Date", '%Y-%m-%d') LIKE '2024-01-1%'""",
    "extract_no_files": f"""WITH {TICKS}, {TEXT_TICKS}
SELECT * FROM text_ticks WHERE "Date" = DATE '2030-01-02'""",
    "scan_ticks": f"WITH {TICKS}, {TEXT_TICKS} SELECT * FROM text_ticks",
    "scan_ticks_utf16": f"WITH {TICKS}, {TEXT_TICKS} SELECT * FROM text_ticks",
    "extract_dates": f"""WITH {TICKS}, {TEXT_TICKS}
SELECT *, "Date" AS source_date FROM text_ticks
WHERE "Date" BETWEEN DATE '2024-01-09' AND DATE '2024-01-30'""",
    "extract_dates_parquet": f"""WITH {TICKS}
SELECT * FROM ticks WHERE "Date" BETWEEN DATE '2024-01-09' AND DATE '2024-01-30'""",
    "read_report": _report("2024-01-10"),
    "read_report_csv": _report("2024-01-10"),
    "project_ticks": f"""WITH {TICKS}
SELECT "ISIN", "Date", "Time", "StartPrice", "MaxPrice", "MinPrice", "EndPrice",
       "TradedVolume" FROM ticks""",
    "report_from_date": _report("2024-01-20"),
    "report_sorted": _report("2024-01-10", basis="c", order=True),
    "daily_ohlcv": f"""WITH {TICKS}, {DAY}
SELECT "ISIN", "Date", o AS "OpeningPriceEur", c AS "ClosingPriceEur",
       lo AS "MinimumPriceEur", hi AS "MaximumPriceEur", vol AS "DailyTradedVolume" FROM day""",
    "daily_ohlcv_tie_break": f"""WITH {TICKS}, hours AS (
  SELECT *, {{'t': date_trunc('hour', "Time"), 'p': "StartPrice"}} AS turn
  FROM ticks WHERE "ISIN" IS NOT NULL AND "Date" IS NOT NULL)
SELECT "ISIN", "Date",
       arg_min("StartPrice", turn) FILTER (WHERE "StartPrice" IS NOT NULL) AS "OpeningPriceEur",
       arg_max("StartPrice", turn) FILTER (WHERE "StartPrice" IS NOT NULL) AS "ClosingPriceEur",
       min("MinPrice") AS "MinimumPriceEur", max("MaxPrice") AS "MaximumPriceEur",
       CAST(coalesce(sum("TradedVolume"), 0) AS BIGINT) AS "DailyTradedVolume"
FROM hours GROUP BY "ISIN", "Date" """,
    "opening_price": f'WITH {TICKS}, {DAY} SELECT "ISIN", "Date", o AS "OpeningPriceEur" FROM day',
    "closing_price": f'WITH {TICKS}, {DAY} SELECT "ISIN", "Date", c AS "ClosingPriceEur" FROM day',
    "daily_low": f"""WITH {LINE_TICKS}
SELECT "ISIN", "Date", min("MinPrice") AS "MinimumPriceEur" FROM line_ticks
WHERE "ISIN" IS NOT NULL AND "Date" IS NOT NULL GROUP BY 1, 2""",
    "daily_high": f"""WITH {LINE_TICKS}
SELECT "ISIN", "Date", max("MaxPrice") AS "MaximumPriceEur" FROM line_ticks
WHERE "ISIN" IS NOT NULL AND "Date" IS NOT NULL GROUP BY 1, 2""",
    "daily_volume": f"""WITH {LINE_TICKS}
SELECT "ISIN", "Date", CAST(coalesce(sum("TradedVolume"), 0) AS BIGINT) AS "DailyTradedVolume"
FROM line_ticks WHERE "ISIN" IS NOT NULL AND "Date" IS NOT NULL GROUP BY 1, 2""",
    "change_opening_basis": _change_query("o"),
    "change_closing_basis": _change_query("c"),
    "ticks_with_open_close": f"""WITH {TICKS}, {DAY}
SELECT t.*, d.o AS "OpeningPrice", d.c AS "ClosingPrice"
FROM ticks t LEFT JOIN day d ON t."ISIN" = d."ISIN" AND t."Date" = d."Date" """,
    "union_ticks": f"""WITH {TICKS}, {TEXT_TICKS}
SELECT "ISIN",
       CASE WHEN "Date" < DATE '2024-01-16' THEN "Mnemonic" END AS "Mnemonic",
       "Date", "Time", "StartPrice",
       CASE WHEN "Date" < DATE '2024-01-16' THEN "EndPrice" END AS "EndPrice",
       "MinPrice", "MaxPrice", "TradedVolume", "Date" AS source_date
FROM text_ticks""",
    "ledger_union": f"""WITH {LEDGER}
SELECT source_date, datetime_of_processing FROM ledger
UNION ALL
SELECT strftime(day, '%Y-%m-%d'), '2024-01-31 06:00:00' FROM plan WHERE day >= extract_date""",
    "ledger_missing_dates": f"WITH {LEDGER} SELECT day FROM missing",
    "ledger_first_gap": f"WITH {LEDGER} SELECT min(day) AS first_gap FROM missing",
    "ledger_days": f"WITH {LEDGER} SELECT CAST(source_date AS DATE) AS day FROM ledger",
    "plan_dates": f"WITH {LEDGER} SELECT day, extract_date FROM plan",
    "plan_dates_no_ledger": """SELECT CAST(d AS DATE) AS day, DATE '2024-01-10' AS extract_date
FROM (SELECT max(CAST(ts AS DATE)) AS hi FROM events) b,
     generate_series(DATE '2024-01-09', b.hi, INTERVAL 1 DAY) g(d)""",
    "plan_dates_complete": """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
missing AS (
  SELECT CAST(d AS DATE) AS day
  FROM (SELECT max(day) AS hi FROM days) b,
       generate_series(DATE '2024-01-10', b.hi, INTERVAL 1 DAY) g(d)
  WHERE CAST(d AS DATE) NOT IN (SELECT day FROM days))
SELECT CAST(d AS DATE) AS day, (SELECT min(day) FROM missing) AS extract_date
FROM (SELECT max(day) AS hi FROM days) b,
     generate_series(DATE '2024-01-09', b.hi, INTERVAL 1 DAY) g(d)
WHERE CAST(d AS DATE) >= (SELECT min(day) FROM missing) - INTERVAL 1 DAY""",
    "ledger_noop": """SELECT strftime(day, '%Y-%m-%d') AS source_date,
       '2024-01-30 06:00:00' AS datetime_of_processing
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)""",
    "ledger_compacted": f"WITH {LEDGER} SELECT source_date, datetime_of_processing FROM ledger",
    "ledger_faults": f"""WITH {LEDGER}
SELECT l.ledger, l.fault, (SELECT count(*) FROM ledger) AS days FROM (VALUES
  ('as it is', 'none'), ('turned round', 'none'),
  ('renamed', 'missing: source_date; extra: wrong_column'), ('one more', 'extra: more'),
  ('one less', 'missing: datetime_of_processing')) l(ledger, fault)""",
    "scan_skips_empty_files": """SELECT CAST(ts AS DATE) AS source_date, count(*) AS n
FROM events GROUP BY 1""",
    "empty_write_leaves_nothing": """SELECT t.target, n > 0 AS wrote, n > 0 AS has_files
FROM (SELECT 'some' AS target, count(*) AS n FROM events WHERE ts >= DATE '2024-01-10'
      UNION ALL SELECT 'none', count(*) FROM events WHERE ts >= DATE '2030-01-02') t""",
    "wrong_format": f"""WITH {TICKS}, {DAY}
SELECT f.asked, f.fault, (SELECT count(*) FROM day WHERE "Date" >= DATE '2024-01-10') AS report_rows
FROM (VALUES ('csv', 'none'), ('parquet', 'none'), ('orc', 'wrong format'),
             ('orc, no rows', 'none')) f(asked, fault)""",
    "ledger_scan": f"WITH {LEDGER} SELECT source_date, datetime_of_processing FROM ledger",
    "etl_job": f"""WITH {TICKS}, {LEDGER},
gap AS (SELECT min(day) AS g FROM missing),
read AS (SELECT * FROM ticks
         WHERE "Date" >= (SELECT g FROM gap) - INTERVAL 1 DAY AND "Date" <= DATE '2024-01-30'),
day AS (
  SELECT "ISIN", "Date",
         arg_min("StartPrice", "Time") AS o, arg_max("StartPrice", "Time") AS c,
         min("MinPrice") AS lo, max("MaxPrice") AS hi,
         CAST(coalesce(sum("TradedVolume"), 0) AS BIGINT) AS vol
  FROM read GROUP BY "ISIN", "Date"),
w AS (SELECT *, lag(o) OVER (PARTITION BY "ISIN" ORDER BY "Date") AS prev FROM day)
SELECT "ISIN", "Date",
       {_round('o')} AS "OpeningPriceEur", {_round('c')} AS "ClosingPriceEur",
       {_round('lo')} AS "MinimumPriceEur", {_round('hi')} AS "MaximumPriceEur",
       vol AS "DailyTradedVolume", {_change('o', 'prev')} AS "ChangePrevClosing%"
FROM w WHERE "Date" >= (SELECT g FROM gap)""",
    "ledger_dates_to_record": f"""WITH {LEDGER}
SELECT strftime(day, '%Y-%m-%d') AS source_date,
       '2024-01-31 06:00:00' AS datetime_of_processing
FROM plan WHERE day >= extract_date""",
    "round_half_even": f"""SELECT l_orderkey, l_linenumber,
       {_round('l_extendedprice * (1 - l_discount) * (1 + l_tax)')} AS charge FROM lineitem""",
    "pct_change": f"""WITH {TICKS}, {DAY}
SELECT "ISIN", "Date", {_change('c', 'o')} AS intraday_change FROM day""",
    "parse_date": f"""WITH {LEDGER}
SELECT source_date, CAST(source_date AS DATE) AS day FROM ledger""",
    "format_date": """SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_text,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events""",
    "date_series": """SELECT CAST(d AS DATE) AS day FROM (
  SELECT min(CAST(ts AS DATE)) - INTERVAL 1 DAY AS lo, max(CAST(ts AS DATE)) AS hi FROM events) b,
  generate_series(b.lo, b.hi, INTERVAL 1 DAY) g(d)""",
}
