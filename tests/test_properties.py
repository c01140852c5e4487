"""The report against a plain-Python brute force on random ticks."""

import datetime as dt
import math

import numpy as np
from hypothesis import HealthCheck, assume, given, settings
from hypothesis import strategies as st

from conftest import ticks_df
from dailybars.plans.report import daily_report

DATES = [dt.date(2021, 4, d) for d in (12, 13, 15, 16, 19)]
PRICES = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, 10.125, 20.21, 18.27, 0.005,
                                               99.995, 1234.565]))


@st.composite
def tick_sets(draw):
    n = draw(st.integers(min_value=0, max_value=40))
    # Distinct minutes overall, so no two ticks of a day share a time.
    minutes = draw(st.lists(st.integers(0, 24 * 60 - 1), min_size=n, max_size=n, unique=True))
    rows = []
    for m in minutes:
        isin = draw(st.sampled_from(["A", "B", "C", None]))
        date = draw(st.one_of(st.sampled_from(DATES), st.none()))
        time = None if draw(st.integers(0, 19)) == 0 else f"{m // 60:02d}:{m % 60:02d}"
        rows.append((isin, "M", None if date is None else date.isoformat(), time,
                     draw(PRICES), draw(PRICES), draw(PRICES), draw(PRICES),
                     draw(st.one_of(st.none(), st.integers(0, 10_000)))))
    return rows


def r2(x):
    return None if x is None else float(np.round(x, 2))


def brute_force(rows, extract, basis):
    groups = {}
    for r in rows:
        if r[0] is None or r[2] is None:
            continue
        groups.setdefault((r[0], dt.date.fromisoformat(r[2])), []).append(r)
    day = {}
    for key, ticks in groups.items():
        ordered = sorted(ticks, key=lambda r: (r[3] is None, r[3] or ""))
        starts = [r[4] for r in ordered if r[4] is not None]
        mins = [r[6] for r in ticks if r[6] is not None]
        maxs = [r[7] for r in ticks if r[7] is not None]
        vols = [r[8] for r in ticks if r[8] is not None]
        day[key] = [starts[0] if starts else None, starts[-1] if starts else None,
                    min(mins) if mins else None, max(maxs) if maxs else None, sum(vols)]
    out = []
    for isin in sorted({k[0] for k in day}):
        prev = None
        for date in sorted(d for i, d in day if i == isin):
            o, c, lo, hi, vol = day[(isin, date)]
            cur = o if basis == "opening" else c
            if cur is None or prev is None:
                change = None
            elif prev == 0:
                change = math.inf if cur > 0 else -math.inf if cur < 0 else None
            else:
                change = (cur - prev) / prev * 100
            prev = cur
            if extract is None or date >= extract:
                out.append((isin, date, r2(o), r2(c), r2(lo), r2(hi), vol, r2(change)))
    return out


def has_time_ties(rows):
    """Two priced ticks of one instrument-day without a time: their order,
    hence open/close, is undefined (the contract is one tick per time)."""
    seen = set()
    for r in rows:
        if r[3] is None and r[4] is not None:
            if (r[0], r[2]) in seen:
                return True
            seen.add((r[0], r[2]))
    return False


@settings(max_examples=20, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(rows=tick_sets(), extract=st.sampled_from([None, DATES[1], DATES[3]]),
       basis=st.sampled_from(["opening", "closing"]))
def test_report_matches_brute_force(spark, rows, extract, basis):
    assume(not has_time_ties(rows))
    got = [tuple(r) for r in daily_report(ticks_df(spark, rows), extract, basis).collect()]
    assert got == brute_force(rows, extract, basis)
