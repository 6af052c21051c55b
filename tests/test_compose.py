import datetime as dt
import re

import pytest

from barloom.operators.compose import compose_bars, base_daily_overlap, split_adjust
from tests.conftest import bar, bars_frame

D1, D2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
PATCH_DDL = ("security_id string, date date, open double, high double, low double, close double, volume double, "
             "adjustment_as_of date, accepted boolean, result string, path string, item int, position int")


def patches(spark, *rows):
    return spark.createDataFrame([r for r in rows], PATCH_DDL)


def closes(df):
    return {(r.security_id, r.date): r.close for r in df.collect()}


def test_accepted_correction_overrides_base_and_daily(spark):
    base = bars_frame(spark, [bar(D1, 100)])
    daily = bars_frame(spark, [bar(D2, 40)])
    fix = patches(spark, bar(D1, 110) + (True, "RESOLVED", "a", 0, 0), bar(D2, 50) + (True, "IDENTITY_FIXED", "a", 0, 1))
    assert closes(compose_bars(base, fix, daily)) == {("US-000001", D1): 110, ("US-000001", D2): 50}


def test_last_correction_wins_and_unaccepted_ones_do_not_count(spark):
    base = bars_frame(spark, [bar(D1, 100)])
    fix = patches(spark, bar(D1, 1) + (True, "RESOLVED", "a", 5, 0), bar(D1, 2) + (True, "RESOLVED", "b", 0, 0),
                  bar(D1, 3) + (False, "RESOLVED", "c", 0, 0), bar(D1, 4) + (True, "UNRESOLVED", "d", 0, 0))
    assert closes(compose_bars(base, fix, bars_frame(spark, []))) == {("US-000001", D1): 2}


def test_overlap_of_base_and_daily_is_reported_and_strict_stops(spark):
    base, daily = bars_frame(spark, [bar(D1, 100)]), bars_frame(spark, [bar(D1, 101), bar(D2, 102)])
    fix = patches(spark, bar(D1, 5) + (True, "RESOLVED", "a", 0, 0))
    assert [(r.security_id, r.date) for r in base_daily_overlap(base, daily).collect()] == [("US-000001", D1)]
    with pytest.raises(Exception, match="BASE_DAILY_OVERLAP"):
        compose_bars(base, fix, daily, strict=True).collect()


def test_split_is_applied_once(spark):
    rows = bars_frame(spark, [bar(D1, 110), bar(D2, 55, anchor=D2)])
    event = spark.createDataFrame([("US-000001", D2, 2.0)] * 2, "security_id string, effective_date date, factor double")
    out = {r.date: (r.close, r.volume) for r in split_adjust(rows, event).collect()}
    assert out == {D1: (55.0, 200.0), D2: (55.0, 100.0)}


def test_bad_split_factor_stops(spark):
    rows = bars_frame(spark, [bar(D1, 110)])
    event = spark.createDataFrame([("US-000001", D2, 0.0)], "security_id string, effective_date date, factor double")
    with pytest.raises(Exception, match="BAD_SPLIT_FACTOR"):
        split_adjust(rows, event).collect()


def test_bars_keep_prices_as_they_are(spark):
    from barloom.sources.trades import bars_from_trades
    rows = [("a", 1, 2.0e9, 1.0), ("a", 600_000_000_000, 5.0, 1.0), ("b", 1, 0.00004, 2.0), ("c", 3, 7.0, 1.0), ("c", 3, 6.0, 1.0)]
    got = {r.k: (r.open, r.high, r.low, r.close, r.volume) for r in bars_from_trades(spark.createDataFrame(rows, "k string, sequence long, price double, quantity double"), ["k"]).collect()}
    assert got == {"a": (2.0e9, 2.0e9, 5.0, 5.0, 2.0), "b": (0.00004,) * 4 + (2.0,), "c": (6.0, 7.0, 6.0, 7.0, 2.0)}


EVENT_DDL = "security_id string, effective_date date, factor double"


def test_many_splits_run_in_one_pass(spark):
    start, n = dt.date(1990, 1, 1), 10_000
    day = [start + dt.timedelta(days=i) for i in range(n)]
    factor = [2.0 if i % 2 else 0.5 for i in range(n)]
    rows = bars_frame(spark, [bar(d, 100, anchor=d) for d in day] + [bar(day[0], 100, "US-000002", anchor=day[n // 2])])
    events = spark.createDataFrame([(s, d, f) for s in ("US-000001", "US-000002") for d, f in zip(day, factor)], EVENT_DDL)
    out = split_adjust(rows, events)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect" not in plan and "Join" not in plan
    product, want = 1.0, {}
    for d, f in zip(reversed(day), reversed(factor)):
        want[("US-000001", d)] = 100 / product  # a bar comes before the events of its own day
        product *= f
    want[("US-000002", day[0])] = want[("US-000001", day[n // 2])]
    assert closes(out) == want


def test_splits_that_reach_no_bar_do_no_harm(spark):
    rows = bars_frame(spark, [bar(D2, 55, anchor=D2), bar(D1, 7, "US-000003", anchor=None)])
    events = spark.createDataFrame([("US-000001", D1, -1.0), ("US-000003", D2, 2.0), ("US-000009", D2, 0.0)], EVENT_DDL)
    assert closes(split_adjust(rows, events)) == {("US-000001", D2): 55.0, ("US-000003", D1): 7.0}


def test_adjusted_bars_stay_where_composition_put_them(spark):
    """One exchange a union branch: the window of the splits adds none to the bars."""
    base = bars_frame(spark, [bar(D1, 110)])
    events = spark.createDataFrame([("US-000001", D2, 2.0)], EVENT_DDL)
    out = split_adjust(compose_bars(base, patches(spark), bars_frame(spark, [bar(D2, 50)])), events)
    out.collect()
    from barloom.operators.indicators import bar_arrays
    plan = bar_arrays(out)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(security_id#\d+, ", plan)) == 4  # corrections and splits reduced, then bars and splits placed
    assert len(re.findall(r"Exchange hashpartitioning\(security_id#\d+, \d+\)", plan)) == 2
