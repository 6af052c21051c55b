"""Indicators against plain loops over each security's bars."""
import datetime as dt
import math
import random

import pytest

from barloom.operators import indicators as I
from barloom.operators import ranking as R
from tests.conftest import bar, bars_frame, days


def mean(xs):
    return math.fsum(xs) / len(xs)


def seeded(xs, period):
    if len(xs) < period:
        return []
    out, weight = [mean(xs[:period])], 2 / (period + 1)
    for x in xs[period:]:
        out.append(weight * x + (1 - weight) * out[-1])
    return out


def strength(xs, period=14):
    if len(xs) <= period:
        return None
    moves = [b - a for a, b in zip(xs, xs[1:])]
    up, down = (mean([max(0, s * m) for m in moves[:period]]) for s in (1, -1))
    for m in moves[period:]:
        up, down = (up * 13 + max(0, m)) / 14, (down * 13 + max(0, -m)) / 14
    return (100.0 if up else 50.0) if down == 0 else 100 - 100 / (1 + up / down)


def expected(rows):
    c, lo, hi, v = ([r[i] for r in rows] for i in (5, 4, 3, 6))
    n, last = len(rows), c[-1]
    out = {}
    for k in (20, 50, 200):
        ma = mean(c[-k:]) if n >= k else None
        prior = mean(c[-k - 5:-5]) if n >= k + 5 else None
        out[f"ma_{k}"], out[f"slope_{k}"] = ma, ma / prior - 1 if prior and prior > 0 else None
        out[f"price_vs_ma_{k}"] = last / ma - 1 if ma else None
    for k in (20, 60, 120, 252):
        floor = min(lo[-k:])
        out[f"low_distance_{k}"] = last / floor - 1 if n >= k and last > 0 and floor > 0 else None
    year = rows[-252:]
    out["price_data_valid"] = valid = all(math.isfinite(x) and x > 0 for r in year for x in r[2:6])
    top, bottom = max(hi[-252:]), min(lo[-252:])
    out["percentile_52w"] = (last - bottom) / (top - bottom) if valid and top > bottom else None
    out["drawdown_52w"] = last / top - 1 if valid and top > 0 else None
    fast, slow = seeded(c, 12), seeded(c, 26)
    line = [a - b for a, b in zip(fast[14:], slow)]
    signal = seeded(line, 9)
    out["macd"], out["macd_signal"] = (line[-1] if line else None), (signal[-1] if signal else None)
    out["rsi14"] = strength(c)
    out["volume_20d"] = mean(v[-20:]) if n >= 20 else None
    out["dollar_volume_20d"] = mean([a * b for a, b in zip(c[-20:], v[-20:])]) if n >= 20 else None
    for k in (20, 60, 252):
        out[f"return_{k}d"] = last / c[-k - 1] - 1 if n > k and c[-k - 1] else None
    out["bottom_confirmation"] = bool(valid and n >= 3 and c[-2] >= min(c[:-2]) and c[-1] >= min(c[:-1])
                                      and out["ma_20"] is not None and last > out["ma_20"])
    return out


def test_every_indicator_matches_a_plain_loop(spark):
    rng = random.Random(7)
    rows, by_id = [], {}
    for k, n in enumerate((1, 2, 13, 14, 15, 20, 25, 26, 34, 60, 205, 260, 300)):
        sid, price, own = f"US-{k:06d}", 50.0, []
        for d in days(n):
            price = max(1.0, price + rng.choice((-1.5, -0.5, 0.0, 0.25, 1.25)))
            own.append((sid, d, price - 0.5, price + 1, price - 1 + (0 if k % 2 else 0.5), price, float(rng.randint(1, 900)), d))
        if n == 300:
            own[-5] = own[-5][:4] + (0.0,) + own[-5][5:]
        by_id[sid] = own
        rows += own
    rng.shuffle(rows)
    got = {r.security_id: r for r in I.latest_indicators(bars_frame(spark, rows)).collect()}
    for sid, own in by_id.items():
        for name, want in expected(own).items():
            have = getattr(got[sid], name)
            if isinstance(want, float):
                assert have == pytest.approx(want, abs=1e-9, rel=1e-12), (sid, name)
            else:
                assert have == want, (sid, name)


def test_bottom_needs_two_closes_above_running_lows(spark):
    rows = [bar(d, 100 if i < 18 else (90 if i == 18 else 110)) for i, d in enumerate(days(20))]
    later = rows + [bar(dt.date(2025, 1, 21), 112)]
    assert [r.bottom_confirmation for r in I.latest_indicators(bars_frame(spark, rows)).collect()] == [False]
    assert [r.bottom_confirmation for r in I.latest_indicators(bars_frame(spark, later)).collect()] == [True]


def test_missing_price_is_not_valid(spark):
    rows = [bar(d, 100) for d in days(30)]
    rows[-2] = rows[-2][:2] + (None,) + rows[-2][3:]
    row = I.latest_indicators(bars_frame(spark, rows)).first()
    assert row.price_data_valid is False and row.drawdown_52w is None


def test_score_order_and_unscored_last(spark):
    ddl = ("security_id string, trade_date date, ma_20 double, dollar_volume_20d double, return_20d double, "
           "alignment string, bottom_confirmation boolean, price_data_valid boolean")
    as_of = dt.date(2026, 10, 12)
    snapshot = spark.createDataFrame([
        ("HK-000002", dt.date(2026, 10, 9), 1.0, 1e3, -.1, "BEAR", False, True),
        ("HK-000001", as_of, 1.0, 1e6, .1, "BULL", True, True)], ddl)
    ranked = R.rank(R.score(R.relative_strength(snapshot), as_of)).orderBy("rank").collect()
    assert [(r.security_id, r.rank_score, r["rank"], r.part) for r in ranked] == [
        ("HK-000001", 5.0, 1, 1), ("HK-000002", None, 2, 1)]
    assert ranked[1].filter_reason == "SHORT_OR_STALE_HISTORY"


def test_strength_counts_ties_up_and_skips_nulls(spark):
    values = [None, 0.1, 0.1, -0.2, 0.5, None, 0.1]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "security_id string, return_20d double")
    got = {r.security_id: r.relative_strength_20d for r in R.relative_strength(df).collect()}
    assert got == {"0": None, "1": 0.8, "2": 0.8, "3": 0.2, "4": 1.0, "5": None, "6": 0.8}
    alone = spark.createDataFrame([("1", 0.3)], "security_id string, return_20d double")
    assert R.relative_strength(alone).first().relative_strength_20d is None


def test_global_positions_are_dense_and_ordered(spark):
    from pyspark.sql import functions as F
    from barloom.operators.ordering import with_running_total
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("v"))
    got = with_running_total(df, [F.col("v").asc()]).orderBy("v").collect()
    assert [r.position for r in got] == list(range(1, 5001))


def test_benchmark_needs_more_than_twenty_shared_dates(spark):
    stock = bars_frame(spark, [bar(d, 100 + i) for i, d in enumerate(days(25))])
    index = bars_frame(spark, [bar(d, 50) for d in days(25)][:20])
    assert I.benchmark_relative(stock, index).first().relative_20d is None
    index = bars_frame(spark, [bar(d, 50) for d in days(25)])
    assert I.benchmark_relative(stock, index).first().relative_20d == pytest.approx(124 / 104 - 1)
