import random

import pytest

from barloom.operators.excursions import excursions
from tests.conftest import bar, bars_frame, days

DDL = "security_id string, signal_date date, entry_date date, entry_price double, direction string"


def by_hand(rows, start, price, side, h):
    future = rows[start + 1:start + 1 + h]
    if len(future) < h:
        return None
    lows, highs, final = [r[4] for r in future], [r[3] for r in future], future[-1][5]
    low_at, high_at = lows.index(min(lows)), highs.index(max(highs))
    if side == "LONG":
        mae, mfe, back, bad, good = lows[low_at] / price - 1, highs[high_at] / price - 1, final / price - 1, low_at, high_at
    else:
        mae, mfe, back, bad, good = 1 - highs[high_at] / price, 1 - lows[low_at] / price, 1 - final / price, high_at, low_at
    return mae, mfe, bad + 1, good + 1, back, back / mfe if mfe > 0 else None


def test_rising_prices(spark):
    rows = [bar(d, 100 + i) for i, d in enumerate(days(61))]
    anchors = spark.createDataFrame([("US-000001", days(1)[0], None, None, "LONG")], DDL)
    row = excursions(anchors, bars_frame(spark, rows)).first()
    assert row.status is None and row.days_to_mfe_5 == 5 and row.final_return_5 == pytest.approx(.05)
    assert row.mae_60 is not None


def test_many_anchors_match_a_plain_loop(spark):
    rng, rows = random.Random(3), []
    for d in days(200):
        rows.append(bar(d, rng.choice((90.0, 95.0, 100.0, 105.0))))
    anchors = [("US-000001", d, None, rng.choice((None, 97.0)), rng.choice(("LONG", "SHORT"))) for d in days(200)]
    got = excursions(spark.createDataFrame(anchors, DDL), bars_frame(spark, rows)).collect()
    assert len(got) == 200
    at = {r[1]: i for i, r in enumerate(rows)}
    for row in got:
        price = row.entry_price if row.entry_price is not None else rows[at[row.signal_date]][5]
        for h in (5, 10, 20, 60):
            want = by_hand(rows, at[row.signal_date], price, row.direction, h)
            have = tuple(row[f"{n}_{h}"] for n in ("mae", "mfe", "days_to_mae", "days_to_mfe", "final_return", "capture"))
            if want is None:
                assert have == (None,) * 6
            else:
                assert have == pytest.approx(want)


def test_errors_become_status_rows(spark):
    rows = bars_frame(spark, [bar(d, 100) for d in days(10)])
    first, missing = days(1)[0], days(400)[-1]
    anchors = [("US-000001", None, None, None, "LONG"), ("US-000001", missing, None, None, "LONG"),
               ("US-000001", first, None, 0.0, "LONG"), ("US-000001", first, None, None, "UP"), ("US-000009", first, None, 1.0, "LONG")]
    got = excursions(spark.createDataFrame(anchors, DDL), rows).collect()
    assert sorted(r.status for r in got) == ["ANCHOR_BAR_MISSING", "ANCHOR_BAR_MISSING", "ANCHOR_REQUIRED",
                                             "BAD_ENTRY_PRICE", "DIRECTION_REQUIRED"]
