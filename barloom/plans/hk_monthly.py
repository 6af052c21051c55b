"""Monthly trade-grid certification, long for all active and short for designated securities."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import sessions as S
from barloom.operators import trades as T
from barloom.session import stage


@dataclass
class HkMonth:
    split: DataFrame
    coverage: DataFrame
    grid: DataFrame
    summary: DataFrame


def hk_monthly(bars: DataFrame, calendar: DataFrame, shortable: DataFrame) -> HkMonth:
    """`bars`: active securities. `shortable`: security_id of active, designated ones.

    Features are computed once per security before the grid multiplies the (few) signals.
    """
    window, split = S.last_window(calendar), S.split_hk(calendar)
    segments = S.day_segments(split, S.HK_SEGMENTS)
    arrays = T.full_window(bars, window)
    ids = shortable.select("security_id").distinct().withColumn("may_short", F.lit(True))
    signals = T.signal_paths(arrays).join(ids, "security_id", "left")
    signals = signals.filter((F.col("side") == "LONG") | F.col("may_short")).drop("may_short")
    grid = stage(T.edge_grid(T.without_overlap(T.trade_outcomes(signals, segments))))
    return HkMonth(split, arrays.select("security_id"), grid, T.edge_summary(grid))
