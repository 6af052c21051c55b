"""Daily ranking: compose, adjust, measure and order the active universe for one date."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.checks import PRICES
from barloom.operators.compose import compose_bars, split_adjust
from barloom.operators.excursions import excursions
from barloom.operators.indicators import latest_indicators
from barloom.operators.ranking import rank, relative_strength, score
from barloom.operators.universe import active_securities
from barloom.session import stage


@dataclass
class DailyRank:
    ranked: DataFrame
    excursions: DataFrame


def active_bars(base: DataFrame, patch_rows: DataFrame, daily: DataFrame, splits: DataFrame, securities: DataFrame, as_of) -> DataFrame:
    """Composed, adjusted bars of the active securities. Daily bars after `as_of` are left out; accepted corrections are
    not filtered by date."""
    known = daily.filter(F.col("date") <= F.lit(as_of).cast("date"))
    return split_adjust(compose_bars(base, patch_rows, known, wanted=active_securities(securities)), splits)


def indicator_snapshot(base: DataFrame, patch_rows: DataFrame, daily: DataFrame, splits: DataFrame,
                       securities: DataFrame, as_of) -> DataFrame:
    """Indicators of every active security."""
    return latest_indicators(active_bars(base, patch_rows, daily, splits, securities, as_of))


def daily_rank(base: DataFrame, patch_rows: DataFrame, daily: DataFrame, splits: DataFrame,
               securities: DataFrame, as_of) -> DataFrame:
    snapshot = indicator_snapshot(base, patch_rows, daily, splits, securities, as_of)
    return rank(score(relative_strength(snapshot), as_of))


def daily_rank_run(base: DataFrame, patch_rows: DataFrame, daily: DataFrame, splits: DataFrame, securities: DataFrame,
                   anchors: DataFrame, as_of) -> DailyRank:
    """The ranking, and the excursions of every anchor of a security that has bars, each with its status.

    `anchors`: security_id, signal_date, entry_date, entry_price, direction. The ranked rows say how many anchors the security
    has and how many could be measured. The bars are composed once and read for both.
    """
    bars = stage(active_bars(base, patch_rows, daily, splits, securities, as_of).select("security_id", "date", *PRICES, "volume"))
    snapshot = latest_indicators(bars)
    measured = stage(excursions(anchors.join(bars.select("security_id").distinct(), "security_id", "left_semi"), bars))
    counts = measured.groupBy("security_id").agg(F.count(F.lit(1)).alias("anchors"), F.count_if(F.col("status").isNull()).alias("measured"))
    ranked = rank(score(relative_strength(snapshot), as_of)).join(counts, "security_id", "left").fillna(0, ["anchors", "measured"])
    return DailyRank(ranked, measured)
