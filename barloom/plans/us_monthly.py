"""Monthly recertification: index directions, stock baseline, and their agreement."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.operators import baseline as B
from barloom.operators import direction as D
from barloom.operators import sessions as S
from barloom.operators.compose import compose_bars, split_adjust
from barloom.operators.universe import active_securities
from barloom.session import stage


def monthly_bars(base: DataFrame, patch_rows: DataFrame, daily: DataFrame, splits: DataFrame,
                 securities: DataFrame, as_of) -> DataFrame:
    """Bars of the month's stock candidates: strictly active and no benchmark fund.

    Other than in the daily ranking the composed result is cut at `as_of`, corrections too.
    """
    active = active_securities(securities, default=False).filter(~F.col("ticker").isin(*K.BENCHMARK_TICKERS))
    bars = split_adjust(compose_bars(base, patch_rows, daily, wanted=active), splits)
    return bars.filter(F.col("date") <= F.lit(as_of).cast("date"))


@dataclass
class UsMonth:
    split: DataFrame
    candidates: DataFrame
    selected: DataFrame
    rounds: DataFrame
    online: DataFrame
    replay_metrics: DataFrame
    replay_counts: DataFrame
    baseline: DataFrame
    same_direction: DataFrame


def us_monthly(index_bars: DataFrame, stock_bars: DataFrame, lead_ticker: str) -> UsMonth:
    """`index_bars`: ticker, date, prices. `stock_bars`: bars of the active candidates.

    The index tables are a few tickers by 501 sessions and are staged between steps; the
    stock bars are shuffled once, by security, for all signals and baselines.
    """
    index_bars = stage(index_bars)
    calendar = index_bars.filter(F.col("ticker") == lead_ticker).select("date")
    window, split = S.last_window(calendar), S.split_us(calendar)
    segments = stage(S.day_segments(split))
    states = stage(D.direction_states(index_bars.join(F.broadcast(window.select("date")), "date", "left_semi")))
    results = stage(D.outcomes(states, segments))
    candidates = stage(D.candidates(states, results))
    selected = stage(D.select_in_sample(candidates))
    active = selected.filter("pass").select(*D.CANDIDATE)
    online, rounds = D.prune_by_replay(active, states, results, segments, lead_ticker)
    metrics, emitted = D.replay(online, states, results, segments, lead_ticker)
    emitted = stage(emitted)
    rows = B.stock_rows(stock_bars, segments)
    samples = B.signal_samples(rows)
    return UsMonth(split, candidates, selected, rounds, online, metrics,
                   D.replay_counts(emitted, states, segments, lead_ticker),
                   B.vertical_baseline(rows), B.same_direction(samples, emitted))


def us_pointer(month: UsMonth) -> DataFrame:
    """One row per side: the direction signal in force (or none), coverage and verdict."""
    verdicts = month.baseline.groupBy("side").agg(F.max("verdict").alias("vertical_baseline"))
    signal = F.concat_ws("|", "ticker", "signal", F.col("h").cast("string"))
    online = month.online.select("side", signal.alias("online"))
    coverage = month.replay_counts.select("coverage").scalar()
    return verdicts.join(online, "side", "left").select(
        "side", F.coalesce("online", F.lit(K.NO_SIGNAL)).alias("direction_signal"), coverage.alias("coverage"), "vertical_baseline")
