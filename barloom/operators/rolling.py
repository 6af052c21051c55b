"""Indicators carried from day to day: a security's state takes in new bars without its history."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.recursion import CARRIED, momentum_carried, momentum_of
from barloom.operators.indicators import TAIL, bar_arrays, measured


def _behind(state: Column, tail: Column, low: Column, fresh: Column) -> list[Column]:
    """The state's columns after the bars `fresh`."""
    bars = F.concat(tail, fresh)
    gone = F.greatest(F.size(bars) - TAIL, F.lit(0))
    return [F.slice(bars, gone + 1, TAIL).alias("bars"), F.least(low, F.array_min(F.slice(bars, 1, gone)["close"])).alias("older_low"),
            momentum_carried(state, fresh["close"]).alias("carried")]


def started(bars: DataFrame) -> DataFrame:
    """State of each security from its whole history: security_id, bars (the last TAIL), older_low, carried."""
    arrays = bar_arrays(bars)
    none = F.slice("bars", 1, 0)
    return arrays.select("security_id", *_behind(F.lit(None).cast(CARRIED), none, F.lit(None).cast("double"), F.col("bars")))


def last_date(state: DataFrame) -> Column:
    return F.element_at(state["bars"], -1)["date"]


def late_securities(state: DataFrame, fresh: DataFrame) -> DataFrame:
    """Securities with a bar that is not after the last one they hold: a late or a corrected date."""
    first = fresh.groupBy("security_id").agg(F.min("date").alias("first"))
    return first.join(state.select("security_id", last_date(state).alias("last")), "security_id").filter("first <= last").select("security_id")


def advanced(state: DataFrame, fresh: DataFrame) -> DataFrame:
    """The state behind fresh bars, all after what is held. Securities without fresh bars stay, unknown ones start."""
    joined = state.join(bar_arrays(fresh).select("security_id", F.col("bars").alias("fresh")), "security_id", "full")
    empty = F.slice(F.coalesce("fresh", "bars"), 1, 0)
    return joined.select("security_id", *_behind(F.col("carried"), F.coalesce("bars", empty), F.col("older_low"), F.coalesce("fresh", empty)))


def indicators_of(state: DataFrame) -> DataFrame:
    """What `latest_indicators` gives for the whole history, bit for bit."""
    return measured(state.select("security_id", "bars", F.col("carried.steps").alias("bar_count"), "older_low", momentum_of(F.col("carried")).alias("momentum")))
