"""Indicators of each security at its last bar."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.checks import PRICES, is_finite, is_priced, ratio_change
from barloom.functions.recursion import momentum_last

BAR = ("date",) + PRICES + ("volume",)
DAY = "date"


def bar_arrays(bars: DataFrame) -> DataFrame:
    """One row per security: its bars in date order. One shuffle, on security_id."""
    return (bars.groupBy("security_id")
            .agg(F.array_sort(F.collect_list(F.struct(*BAR))).alias("bars")))


def session_index(calendar: DataFrame, name: str = "idx") -> DataFrame:
    """Dense 0-based position of each open date. A calendar is a bounded table."""
    return calendar.select(DAY).distinct().withColumn(
        name, (F.row_number().over(Window.orderBy(DAY)) - 1).cast("bigint"))


def _tail(values: Column, count: int) -> Column:
    size = F.size(values)
    return F.slice(values, F.greatest(size - count, F.lit(0)) + 1, count)


def _mean(values: Column, count: int) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / float(count)


def _moving_averages(close: Column) -> dict[str, Column]:
    size, last = F.size(close), F.element_at(close, -1)
    out: dict[str, Column] = {}
    for n in K.MOVING_AVERAGES:
        ma = F.when(size >= n, _mean(_tail(close, n), n))
        prior = F.when(size >= n + K.SLOPE_LAG,
                       _mean(F.slice(close, size - n - K.SLOPE_LAG + 1, n), n))
        out[f"ma_{n}"] = ma
        out[f"slope_{n}"] = F.when((prior > 0) & is_finite(prior), ma / prior - 1)
        out[f"price_vs_ma_{n}"] = ratio_change(last, ma)
    return out


def _low_distances(low: Column, close: Column) -> dict[str, Column]:
    size, last = F.size(low), F.element_at(close, -1)
    out = {}
    for n in K.LOW_WINDOWS:
        floor = F.array_min(_tail(low, n))
        usable = (size >= n) & is_finite(last) & (last > 0) & (floor > 0) & is_finite(floor)
        out[f"low_distance_{n}"] = F.when(usable, last / floor - 1)
    return out


def latest_indicators(bars: DataFrame) -> DataFrame:
    """Every indicator of every security at its last bar, from one grouping by security."""
    arrays = bar_arrays(bars)
    return measured(arrays.select("security_id", "bars", F.size("bars").cast("bigint").alias("bar_count"), F.lit(None).cast("double").alias("older_low"),
                                  momentum_last(F.col("bars.close")).alias("momentum")))


#: Bars that `measured` looks back on: the longest return needs one bar more than its window.
TAIL = max(K.YEAR_BARS, max(K.RETURN_WINDOWS) + 1, max(K.MOVING_AVERAGES) + K.SLOPE_LAG, max(K.LOW_WINDOWS)) + 2


def measured(arrays: DataFrame) -> DataFrame:
    """Indicators from (security_id, bars, bar_count, older_low, momentum).

    `bars` are a security's bars in date order, all of them or the last TAIL; `older_low` is the lowest close before them,
    `momentum` the recursive ones at the last bar.
    """
    close, low, high = F.col("bars.close"), F.col("bars.low"), F.col("bars.high")
    size = F.size("bars")
    last = F.element_at(close, -1)
    year = _tail(F.col("bars"), K.YEAR_BARS)
    first = arrays.select(
        "security_id", F.element_at("bars", -1)[DAY].alias("trade_date"), last.alias("close"),
        F.col("bar_count").cast("int").alias("bar_count"),
        F.forall(year, is_priced).alias("price_data_valid"),
        *[v.alias(k) for k, v in _moving_averages(close).items()],
        *[v.alias(k) for k, v in _low_distances(low, close).items()],
        F.array_max(_tail(high, K.YEAR_BARS)).alias("high_52w"),
        F.array_min(_tail(low, K.YEAR_BARS)).alias("low_52w"),
        F.coalesce(F.when(size >= 3, (F.element_at(close, -2) >= F.least("older_low", F.array_min(F.slice(close, 1, size - 2))))
                          & (last >= F.least("older_low", F.array_min(F.slice(close, 1, size - 1))))),
                   F.lit(False)).alias("no_new_low"),
        F.when(size >= 20, _mean(_tail(F.col("bars.volume"), 20), 20)).alias("volume_20d"),
        F.when(size >= 20, _mean(F.transform(_tail(F.col("bars"), 20),
                                             lambda b: b["close"] * b["volume"]), 20)
               ).alias("dollar_volume_20d"),
        *[F.when(size > n, ratio_change(last, F.element_at(close, -(n + 1)))).alias(f"return_{n}d")
          for n in K.RETURN_WINDOWS],
        "momentum.rsi14", "momentum.macd", "momentum.macd_signal",
        (F.col("momentum.macd") - F.col("momentum.macd_signal")).alias("macd_histogram"))

    valid = F.col("price_data_valid")
    truthy = F.lit(True)
    for n in K.MOVING_AVERAGES:
        truthy = truthy & F.coalesce(F.col(f"ma_{n}") != 0, F.lit(False))
    low_zone = F.coalesce(F.col("low_distance_60") <= 0.10, F.lit(False))
    spread = F.col("high_52w") - F.col("low_52w")
    confirmed = valid & F.col("no_new_low") & F.coalesce(F.col("close") > F.col("ma_20"), F.lit(False))
    return first.select(
        "*",
        F.when(truthy & (F.col("ma_20") > F.col("ma_50")) & (F.col("ma_50") > F.col("ma_200")), "BULL")
        .when(truthy & (F.col("ma_20") < F.col("ma_50")) & (F.col("ma_50") < F.col("ma_200")), "BEAR")
        .otherwise("MIXED_OR_SHORT").alias("alignment"),
        F.when(valid & (spread > 0), (F.col("close") - F.col("low_52w")) / F.nullif(spread, F.lit(0.0))
               ).alias("percentile_52w"),
        F.when(valid & (F.col("high_52w") > 0), ratio_change(F.col("close"), F.col("high_52w"))
               ).alias("drawdown_52w"),
        F.when(low_zone, "STAGE_LOW").otherwise("NONE").alias("bottom_structure"),
        confirmed.alias("bottom_confirmation"),
        F.when(low_zone & confirmed, "阶段低位，收盘确认").when(low_zone, "阶段低位，未确认")
        .otherwise("非阶段低位").alias("bottom_label"))


def benchmark_relative(bars: DataFrame, benchmark: DataFrame, lag: int = 20) -> DataFrame:
    """Last 20-step change of each security minus the benchmark's, over shared dates only.

    Needs more than `lag` shared dates. The benchmark is one series, so its size is bounded
    by the calendar and it is broadcast.
    """
    series = F.broadcast(benchmark.select(DAY, F.col("close").alias("benchmark_close")))
    newest = Window.partitionBy("security_id").orderBy(F.desc(DAY))
    aligned = (bars.select("security_id", DAY, "close").join(series, DAY)
               .withColumn("back", F.row_number().over(newest))
               .filter(F.col("back").isin(1, lag + 1)))

    def at(back, name):
        return F.max(F.when(F.col("back") == back, F.col(name)))

    return aligned.groupBy("security_id").agg(
        (ratio_change(at(1, "close"), at(lag + 1, "close"))
         - ratio_change(at(1, "benchmark_close"), at(lag + 1, "benchmark_close"))
         ).alias("relative_20d"))
