"""Direction signals on index series: states, win rates, selection and replay."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.checks import is_finite
from barloom.functions.recursion import trend_features
from barloom.operators.bootstrap import delta_intervals
from barloom.session import stage

SIGNALS = ("S1", "S2", "S3", "S4")
SIDES = (("LONG", 1), ("SHORT", -1))
CANDIDATE = ["ticker", "signal", "h", "side"]


def direction_states(series: DataFrame) -> DataFrame:
    """Per bar of each index series: position and the states S1 to S4 (1, -1 or 0)."""
    fields = ("date", "open", "high", "low", "close")
    arrays = (series.groupBy("ticker")
              .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("bars")))
    arrays = arrays.withColumn("trend", trend_features("bars.high", "bars.low", "bars.close"))
    rows = arrays.select("ticker", F.posexplode(F.arrays_zip(
        "bars", F.col("trend.hist").alias("hist"), F.col("trend.prev_hist").alias("prev_hist"))))
    rows = rows.select("ticker", F.col("pos").alias("i"), F.col("col.bars.*"),
                       F.col("col.hist").alias("hist"), F.col("col.prev_hist").alias("prev_hist"))
    ordered = Window.partitionBy("ticker").orderBy("i")

    def mean(n):
        return F.when(F.col("i") >= n - 1, F.avg("close").over(ordered.rowsBetween(1 - n, 0)))

    cross = F.when((F.col("prev_hist") <= 0) & (F.col("hist") > 0), 1).when(
        (F.col("prev_hist") >= 0) & (F.col("hist") < 0), -1)
    # Crosses inside the warm-up must not seed the state.
    cross = F.when(F.col("i") >= K.SIGNAL_FIRST_INDEX["S1"], cross)
    rows = rows.select("ticker", "date", "i", "open", "close", mean(50).alias("m50"), mean(200).alias("m200"),
                       cross.alias("cross"))
    latest = F.last("cross", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    s1 = F.coalesce(latest, F.lit(0))
    s2 = F.coalesce(F.signum(F.col("close") - F.col("m50")).cast("int"), F.lit(0))
    s3 = F.coalesce(F.signum(F.col("m50") - F.col("m200")).cast("int"), F.lit(0))
    rows = rows.select("ticker", "date", "i", "open", "close", s1.alias("S1"), s2.alias("S2"), s3.alias("S3"))
    return rows.withColumn("S4", F.when((F.col("S1") != 0) & (F.col("S1") == F.col("S2")), F.col("S1"))
                           .otherwise(F.lit(0)))


def long_states(states: DataFrame) -> DataFrame:
    """States as rows: ticker, date, i, signal, state."""
    pairs = F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(K.SIGNAL_FIRST_INDEX[s]).alias("first"),
                               F.col(s).alias("state")) for s in SIGNALS])
    return states.select("ticker", "date", "i", F.inline(pairs))


def outcomes(states: DataFrame, segments: DataFrame) -> DataFrame:
    """Every eligible bar with its result, per signal, horizon and side.

    Entry is the next open, exit the close of the bar `h` bars after it. `won` is the
    base outcome, `fired` says whether the signal was on.
    """
    ordered = Window.partitionBy("ticker").orderBy("i")
    exits = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"exit_{h}").alias("exit"))
                      for h in K.SIGNAL_HORIZONS])
    sides = F.array(*[F.struct(F.lit(n).alias("side"), F.lit(v).alias("want")) for n, v in SIDES])
    priced = states.select("*", F.lead("open", 1).over(ordered).alias("entry"),
                           *[F.lead("close", 1 + h).over(ordered).alias(f"exit_{h}") for h in K.SIGNAL_HORIZONS])
    pairs = F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(K.SIGNAL_FIRST_INDEX[s]).alias("first"),
                               F.col(s).alias("state")) for s in SIGNALS])
    rows = (priced.join(F.broadcast(segments), "date")
            .select("ticker", "date", "i", "segment", "entry", F.inline(pairs), "exit_5", "exit_10", "exit_20")
            .filter((F.col("i") >= F.col("first")) & (F.col("entry") > 0) & is_finite(F.col("entry")))
            .select("ticker", "date", "segment", "entry", "signal", "state", F.inline(exits))
            .filter(is_finite(F.col("exit")))
            .select("ticker", "date", "segment", "entry", "exit", "signal", "state", "h", F.inline(sides)))
    won = F.when(F.col("want") > 0, F.col("exit") > F.col("entry")).otherwise(F.col("exit") < F.col("entry"))
    return rows.select("ticker", "signal", "h", "side", "segment", "date", won.cast("int").alias("won"),
                       (F.col("state") == F.col("want")).alias("fired"))


def _measures(fired: Column) -> list[Column]:
    return [F.count(F.when(fired, 1)).alias("n"), F.count(F.lit(1)).alias("benchmark_n"),
            F.avg(F.when(fired, F.col("won"))).alias("wr"), F.avg("won").alias("benchmark_wr")]


def win_rates(results: DataFrame, keys: list[str], fired: Column | None = None) -> DataFrame:
    fired = F.col("fired") if fired is None else fired
    return (results.groupBy(*keys).agg(*_measures(fired))
            .withColumn("delta", F.col("wr") - F.col("benchmark_wr")))


def _dated(results: DataFrame, keys: list[str], fired: Column) -> DataFrame:
    return results.groupBy(*keys, "date").agg(
        F.coalesce(F.sum(F.when(fired, F.col("won"))), F.lit(0)).alias("signal_sum"),
        F.count(F.when(fired, 1)).alias("signal_n"),
        F.sum("won").alias("base_sum"), F.count(F.lit(1)).alias("base_n"))


def candidates(states: DataFrame, results: DataFrame) -> DataFrame:
    """Every (ticker, signal, h, side, segment) with counts, rates and interval.

    The list is complete: combinations without an eligible bar appear with n = 0.
    """
    keys = CANDIDATE + ["segment"]
    options = [[F.lit(v) for v in values] for values in (
        SIGNALS, K.SIGNAL_HORIZONS, [s for s, _ in SIDES], ["IS", "FINAL_OOS"])]
    grid = states.select("ticker").distinct()
    for name, values in zip(("signal", "h", "side", "segment"), options):
        grid = grid.select("*", F.explode(F.array(*values)).alias(name))
    seed = F.format_string(K.DIRECTION_SEED, "ticker", "signal", F.col("h").cast("string"), "side", "segment")
    bands = delta_intervals(_dated(results, keys, F.col("fired")), keys, seed)
    rates = win_rates(results, keys)
    return (grid.join(rates, keys, "left").join(bands, keys, "left")
            .fillna(0, ["n", "benchmark_n"]))


def select_in_sample(table: DataFrame) -> DataFrame:
    """Best in-sample candidate of each side, with its out-of-sample twin and verdict."""
    enough = (F.col("wr") >= K.SELECT_MIN_WIN_RATE) & (F.col("ci_low") > 0)
    best = Window.partitionBy("side").orderBy(F.desc("wr"), F.desc("delta"), "ticker", "signal", "h")
    chosen = (table.filter((F.col("segment") == "IS") & enough)
              .withColumn("pick", F.row_number().over(best)).filter("pick = 1").drop("pick", "segment"))
    measures = ["n", "benchmark_n", "wr", "benchmark_wr", "delta", "ci_low", "ci_high"]
    twin = table.filter(F.col("segment") == "FINAL_OOS").select(
        *CANDIDATE, *[F.col(m).alias("oos_" + m) for m in measures])
    passed = F.coalesce((F.col("oos_wr") >= K.SELECT_MIN_WIN_RATE) & (F.col("oos_ci_low") > 0), F.lit(False))
    return chosen.join(twin, CANDIDATE).withColumn("pass", passed)


def emitted_dates(active: DataFrame, states: DataFrame, segments: DataFrame,
                  calendar_ticker: str) -> DataFrame:
    """Out-of-sample dates on which exactly one active side is on, with that side.

    `active`: side, ticker, signal, h - at most one row per side.
    """
    oos = segments.filter(F.col("segment") == "FINAL_OOS").select("date")
    dates = (states.filter(F.col("ticker") == calendar_ticker).select("date")
             .join(F.broadcast(oos), "date", "left_semi"))
    want = F.when(F.col("side") == "LONG", 1).otherwise(-1)
    on = (long_states(states).join(F.broadcast(active.select("side", "ticker", "signal")), ["ticker", "signal"])
          .filter(F.col("state") == want).join(F.broadcast(dates), "date", "left_semi"))
    return (on.groupBy("date").agg(F.count(F.lit(1)).alias("sides"), F.max("side").alias("side"))
            .filter("sides = 1").select("date", "side"))


def replay(active: DataFrame, states: DataFrame, results: DataFrame, segments: DataFrame,
           calendar_ticker: str) -> tuple[DataFrame, DataFrame]:
    """Metrics of each active side on its emitted dates, and those dates."""
    emitted = emitted_dates(active, states, segments, calendar_ticker)
    rows = (results.filter(F.col("segment") == "FINAL_OOS")
            .join(F.broadcast(active.select(*CANDIDATE)), CANDIDATE, "left_semi")
            .join(F.broadcast(emitted.withColumn("allowed", F.lit(True))), ["date", "side"], "left"))
    allowed = F.coalesce(F.col("allowed"), F.lit(False))
    seed = F.format_string(K.REPLAY_SEED, "side", "ticker", "signal", F.col("h").cast("string"))
    bands = delta_intervals(_dated(rows, CANDIDATE, allowed), CANDIDATE, seed)
    rates = win_rates(rows, CANDIDATE, allowed).join(bands, CANDIDATE, "left")
    metrics = active.select(*CANDIDATE).join(rates, CANDIDATE, "left").fillna(0, ["n", "benchmark_n"])
    return metrics, emitted


def replay_counts(emitted: DataFrame, states: DataFrame, segments: DataFrame,
                  calendar_ticker: str) -> DataFrame:
    """Dates per emitted side, dates with none, and coverage. Bounded by the calendar."""
    oos = segments.filter(F.col("segment") == "FINAL_OOS").select("date")
    dates = (states.filter(F.col("ticker") == calendar_ticker).select("date")
             .join(F.broadcast(oos), "date", "left_semi"))
    counted = dates.join(emitted, "date", "left").agg(
        F.count(F.when(F.col("side") == "LONG", 1)).alias("long_dates"),
        F.count(F.when(F.col("side") == "SHORT", 1)).alias("short_dates"),
        F.count(F.lit(1)).alias("total"))
    used = F.col("long_dates") + F.col("short_dates")
    return counted.select("long_dates", "short_dates", (F.col("total") - used).alias("none_dates"), "total",
                          F.coalesce(used / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0)).alias("coverage"))


def prune_by_replay(active: DataFrame, states: DataFrame, results: DataFrame, segments: DataFrame,
                    calendar_ticker: str) -> tuple[DataFrame, DataFrame]:
    """Two rounds: drop sides whose replay interval does not lie above zero.

    A round that drops nothing leaves the set as it is, so a second one changes nothing.
    Returns the online set and the per-round metrics. Each round's set is at most two rows.
    """
    rounds = None
    for number in (1, 2):
        metrics, _ = replay(active, states, results, segments, calendar_ticker)
        metrics = stage(metrics.select(F.lit(number).alias("round"), "*", (~F.coalesce(
            F.col("ci_low") > 0, F.lit(False))).alias("deleted")))
        rounds = metrics if rounds is None else rounds.unionByName(metrics)
        active = metrics.filter(~F.col("deleted")).select(*CANDIDATE)
    return active, rounds
