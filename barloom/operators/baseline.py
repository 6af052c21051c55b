"""Stock signals against the leave-one-out mean of the whole cross-section."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.checks import is_finite, is_row_valid
from barloom.functions.recursion import trend_features
from barloom.operators.bootstrap import paired_intervals
from barloom.operators.indicators import bar_arrays
from barloom.session import stage

FORWARD = 20
SIDES = ("LONG", "SHORT")


def vertical_p(side: str, start: Column, end: Column) -> Column:
    """Move over the width, clipped to 0..1."""
    move = (end - start) if side == "LONG" else (start - end)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), move / (start * K.VERTICAL_WIDTH)))


def crossings(idx: Column, macd: Column, before: Column, e17: Column, e50: Column, hist: Column):
    """Long and short crossing of zero, confirmed by the averages and the histogram."""
    warm = idx >= K.TRADE_WARMUP
    up = warm & (macd > 0) & (before <= 0) & (e17 > e50) & (hist > 0)
    down = warm & (macd < 0) & (before >= 0) & (e17 < e50) & (hist < 0)
    return F.coalesce(up, F.lit(False)), F.coalesce(down, F.lit(False))


def stock_rows(bars: DataFrame, segments: DataFrame) -> DataFrame:
    """Bars of securities with a full history that have a valid bar 20 bars ahead."""
    arrays = bar_arrays(bars).filter(F.size("bars") >= K.WINDOW_SESSIONS)
    arrays = arrays.withColumn("trend", trend_features("bars.high", "bars.low", "bars.close"))
    ahead = F.slice("bars", FORWARD + 1, F.size("bars"))
    names = ("macd", "prev_macd", "hist", "e17", "e50")
    zipped = F.arrays_zip(F.col("bars").alias("bar"), ahead.alias("later"),
                          *[F.col(f"trend.{n}").alias(n) for n in names])
    rows = arrays.select("security_id", F.posexplode(zipped))
    rows = rows.select("security_id", F.col("pos").alias("i"), F.col("col.bar").alias("bar"),
                       F.col("col.later").alias("later"), *[F.col(f"col.{n}").alias(n) for n in names])
    rows = rows.filter(F.col("later").isNotNull() & is_row_valid(F.col("bar")) & is_row_valid(F.col("later")))
    start, end = F.col("bar.close"), F.col("later.close")
    up, down = crossings(F.col("i"), F.col("macd"), F.col("prev_macd"), F.col("e17"), F.col("e50"), F.col("hist"))
    rows = rows.select("security_id", F.col("bar.date").alias("date"), start.alias("start"), end.alias("end"),
                       vertical_p("LONG", start, end).alias("p_long"),
                       vertical_p("SHORT", start, end).alias("p_short"), up.alias("up"), down.alias("down"))
    return rows.join(F.broadcast(segments), "date")


def signal_samples(rows: DataFrame) -> DataFrame:
    """Crossing signals: security, date, segment, side, p and whether the direction was right."""
    picked = rows.filter((F.col("up") | F.col("down")) & is_finite(F.col("end")))
    return picked.select(
        "security_id", "date", "segment", F.when(F.col("up"), "LONG").otherwise("SHORT").alias("side"),
        F.when(F.col("up"), F.col("p_long")).otherwise(F.col("p_short")).alias("p"),
        F.when(F.col("up"), F.col("end") > F.col("start")).otherwise(F.col("end") < F.col("start"))
        .cast("int").alias("dwr"))


def leave_one_out(rows: DataFrame) -> DataFrame:
    """Each signal with the mean p of all other securities on its date.

    The totals are one row per date, so they are bounded by the calendar and broadcast;
    no signal meets another security's rows.
    """
    totals = rows.groupBy("date", "segment").agg(
        F.count(F.lit(1)).alias("count"), F.sum("p_long").alias("total_long"), F.sum("p_short").alias("total_short"))
    joined = signal_samples(rows).join(F.broadcast(totals), ["date", "segment"]).filter("count > 1")
    total = F.when(F.col("side") == "LONG", F.col("total_long")).otherwise(F.col("total_short"))
    return joined.select("security_id", "date", "segment", "side", F.col("p").alias("own"),
                         ((total - F.col("p")) / (F.col("count") - 1)).alias("bench"))


def vertical_baseline(rows: DataFrame) -> DataFrame:
    """Per side and segment: means, difference, intervals; and the verdict of the side."""
    keys = ["side", "segment"]
    paired = stage(leave_one_out(rows))  # signals only; read for the means and for the draws
    means = paired.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("own").alias("own"), F.avg("bench").alias("bench"),
        F.count_distinct("date").alias("unique_dates"))
    bands = paired_intervals(paired, keys, F.format_string(K.BASELINE_SEED, *keys))
    grid = rows.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in SIDES])).alias("side"))
    grid = grid.select("side", F.explode(F.array(F.lit("IS"), F.lit("FINAL_OOS"))).alias("segment"))
    table = (grid.join(means, keys, "left").join(bands, keys, "left").fillna(0, ["n", "unique_dates"])
             .withColumn("delta", F.col("own") - F.col("bench")))
    verdicts = table.groupBy("side").agg(
        F.max(F.when(F.col("segment") == "IS", F.col("delta"))).alias("is_delta"),
        F.max(F.when(F.col("segment") == "FINAL_OOS", F.col("delta_low"))).alias("oos_low"))
    verdict = F.when(F.col("oos_low") > 0, F.when(F.col("is_delta") > 0, "SIGNAL_EDGE_CONFIRMED")
                     .otherwise("OOS_ONLY")).otherwise("MARKET_DRIFT_ONLY")
    return table.join(verdicts.select("side", verdict.alias("verdict")), "side")


def same_direction(samples: DataFrame, emitted: DataFrame) -> DataFrame:
    """Out-of-sample signals split by the market direction of their date."""
    market = emitted.groupBy("date").agg(F.max("side").alias("market"))  # SHORT overrides LONG
    weight = F.when(F.col("side") == "LONG", K.DIRECTION_WEIGHT["LONG"]).otherwise(K.DIRECTION_WEIGHT["SHORT"])
    klass = (F.when(F.col("market") == F.col("side"), "SAME").when(F.col("market").isNotNull(), "OPPOSITE")
             .otherwise("NONE"))
    rows = (samples.filter(F.col("segment") == "FINAL_OOS").join(F.broadcast(market), "date", "left")
            .select("side", klass.alias("market_class"), (F.col("p") / weight - 1).alias("r"), "dwr"))
    measured = rows.groupBy("side", "market_class").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("r") > 0).cast("double")).alias("vertical_wr"),
        F.avg("r").alias("avg_r"), F.avg("dwr").alias("dwr"))
    grid = samples.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in SIDES])).alias("side"))
    grid = grid.select("side", F.explode(F.array(*[F.lit(c) for c in ("SAME", "OPPOSITE", "NONE")])).alias("market_class"))
    return grid.join(measured, ["side", "market_class"], "left").fillna(0, ["n"])
