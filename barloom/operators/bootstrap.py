"""Reduce dated outcomes to block sums and attach bootstrap intervals."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.resampling import BlockDraws, delta_interval_udf, paired_intervals_udf


def _by_block(dated: DataFrame, keys: list[str], sums: list[str], cut: bool) -> DataFrame:
    """One row per key: its number of dates and, per block, the sums in block order.

    `dated` has one row per (keys, date), so a key's rows are bounded by the calendar.
    """
    ordered = Window.partitionBy(*keys).orderBy("date")
    size = K.BOOTSTRAP_BLOCK
    numbered = dated.select(
        "*", (F.row_number().over(ordered) - 1).alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("dates"))
    inside = (F.col("pos") % size) < (F.col("dates") % size)
    measures = [F.sum(c).cast("double").alias(c) for c in sums]
    if cut:
        measures += [F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0)).cast("double").alias("cut_" + c)
                     for c in sums]
    blocks = numbered.withColumn("block", F.expr(f"pos div {size}")).groupBy(*keys, "dates", "block").agg(*measures)
    names = [c for c in blocks.columns if c not in keys + ["dates"]]
    series = blocks.groupBy(*keys, "dates").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("blocks"))
    # Few small rows, but a thousand draws each: spread them instead of letting them be
    # coalesced into one task.
    return series.repartition(dated.sparkSession.sparkContext.defaultParallelism, *keys)


def delta_intervals(dated: DataFrame, keys: list[str], seed_key: Column) -> DataFrame:
    """Per key: ci_low, ci_high of mean(signal) - mean(base).

    `dated` columns: keys, date, signal_sum, signal_n, base_sum, base_n.
    """
    sums = ["signal_sum", "signal_n", "base_sum", "base_n"]
    blocks = _by_block(dated, keys, sums, cut=True)
    args = [seed_key, F.col("dates")] + [F.col(f"blocks.{c}") for c in sums + ["cut_" + c for c in sums]]
    return (blocks.withColumn("ci", delta_interval_udf(*args))
            .select(*keys, F.col("ci.low").alias("ci_low"), F.col("ci.high").alias("ci_high")))


def paired_intervals(samples: DataFrame, keys: list[str], seed_key: Column) -> DataFrame:
    """Per key: intervals of mean own, mean bench and their difference."""
    dated = samples.groupBy(*keys, "date").agg(
        F.sum("own").alias("own_sum"), F.sum("bench").alias("bench_sum"), F.count(F.lit(1)).alias("rows"))
    blocks = _by_block(dated, keys, ["own_sum", "bench_sum", "rows"], cut=False)
    args = [seed_key] + [F.col(f"blocks.{c}") for c in ("own_sum", "bench_sum", "rows")]
    out = blocks.withColumn("ci", paired_intervals_udf(*args))
    return out.select(*keys, *[F.col(f"ci.{n}.{e}").alias(f"{n}_{e}")
                               for n in ("own", "bench", "delta") for e in ("low", "high")])


def block_picks(series: DataFrame, hex_digits: int) -> DataFrame:
    """series(seed_key, blocks) -> (seed_key, draw, pos, block): the picks as rows, to be joined with sums of blocks."""
    drawn = BlockDraws(F.col("seed_key").outer(), F.lit(hex_digits), F.col("blocks").outer())
    return series.select("seed_key", F.col("blocks").cast("int").alias("blocks")).lateralJoin(drawn).select("seed_key", "draw", "pos", "block")
