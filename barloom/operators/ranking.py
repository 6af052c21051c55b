"""Cross-section of one date: relative strength, score, position and output parts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.operators.ordering import share_at_or_below, with_running_total


def relative_strength(snapshot: DataFrame) -> DataFrame:
    """Share of the universe with a 20-bar return at or below the security's own."""
    return share_at_or_below(snapshot, "return_20d", "relative_strength_20d")


def score(snapshot: DataFrame, as_of, price_gate: bool = True) -> DataFrame:
    """Filter verdict, its reason and the score; null score where the filter fails.

    `price_gate=False` is the fast path, which neither tests price validity nor names it.
    """
    ready = (F.col("ma_20").isNotNull() & F.col("dollar_volume_20d").isNotNull()
             & (F.col("trade_date") == F.lit(as_of).cast("date")))
    passed = (F.col("price_data_valid") & ready) if price_gate else ready
    reason = F.when(~passed, F.lit("SHORT_OR_STALE_HISTORY"))
    if price_gate:
        reason = F.when(~F.col("price_data_valid"), "INVALID_NONPOSITIVE_OHLC").otherwise(reason)
    liquidity = F.least(F.coalesce("dollar_volume_20d", F.lit(0.0)) / 1_000_000, F.lit(1.0))
    points = ((F.col("alignment") == "BULL").cast("int") * 2
              + F.col("bottom_confirmation").cast("int")
              + liquidity + F.coalesce("relative_strength_20d", F.lit(0.0)))
    return snapshot.select("*", passed.alias("filter_pass"), reason.alias("filter_reason"),
                           F.when(passed, points).alias("rank_score"),
                           F.lit("RESEARCH_ONLY").alias("rank_role"))


def rank(scored: DataFrame) -> DataFrame:
    """Position by score (best first, unscored last), then id; and the 250-row part."""
    order = [F.col("rank_score").desc_nulls_last(), F.col("security_id").asc()]
    ranked = with_running_total(scored, order, name="rank")
    return ranked.withColumn("part", F.expr(f"(rank - 1) div {K.RANK_PART_ROWS} + 1"))
