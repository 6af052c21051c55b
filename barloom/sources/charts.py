"""Provider chart payloads (parallel arrays) to bars and split events."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.checks import PRICES, is_finite
from barloom.operators.compose import later_factor

FIELDS = PRICES + ("volume",)


def _offset() -> Column:
    """Seconds from UTC: stated in the payload, else the market's default."""
    return F.coalesce(F.nullif(F.col("chart.gmtoffset"), F.lit(0).cast("bigint")),
                      F.when(F.col("market") == "HK", 8 * 3600).otherwise(-4 * 3600).cast("bigint"))


def _local_day(seconds: Column, offset: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor((seconds + offset) / 86400).cast("int"))


def hk_envelope() -> dict[str, Column]:
    """Hong Kong bars: a bar without trades takes its close; else high and low span all prices."""
    o, h, l, c = (F.col(p) for p in PRICES)
    idle = (F.col("volume") == 0) & (c > 0) & (F.least(o, h, l) <= 0)
    sound = ~idle & (F.least(o, h, l, c) > 0)
    return {"open": F.when(idle, c).otherwise(o),
            "high": F.when(idle, c).when(sound, F.greatest(o, h, l, c)).otherwise(h),
            "low": F.when(idle, c).when(sound, F.least(o, h, l, c)).otherwise(l)}


def chart_bars(payloads: DataFrame, calendar: DataFrame, as_of) -> DataFrame:
    """Bars out of chart payloads (security_id, market, chart).

    Rows with a missing or non-finite value are dropped; only open dates up to `as_of` stay.
    """
    series = F.arrays_zip(F.col("chart.timestamp").alias("ts"), *[F.col(f"chart.{f}").alias(f) for f in FIELDS])
    flat = payloads.select("security_id", "market", _offset().alias("offset"), F.explode(series).alias("x")).select(
        "security_id", "market", _local_day(F.col("x.ts"), F.col("offset")).alias("date"), *[F.col(f"x.{f}").alias(f) for f in FIELDS])
    complete = F.lit(True)
    for f in FIELDS:
        complete = complete & is_finite(F.col(f))
    kept = (flat.filter(complete & (F.col("date") <= F.lit(as_of).cast("date")))
            .join(F.broadcast(calendar.select("date").distinct()), "date", "left_semi"))
    hk = F.col("market") == "HK"
    fixed = {name: F.when(hk, value).otherwise(F.col(name)).alias(name) for name, value in hk_envelope().items()}
    return kept.select("security_id", "date", *[fixed.get(f, F.col(f)) for f in FIELDS],
                       F.lit(as_of).cast("date").alias("adjustment_as_of"))


def chart_splits(payloads: DataFrame) -> DataFrame:
    """Split events out of chart payloads; factors of zero or less are dropped."""
    flat = payloads.select("security_id", "ticker", _offset().alias("offset"), F.explode(F.map_values("chart.splits")).alias("s"))
    factor = F.coalesce("s.numerator", F.lit(0.0)) / F.greatest(F.lit(1.0), F.coalesce("s.denominator", F.lit(0.0)))
    return flat.filter((F.coalesce("s.date", F.lit(0)) != 0) & (factor > 0)).select(
        "security_id", _local_day(F.col("s.date"), F.col("offset")).alias("effective_date"), factor.alias("factor"), "ticker")


def undo_later_splits(bars: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Take out splits after `as_of` that the provider has already put into earlier bars."""
    later = events.filter(F.col("effective_date") > F.lit(as_of).cast("date"))
    due = later_factor(bars, later, F.col("date"))
    kept = [c for c in bars.columns if c not in FIELDS]
    return due.select(*kept, *[(F.col(p) * F.col("later_factor")).alias(p) for p in PRICES],
                      (F.col("volume") / F.col("later_factor")).alias("volume"))
