"""Adverse and favourable excursions after an anchor bar."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import contracts as K

LONGEST = max(K.EXCURSION_HORIZONS)
TILE = 64  # at least LONGEST, so the bars after an anchor lie in its tile or the next


def excursions(anchors: DataFrame, bars: DataFrame) -> DataFrame:
    """Per anchor and horizon: worst and best move, their days, final return, capture.

    `anchors` may carry signal_date, entry_date, entry_price and direction; every anchor
    row gives one result row, errors included (status). Bars are cut into tiles of 64
    positions that also hold the following tile, and anchors meet the tile of their own
    bar: neither a security with many anchors nor one with many bars lands in one group.
    """
    ordered = Window.partitionBy("security_id").orderBy("date")
    placed = bars.select("security_id", "date", "high", "low", "close",
                         (F.row_number().over(ordered) - 1).alias("pos"))
    tile = F.floor(F.col("pos") / TILE)
    bar = F.struct("pos", "high", "low", "close")
    tiles = (placed.select("security_id", F.explode(F.array(tile, tile - 1)).alias("tile"), bar.alias("bar"))
             .groupBy("security_id", "tile").agg(F.array_sort(F.collect_list("bar")).alias("reach")))
    asked = anchors.withColumn("anchor_date", F.coalesce("entry_date", "signal_date"))
    start = placed.select("security_id", F.col("date").alias("anchor_date"), "pos",
                          F.col("close").alias("anchor_close"))
    rows = asked.join(start, ["security_id", "anchor_date"], "left").withColumn("tile", tile)
    rows = rows.join(tiles, ["security_id", "tile"], "left")
    path = F.filter("reach", lambda b: (b["pos"] > F.col("pos")) & (b["pos"] <= F.col("pos") + LONGEST))
    price = F.coalesce("entry_price", "anchor_close")
    status = (F.when(F.col("anchor_date").isNull(), "ANCHOR_REQUIRED")
              .when(F.col("pos").isNull(), "ANCHOR_BAR_MISSING").when(price <= 0, "BAD_ENTRY_PRICE")
              .when(~F.coalesce("direction", F.lit("LONG")).isin("LONG", "SHORT"), "DIRECTION_REQUIRED"))
    rows = rows.select(*asked.columns, price.alias("price"), status.alias("status"), path.alias("path"))
    measured = [c for h in K.EXCURSION_HORIZONS for c in _horizon(h)]
    return rows.select(*asked.columns, "price", "status", *measured)


def _horizon(h: int) -> list[Column]:
    future = F.slice("path", 1, h)
    known = F.col("status").isNull() & (F.size("path") >= h)
    price, short = F.col("price"), F.col("direction") == "SHORT"
    # Ties: the first bar with the lowest low, the first with the highest high.
    low = F.array_min(F.transform(future, lambda b, k: F.struct(b["low"].alias("v"), (k + 1).alias("k"))))
    high = F.array_max(F.transform(future, lambda b, k: F.struct(b["high"].alias("v"), (-k - 1).alias("k"))))
    final = F.element_at(future, -1)["close"]
    down, up, end = low["v"] / price, high["v"] / price, final / price
    mae = F.when(short, 1 - up).otherwise(down - 1)
    mfe = F.when(short, 1 - down).otherwise(up - 1)
    back = F.when(short, 1 - end).otherwise(end - 1)
    named = {f"mae_{h}": mae, f"mfe_{h}": mfe,
             f"days_to_mae_{h}": F.when(short, -high["k"]).otherwise(low["k"]),
             f"days_to_mfe_{h}": F.when(short, low["k"]).otherwise(-high["k"]),
             f"final_return_{h}": back, f"capture_{h}": F.when(mfe > 0, back / F.nullif(mfe, F.lit(0.0)))}
    return [F.when(known, value).alias(name) for name, value in named.items()]
