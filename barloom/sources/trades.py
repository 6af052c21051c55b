"""Roll individual trades up to bars.

Open and close are the prices at the smallest and largest (sequence, price), so trades that share a sequence number still
give one answer. Minima and maxima of pairs combine on the map side, whatever share of the trades one security holds;
Spark aggregates them by sorting inside each task, as pairs have no place in a hash aggregate's buffer.
"""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bars_from_trades(trades: DataFrame, keys: list[str]) -> DataFrame:
    """`trades` has the key columns, price (double, as it is), sequence and quantity."""
    at = F.struct("sequence", "price")
    rolled = trades.groupBy(*keys).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.sum("quantity").alias("volume"))
    return rolled.select(*keys, F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "volume")
