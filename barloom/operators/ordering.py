"""Global order without a single task.

`row_number() over (order by ...)` without a partition sends every row to one task. Here
rows are range-partitioned on the order (Spark samples the boundaries), each range gets
its total, the totals (one row per range) are accumulated, and positions are formed
inside each range. The placed rows are staged so that both reads see the same ranges.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import stage


def with_running_total(df: DataFrame, order: list[Column], weight: Column | None = None,
                       name: str = "position", total: str | None = None) -> DataFrame:
    """Add the running total of `weight` (1 by default) in the given global order.

    The order must be total (no ties) for the result to be determined.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    placed = stage(df.withColumn("_weight", weight).repartitionByRange(*order)
                   .withColumn("_range", F.spark_partition_id()))
    sums = placed.groupBy("_range").agg(F.sum("_weight").alias("_sum"))
    ranges = Window.orderBy("_range")  # one row per range partition: a bounded table
    offsets = sums.select(
        "_range",
        (F.sum("_sum").over(ranges) - F.col("_sum")).alias("_before"),
        F.sum("_sum").over(Window.partitionBy(F.lit(1))).alias("_all"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = placed.join(F.broadcast(offsets), "_range").withColumn(
        name, F.sum("_weight").over(inside) + F.col("_before"))
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop("_range", "_weight", "_before", "_all")


def share_at_or_below(df: DataFrame, value: str, name: str) -> DataFrame:
    """Share of rows with a value that have one at or below their own; null stays null.

    Null with fewer than two values. Equal values are counted before anything is ordered,
    so a value shared by many rows is one row in the ordering. The input is read twice and
    therefore staged.
    """
    df = stage(df)
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_running_total(counts, [F.col(value).asc()], F.col("_n"), "_upto", "_total")
    shares = ranked.select(value, F.when(F.col("_total") > 1,
                                         F.col("_upto") / F.col("_total")).alias(name))
    return df.join(shares, value, "left")
