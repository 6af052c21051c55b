"""Indicators kept up to date: a run reads the new bars and the states they touch, not the history."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import rolling as RO
from barloom.operators.indicators import BAR
from barloom.session import stage
from barloom.sinks.ledger import Ledger, Write

#: Buckets of securities: a run reads and writes whole buckets. Some thousands suit a large universe.
BUCKETS = 64


def bucket_of(security: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.crc32(security.cast("binary")), F.lit(buckets)).cast("int")


def open_series(spark: SparkSession, root: str) -> Ledger:
    """The store: bars and states by bucket of the security."""
    return Ledger(spark, root, {"bars": "bucket", "states": "bucket"})


def take_in(series: Ledger, batch: str, fresh: DataFrame, buckets: int = BUCKETS) -> bool:
    """Take in bars (security_id, date, prices, volume; a key once) under a batch name; False where that was done before.

    A security whose fresh bars all follow what it holds goes on from its state. One with a late or corrected date is
    recomputed from its stored bars, of which fresh ones replace those of their date. States are read and replaced in the
    touched buckets only; stored bars are read only in the buckets of recomputed securities, and replaced there, while
    the bars of other buckets are added.
    """
    if batch in series.batches():
        return False
    fresh = stage(_placed(fresh.select("security_id", *BAR), buckets))
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    states = series.read("states", only=touched)
    if states is None:
        return series.commit(batch, {"bars": Write(fresh), "states": Write(_placed(RO.started(fresh), buckets))})
    late = stage(_placed(RO.late_securities(states, fresh), buckets))
    rewritten = [r.bucket for r in late.select("bucket").distinct().collect()]
    behind = RO.advanced(states.join(late, "security_id", "left_anti").drop("bucket"), fresh.join(late, "security_id", "left_anti"))
    bars = fresh
    if rewritten:
        kept = series.read("bars", only=rewritten).join(fresh.select("security_id", "date"), ["security_id", "date"], "left_anti")
        bars = stage(fresh.unionByName(kept))
        behind = behind.unionByName(RO.started(bars.join(late, "security_id", "left_semi")))
    return series.commit(batch, {"bars": Write(bars, emptied=tuple(rewritten)), "states": Write(_placed(behind, buckets), replace=True)})


def _placed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", bucket_of(F.col("security_id"), buckets))


def indicators(series: Ledger) -> DataFrame:
    """Indicators of every security at its last bar, from the states alone."""
    return RO.indicators_of(series.read("states"))
