"""Arriving bar files as a stream into the daily store."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.compose import effective_bars
from barloom.sources.documents import bar_parts, older_parts
from barloom.sinks.stores import append_daily


def ingest_bars(spark: SparkSession, arrivals: str, store: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Take in all files, under either suffix, that have arrived since the last run, then stop.

    The stream's checkpoint remembers files, the key check remembers bars: a file is read
    once, and a bar that comes again in another file is dropped; one that comes with other
    prices is written to `<store>-violations`. A batch that is retried
    after a failure finds its rows stored and adds none. Late dates go to their own date.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    arriving = bar_parts(reader, arrivals).unionByName(older_parts(reader, arrivals)).drop("file_path")

    def take_in(batch: DataFrame, batch_id: int) -> None:
        wrong = append_daily(effective_bars(batch), store)
        wrong.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(store.rstrip("/") + "-violations")

    query = (arriving.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
