"""Helpers shared by the operators of this package."""
from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import scratch_path

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_MEMORIES: dict[str, Callable[[], None]] = {}
_HOLDER = [""]


def give_back() -> None:
    """In a Python worker, return what is no longer used to the system: workers outlive the stage that filled them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def claim_memory(name: str, forget: Callable[[], None]) -> None:
    """In a Python worker, let one operator at a time remember words: what the others kept is forgotten."""
    if _HOLDER[0] != name:
        _MEMORIES[name] = forget
        for other, clear in _MEMORIES.items():
            if other != name:
                clear()
        _HOLDER[0] = name
        give_back()


def query(name: str, sql: str | None = None):
    """Register a query of this package, with its SQL where there is one."""
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str = "step") -> DataFrame:
    """The rows, written once to the shared folder and read again: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete what `staged` wrote, once nothing reads it any more."""
    for frame in frames:
        if path := getattr(frame, "_staged_at", None):
            delete(frame.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def unit(*columns, seed: str):
    """A number in [0, 1) that depends on the values and the seed only; SQL engines with md5 give the same."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of the undirected edges (u, v), the smallest node that it reaches.

    Rounds of hooking to the smallest neighbour's label, then jumping to the label's label. Each round is a few joins
    and grouped minima over all edges, is written to the shared folder, and only a count of changes reaches the driver.
    A node with very many edges meets sort-merge joins of two plain tables, which adaptive execution splits.
    """
    both = staged(edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select(F.col("v"), F.col("u"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    while True:
        near = staged(both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")), "near")
        met = staged(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low")), "met")
        roots = staged(met.groupBy("label").agg(F.min("low").alias("root")), "roots")
        hooked = staged(met.join(roots, "label").select("node", F.col("label").alias("old"), F.least("low", "root").alias("label")), "hooked")
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        fresh = staged(hooked.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        changed = fresh.where("label <> old").limit(1).count()
        dropped(labels, near, met, roots, hooked)
        labels = fresh
        if not changed:
            dropped(both)
            return labels.select("node", F.col("label").alias("component"))
