"""Range shards of near-equal size from sampled splitters; DataFrame functions only."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import query, staged, table

#: Expected number of rows in a splitter sample; the drawn keys are the only thing that a splitter depends on.
SAMPLE = 16_384
#: First-level ranges for each shard.
RANGES_PER_SHARD = 16
#: A range above this many bytes is cut even where it is within its share, so that one task sorts a bounded range.
RANGE_BYTES = 256 << 20


def _drawn(rows: DataFrame, total: int, sample: int) -> DataFrame:
    """Rows drawn with probability in proportion to size, about `sample` in all; a larger row stands for its weight."""
    weight = F.col("__size") * float(sample) / float(max(total, 1))
    draw = F.pmod(F.xxhash64("__k1", "__k2", F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(draw < weight).withColumn("__weight", F.greatest(F.lit(1), F.round(weight)).cast("long"))


def _place(boundaries, key: str):
    """Number of boundaries at or below the key."""
    return F.size(F.filter(boundaries, lambda b: b <= F.col(key)))


def shard(rows: DataFrame, size, first_key, second_key, shards: int = 16, sample: int = SAMPLE, ranges: int | None = None,
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """rows with `shard` (0 to shards - 1) and `slot` (0, 1, ... within a shard), by the law `bytes`.

    size: bytes of a row, 1 or more. first_key, second_key: numbers whose pair orders the rows; rows with equal pairs may
    change places. A sample drawn in proportion to size gives quantile boundaries of the first key (`ranges` ranges). A
    range above its share, or above range_bytes, is cut at sampled quantiles of the second key, so a first key that holds
    a third of all rows is spread. Exact sums per range then give each row its place in the whole order and in the bytes
    before it: a row goes to the shard in which the middle of its bytes lies, so shards differ by one row's size at most.
    Splitters only place the work: other samples give other ranges, never overfull shards. Rows with the same pair of
    keys stay in one range. Null keys count as 0, null sizes as 1; an empty table gives an empty one. Columns named like
    the inner ones (leading __) are not allowed; `shard` and `slot` of the input are replaced.
    """
    ranges = ranges or shards * RANGES_PER_SHARD
    keyed = rows.withColumns({"__size": F.coalesce(size.cast("long"), F.lit(1)), "__k1": F.coalesce(first_key.cast("long"), F.lit(0)),
                              "__k2": F.coalesce(second_key.cast("long"), F.lit(0))})
    total = keyed.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    first = _drawn(keyed, total, sample).agg(F.percentile("__k1", shares, F.col("__weight")).alias("b")).first()["b"] or []
    boundaries = F.array(*[F.lit(float(x)) for x in sorted(set(first))]) if first else F.array().cast("array<double>")
    placed = keyed.withColumn("__range", _place(boundaries, "__k1"))
    # one row a range: at most `ranges` rows
    sums = placed.groupBy("__range").agg(F.sum("__size").alias("__bytes"), F.count("*").alias("__rows"))
    share = max(1, min(total // ranges, range_bytes))
    overfull = sums.where(F.col("__bytes") > 2 * share).select("__range", F.ceil(F.col("__bytes") / share).cast("int").alias("__parts"), "__bytes").collect()
    if overfull:
        wanted = F.create_map(*[F.lit(x) for r in overfull for x in (r["__range"], r["__parts"])])
        inner = placed.where(F.col("__range").isin([r["__range"] for r in overfull])).withColumn("__parts", wanted[F.col("__range")])
        drawn = _drawn(inner, sum(r["__bytes"] for r in overfull), 16 * sum(r["__parts"] for r in overfull))
        # a row for each overfull range, about 16 drawn keys for each of its parts
        seconds = drawn.groupBy("__range").agg(F.first("__parts").alias("__parts"), F.array_sort(F.collect_list("__k2")).alias("__s")).select(
            "__range", F.expr("transform(sequence(1, __parts - 1), i -> element_at(__s, int(greatest(1, ceil(i * double(size(__s)) / __parts)))))").alias("__second"))
        placed = placed.join(F.broadcast(seconds), "__range", "left").withColumn("__part", F.coalesce(F.when(F.col("__second").isNotNull(), _place(F.col("__second"), "__k2")), F.lit(0))).drop("__second")
    else:
        placed = placed.withColumn("__part", F.lit(0))
    parts = placed.groupBy("__range", "__part").agg(F.sum("__size").alias("__bytes"), F.count("*").alias("__rows"))
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # at most `ranges` rows
    within = Window.partitionBy("__range").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.groupBy("__range").agg(F.sum("__bytes").alias("__rb"), F.sum("__rows").alias("__rr")) \
        .select("__range", F.coalesce(F.sum("__rb").over(ahead), F.lit(0)).alias("__rb"), F.coalesce(F.sum("__rr").over(ahead), F.lit(0)).alias("__rr"))
    offsets = parts.join(whole, "__range").select(
        "__range", "__part", (F.col("__rb") + F.coalesce(F.sum("__bytes").over(within), F.lit(0))).alias("__bytes_before"),
        (F.col("__rr") + F.coalesce(F.sum("__rows").over(within), F.lit(0))).alias("__rows_before"))
    order = Window.partitionBy("__range", "__part").orderBy("__k1", "__k2")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = placed.withColumns({"__n": F.row_number().over(order), "__upto": F.sum("__size").over(running)}).join(offsets, ["__range", "__part"])
    middle = F.col("__bytes_before") + F.col("__upto") - F.col("__size") / 2.0
    done = staged(counted.withColumn("shard", F.least(F.floor(middle * shards / float(max(total, 1))), F.lit(shards - 1)).cast("int"))
                  .withColumn("__row", F.col("__rows_before") + F.col("__n") - 1), "sharded")
    starts = done.groupBy("shard").agg(F.min("__row").alias("__start"))  # a row a shard
    return done.join(F.broadcast(starts), "shard").withColumn("slot", F.col("__row") - F.col("__start")).select(
        *[c for c in rows.columns if c not in ("shard", "slot")], "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder for each shard, rows in slot order; a shard is written by one task for each of its runs of slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@query("op6_sharding")
def op6_sharding(spark, sf_dir):
    text = F.col("text")
    rows = staged(table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.xxhash64(text).alias("text_key")), "sizes")
    out = shard(rows, F.col("size"), F.col("text_key"), F.xxhash64("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
