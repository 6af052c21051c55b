"""Mixing sources to target weights: repetition rates per source, then whole copies plus one hash-seeded draw."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WORD, query, staged, table, unit
from barloom.operators.ordering import with_running_total


def word_count(text):
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes(source, source_size, weight), a row per source -> the same with `target`.

    The sources share budget * all sizes by weight. A source's target stops at most * its size; what is above goes to
    the others by weight, until none is above. Only sums reach the driver: the level (target per weight) rises from
    round to round and each round stops at least one more source. All sizes 0: all targets 0.
    """
    def sums(level: float | None):
        full = F.lit(False) if level is None else F.col("source_size") * most <= F.lit(level) * F.col("weight")
        return sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)),
                         F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()

    total, _, weight = sums(None)
    level = budget * total / weight if weight else 0.0
    while True:
        _, stopped, weight = sums(level)
        higher = (budget * total - most * stopped) / weight if weight else level
        if higher <= level:
            break
        level = higher
    return sizes.withColumn("target", F.least(F.lit(level) * F.col("weight"), F.col("source_size") * F.lit(most)))


def with_copies(docs: DataFrame, targets: DataFrame, source: str = "source", key: str = "doc_id", seed: str = "mix") -> DataFrame:
    """docs with source_size, target and `copies`: floor(rate) plus one where the draw is below the fraction.

    rate = target / source_size. The draw hashes the key and the seed, so a rerun or a retried task decides alike; rows
    with the same key decide alike. The join is on the source with nulls equal; the side of the sources is one row each.
    """
    side = targets.select(F.col("source").alias("__source"), "source_size", "target")
    joined = docs.join(side, docs[source].eqNullSafe(side["__source"]), "left").drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return joined.withColumn("copies", (whole + F.when(unit(key, seed=seed) < rate - whole, 1).otherwise(0)).cast("long"))


def source_sizes(docs: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """(source, source_size); partial sums, so a source that holds most rows is no burden."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))


def cyclic_weights(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """sizes with weights dealt in turn to the sources by code point, null last; ranked over ranges, not in one task."""
    ranked = with_running_total(sizes, [F.col("source").asc_nulls_last()], name="__rank")
    dealt = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("__rank") - 1) % len(weights) + 1).cast("int"))
    return ranked.select("source", "source_size", dealt.alias("weight"))


def mix(docs: DataFrame, targets: DataFrame, source: str = "source", key: str = "doc_id", seed: str = "mix") -> DataFrame:
    """Each document as often as its copies say, with its own columns only.

    Null sources are a source of their own, null keys share one draw, repeated rows are mixed like others, an empty
    table gives an empty one. Columns of docs named source_size, target or copies are kept as they are.
    """
    names = docs.columns
    inner = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("__row"), F.col(f"`{source}`").alias("__s"), F.col(f"`{key}`").alias("__k"))
    counted = with_copies(inner, targets, "__s", "__k", seed).where("copies > 0")
    return counted.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy")).select("__row.*")


SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sources
), levels AS (
  SELECT 0 AS step, CAST(1.5 AS DOUBLE) * CAST(sum(source_size) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) AS level FROM weighed
  UNION ALL
  SELECT step + 1, higher FROM (
    SELECT l.step, l.level,
      (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) AS DOUBLE) - CAST(2 AS DOUBLE) * CAST(coalesce(sum(CASE WHEN 2.0::DOUBLE * source_size <= l.level * weight THEN source_size END), 0) AS DOUBLE))
      / CAST(sum(CASE WHEN NOT (2.0::DOUBLE * source_size <= l.level * weight) THEN weight END) AS DOUBLE) AS higher
    FROM levels l CROSS JOIN weighed GROUP BY l.step, l.level
  ) WHERE higher > level
), targets AS (
  SELECT source, source_size, least((SELECT max(level) FROM levels) * weight, 2.0::DOUBLE * source_size) AS target FROM weighed
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rated
"""


@query("op2_mixing", SQL)
def op2_mixing(spark, sf_dir):
    docs = staged(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    targets = source_targets(cyclic_weights(source_sizes(docs)))
    return with_copies(docs, targets).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
