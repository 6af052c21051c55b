"""Exact duplicates by combining in three steps that no heavy text can overload.

1. Locally: every task groups the rows it has read by their text, so a text leaves a task once, however often it was read.
2. Salted: the groups of a heavy digest are dealt to SALTS merging groups by the task they come from; other digests have one.
3. Globally: the salts' winners of the heavy digests, at most SALTS rows a text, are merged.

Each step groups by the digest and by the whole text, so contents are compared in full. Rows then learn their class by
digest; where different texts turn out to share a digest, by digest and text.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import dropped, query, staged, table

#: Merging groups of a heavy digest.
SALTS = 64
#: A digest is heavy where it has this many copies and this share of all rows; so there are at most HEAVY heavy digests.
HEAVY_COPIES, HEAVY = 1000, 4096


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _classes(rows: DataFrame, salts: int, copies: int) -> DataFrame:
    """rows(id, text, digest) -> staged classes: digest, keep (largest id), size; one for each different text."""
    least = max(copies, -(-rows.count() // HEAVY))
    heavy = staged(rows.groupBy("digest").count().where(F.col("count") >= least).select("digest", F.lit(True).alias("heavy")), "heavy")
    salted = rows.withColumn("task", F.spark_partition_id()).join(F.broadcast(heavy), "digest", "left") \
        .withColumn("salt", F.when(F.col("heavy"), F.pmod("task", F.lit(salts)) + 1).otherwise(0))
    winners = staged(salted.groupBy("digest", "salt", "text").agg(F.max("id").alias("keep"), F.count("*").alias("size"))
                     .select("digest", "salt", F.when(F.col("salt") > 0, F.col("text")).alias("text"), "keep", "size"), "winners")
    merged = winners.where("salt > 0").groupBy("digest", "text").agg(F.max("keep").alias("keep"), F.sum("size").alias("size"))
    found = staged(winners.where("salt = 0").select("digest", "keep", "size").union(merged.select("digest", "keep", "size")), "classes")
    dropped(heavy, winners)
    return found


def _decided(docs: DataFrame, normalised: Callable[[Column], Column], digest: Callable[[Column], Column], salts: int, copies: int, columns: list[str]) -> DataFrame:
    """A staged row for each of docs: doc (a struct of the columns), id, keep, size, sha, stays."""
    text = normalised(F.coalesce(F.col("text"), F.lit("")))
    source = docs.select(F.col("doc_id").alias("id"), text.alias("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
    rows = source.withColumn("digest", digest(F.col("text")))
    classes = _classes(rows.select("id", "text", "digest"), salts, copies)
    shared = staged(classes.groupBy("digest").count().where("count > 1").select("digest"), "shared")
    tail = [F.col("doc"), F.col("id"), F.sha2("text", 256).alias("sha"), F.col("digest")]
    repeated = classes.where("size > 1")
    if shared.isEmpty():
        out = rows.select(*tail).join(repeated, "digest", "left")
    else:
        out = rows.join(shared, "digest", "left_anti").select(*tail).join(repeated, "digest", "left")
        odd = rows.join(shared, "digest", "left_semi")
        by_text = staged(odd.groupBy("digest", "text").agg(F.max("id").alias("keep"), F.count("*").alias("size")), "texts")
        out = out.unionByName(odd.join(by_text, ["digest", "text"]).select("digest", *tail[:3], "keep", "size"))
    keep = F.when(F.col("size") > 1, F.col("keep")).otherwise(F.col("id"))
    out = staged(out.select(F.monotonically_increasing_id().alias("row"), "doc", "id", "sha", keep.alias("keep"), F.coalesce("size", F.lit(1)).cast("long").alias("size")), "decided")
    dropped(classes, shared)
    # rows that repeat the largest id of their class: the first of them stays
    top = F.col("id").eqNullSafe(F.col("keep"))
    tied = out.where(top & (F.col("size") > 1)).groupBy("sha", "keep").agg(F.count("*").alias("n"), F.min("row").alias("first")).where("n > 1")
    tied = staged(tied.select(F.col("sha").alias("tied_sha"), F.col("keep").alias("tied_keep"), "first"), "tied")
    if tied.isEmpty():
        return out.withColumn("stays", top)
    met = out.join(tied, (F.col("sha") == F.col("tied_sha")) & F.col("keep").eqNullSafe(F.col("tied_keep")), "left")
    return met.withColumn("stays", top & (F.col("first").isNull() | (F.col("first") == F.col("row"))))


def exact_duplicates(docs: DataFrame, normalised: Callable[[Column], Column] = lambda text: text, digest: Callable[[Column], Column] = _digest,
                     salts: int = SALTS, heavy_copies: int = HEAVY_COPIES) -> DataFrame:
    """docs(doc_id, text) -> a row for each: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when `normalised` makes them identical; by default nothing is changed. A null text counts as empty, and
    empty texts equal each other. keep_id is the largest doc_id of the equal texts, null ids being smallest; exactly one
    row of each group has `kept`: of rows that repeat the largest id, any one. An empty table gives an empty one. Other
    columns are not read. A text must fit a row of Spark (1 GB).
    """
    out = _decided(docs, normalised, digest, salts, heavy_copies, ["doc_id"])
    return out.select(F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), F.col("stays").alias("kept"), F.col("sha").alias("text_sha256"))


def without_exact_duplicates(docs: DataFrame, normalised: Callable[[Column], Column] = lambda text: text, **settings) -> DataFrame:
    """The rows that stay, one of each group of equal texts, with all their columns."""
    settings = {"digest": _digest, "salts": SALTS, "copies": HEAVY_COPIES} | settings
    return _decided(docs, normalised, columns=docs.columns, **settings).where("stays").select("doc.*")


@query("op11_exact", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       coalesce(doc_id = max(doc_id) OVER same, true) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op11_exact(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
