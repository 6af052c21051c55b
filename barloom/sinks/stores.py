"""Stores that only grow, written so that running a job again adds nothing."""
from __future__ import annotations

import functools
import operator
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.digests import content_digest
from barloom.session import stage
from barloom.sinks.ledger import Ledger, Write

BAR_KEY = ["security_id", "trade_date"]
ACTION_KEY = ["security_id", "effective_date", "factor"]
#: A file is hashed as one value.
MOST_FILE_BYTES = 512 << 20
PATCH_KEY = ["market", "security_id", "category", "batch", "trade_date"]


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def _unstored(rows: DataFrame, stored: DataFrame | None, key: list[str]) -> DataFrame:
    return rows if stored is None else rows.join(stored.select(*key), key, "left_anti")


def _content(rows: DataFrame, key: list[str]):
    """Everything but the key, as one comparable value."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns) if c not in key]), {"ignoreNullFields": "false"})


def conflicts(rows: DataFrame, stored: DataFrame | None, key: list[str], compare: list[str]) -> DataFrame:
    """Violation rows (key, error): keys that come with different content, or differ from what is stored under them."""
    content = _content(rows.select(*key, *compare), key)
    within = rows.groupBy(*key).agg((F.min(content) != F.max(content)).alias("differ")).filter("differ").select(*key, F.lit("CONFLICT_IN_DELIVERY").alias("error"))
    if stored is None:
        return within
    before = stored.select(*key, _content(stored.select(*key, *compare), key).alias("before"))
    return within.unionByName(rows.select(*key, content.alias("after")).join(before, key).filter("before <> after")
                              .select(*key, F.lit("CONFLICT_WITH_STORED").alias("error")).distinct())


PRICES = ["open", "high", "low", "close", "volume"]
#: Bars are the same where these agree: the anchor decides which splits still apply.
BAR_CONTENT = [*PRICES, "adjustment_as_of"]


def append_daily(rows: DataFrame, path: str) -> DataFrame:
    """Append bars to their own date's partition; returns the violations, one row a key and kind.

    Keys already stored with the same content are left out, equal copies are merged. A key that comes with different
    prices or adjustment anchors, or with others than are stored, is a violation and is not written; the others are. A catch-up brings several
    dates: only the partitions of those dates are read for the key check. Rows are rebalanced by date, so a large date
    is split into several files.
    """
    rows = stage(rows.withColumn("trade_date", F.coalesce("trade_date", "date") if "trade_date" in rows.columns else F.col("date")))
    stored = _stored(rows.sparkSession, path)
    if stored is not None:
        dates = F.broadcast(rows.select("trade_date").distinct())  # bounded by the calendar
        stored = stored.join(dates, "trade_date", "left_semi")
    wrong = stage(conflicts(rows, stored, BAR_KEY, [c for c in BAR_CONTENT if c in rows.columns]))
    new = _unstored(rows.join(wrong.select(*BAR_KEY), BAR_KEY, "left_anti").dropDuplicates(BAR_KEY), stored, BAR_KEY)
    new.hint("rebalance", "trade_date").write.mode("append").partitionBy("trade_date").parquet(path)
    return wrong


def append_actions(events: DataFrame, path: str) -> None:
    """Append split events that are not stored yet."""
    unique = events.dropDuplicates(ACTION_KEY)
    _unstored(unique, _stored(events.sparkSession, path), ACTION_KEY).write.mode("append").parquet(path)


def patch_identity(rows: DataFrame) -> DataFrame:
    """Identity of a correction: a digest of market, security, category, batch and date."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in PATCH_KEY]
    return rows.withColumn("identity", F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, 24))


def patch_conflicts(patches: DataFrame, stored: DataFrame) -> DataFrame:
    """Corrections whose key is stored with another result."""
    before = stored.select(*[F.col(c).alias(f"_{c}") for c in PATCH_KEY], F.col("result").alias("stored_result"))
    rows = patch_identity(patches)
    same = functools.reduce(operator.and_, [rows[c].eqNullSafe(before[f"_{c}"]) for c in PATCH_KEY])
    return rows.join(before, same).filter("result <> stored_result").select("identity", "security_id", "result", "stored_result")


def append_patches(patches: DataFrame, path: str) -> DataFrame | None:
    """Append accepted corrections, one per key; returns the conflicts in the delivery and with stored ones.

    Nothing is written when there is a conflict. The five key columns decide (nulls equal); the identity is a name only.
    """
    accepted = stage(patch_identity(patches.filter("accepted")))
    many = accepted.groupBy(*PATCH_KEY).agg(F.min("identity").alias("identity"), F.min("result").alias("result"), F.max("result").alias("stored_result"))
    wrong = many.filter("result <> stored_result").select("identity", "security_id", "result", "stored_result")
    stored = _stored(patches.sparkSession, path)
    if stored is not None:
        wrong = wrong.unionByName(patch_conflicts(accepted.drop("identity"), stored))
    wrong = stage(wrong)
    if not wrong.isEmpty():
        return wrong
    fresh = accepted.dropDuplicates(PATCH_KEY)
    if stored is not None:
        same = [fresh[c].eqNullSafe(stored[c]) for c in PATCH_KEY]
        fresh = fresh.join(stored, functools.reduce(operator.and_, same), "left_anti")
    fresh.write.mode("append").parquet(path)
    return None


RANK_TABLES = {"detail": "part", "list": "as_of", "receipt": "as_of", "excursions": "as_of"}


def open_rank(spark: SparkSession, path: str, as_of) -> Ledger:
    """The store of one date's ranking: details by part, the slim list, the receipt, and excursions where there are some."""
    return Ledger(spark, os.path.join(path, f"as_of={as_of}"), RANK_TABLES)


def write_rank(ranked: DataFrame, path: str, as_of, excursions: DataFrame | None = None) -> bool:
    """Write the ranking of one date: details in parts of 250 ranks, one file each in rank order, the slim list, the receipt.

    All of them become visible together. Skipped, returning False, when the same content is stored.
    """
    spark = ranked.sparkSession
    ranked = stage(ranked)  # read for the digest, the detail and the list
    store = open_rank(spark, path, as_of)
    receipt = content_digest(ranked, ranked.columns).first().asDict()
    if excursions is not None:
        excursions = stage(excursions)
        receipt["digest"] += " " + content_digest(excursions, excursions.columns).first()["digest"]
    before = store.batches()
    if before and before[-1].endswith(receipt["digest"]):
        return False
    parts = -(-receipt["rows"] // K.RANK_PART_ROWS)
    part = F.expr(f"int((rank - 1) div {K.RANK_PART_ROWS} + 1)")
    tasks = max(1, min(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    detail = (ranked.withColumn("part", part).repartitionById(tasks, F.pmod(F.col("part") - 1, F.lit(tasks)).cast("int"))
              .sortWithinPartitions("part", "rank"))
    day = F.lit(as_of).cast("date").alias("as_of")
    slim = ranked.repartitionByRange("rank").sortWithinPartitions("rank").select("rank", "security_id", "rank_score", "filter_pass", day)
    stated = spark.range(1).select(F.lit(receipt["rows"]).alias("rows"), F.lit(receipt["digest"]).alias("digest"), F.lit(parts).alias("detail_parts"), day)
    more = {} if excursions is None else {"excursions": Write(excursions.withColumn("as_of", day), replace=True)}
    return store.commit(f"{len(before) + 1} {receipt['digest']}", more | {
        "detail": Write(detail, emptied=tuple(store.values("detail"))), "list": Write(slim, replace=True), "receipt": Write(stated, replace=True)})


def write_snapshot(bars: DataFrame, path: str, rows_per_file: int = 2_000_000) -> None:
    """Freeze bars as files ordered by security; written once, never over an existing one."""
    (bars.repartitionByRange("security_id", "date").sortWithinPartitions("security_id", "date")
     .write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(path))


def snapshot_manifest(spark: SparkSession, path: str, digits: int | None = None) -> DataFrame:
    """Rows, bytes, SHA-256 and content digest of every file of a snapshot; the digests merge to that of the whole."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = spark.read.parquet(path)
    counted = content_digest(rows.select("*", name.alias("name")), sorted(rows.columns), ["name"], digits)
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    if large := sizes.filter(F.col("length") > MOST_FILE_BYTES).select("path").limit(5).collect():
        raise ValueError(f"too large to be hashed as one value, write with fewer rows a file: {[r.path for r in large]}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return files.join(counted, "name", "left").fillna(0, ["rows"])


def write_csv(rows: DataFrame, path: str) -> None:
    """Report tables (grids, designated lists) with a header line."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_bars_json(bars: DataFrame, path: str) -> None:
    """Compressed newline-delimited JSON; field order is that of the columns."""
    bars.write.mode("overwrite").option("compression", "gzip").json(path)
