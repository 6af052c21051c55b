"""Health, receipts, calendars and contract checks: tables in, verdict rows out."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.digests import content_digest, digest, row_text


def market_calendar(observed: DataFrame, overrides: DataFrame, outages: DataFrame, as_of, market: str = "US") -> DataFrame:
    """One row per day from the first observed session to `as_of`.

    An outage receipt beats an official override, that beats an observed session, that
    beats the weekend. A weekday with none of them stays UNVERIFIED; nothing is invented.
    """
    index, zone = ("^GSPC", "America/New_York") if market == "US" else ("^HSI", "Asia/Hong_Kong")
    span = observed.agg(F.min("date").alias("start"))
    days = span.select(F.explode(F.sequence("start", F.lit(as_of).cast("date"))).alias("date"))
    rows = (days.join(observed.select("date", F.lit(True).alias("seen")).distinct(), "date", "left")
            .join(overrides.withColumnRenamed("session_status", "official_status"), "date", "left")
            .join(outages.select("date", F.lit(True).alias("outage")).distinct(), "date", "left"))
    weekend = F.weekday("date") >= 5
    status = (F.when(F.col("outage"), "MARKET_WIDE_DATA_UNAVAILABLE").when(F.col("official_status").isNotNull(), F.col("official_status"))
              .when(F.col("seen"), "OPEN").when(weekend, "CLOSED").otherwise("UNVERIFIED"))
    rows = rows.withColumn("session_status", status)
    proof = F.col("official_source").isNotNull()
    return rows.select(
        F.col("date").alias("trade_date"), "session_status",
        F.coalesce("open_time", F.when(F.col("session_status").isin("OPEN", "HALF_DAY"), "09:30")).alias("open_time"),
        F.coalesce("close_time", F.when(F.col("session_status") == "OPEN", "16:00")).alias("close_time"),
        F.lit(zone).alias("time_zone"), (F.col("session_status") == "HALF_DAY").alias("half_day"),
        F.when(F.col("seen") | proof, F.coalesce("official_source", F.lit("BASE_CALENDAR/" + index)))
        .when(weekend, "WEEKEND").otherwise("PENDING_OFFICIAL_EVIDENCE").alias("source"), "evidence_ref")


def override_violations(overrides: DataFrame) -> DataFrame:
    unproven = F.col("official_source").isNull() | F.col("evidence_ref").isNull()
    bad = ~F.coalesce(F.col("session_status").isin("OPEN", "CLOSED", "HALF_DAY", "MARKET_HALTED"), F.lit(True))
    error = F.when(unproven, "CALENDAR_OVERRIDE_MISSING_OFFICIAL_EVIDENCE").when(bad, "CALENDAR_BAD_OFFICIAL_STATUS")
    return overrides.select("date", error.alias("error")).filter("error IS NOT NULL")


def daily_health(checkpoints: DataFrame, sessions: DataFrame, base: DataFrame, runs: DataFrame, ranks: DataFrame) -> DataFrame:
    """HEALTHY or the first failing check of every market.

    `checkpoints`: market, last_completed_date. `sessions`: market, date (completed ones).
    `base`: market, base_as_of. `runs`: market, trade_date, status. `ranks`: market, as_of.
    """
    newest = sessions.groupBy("market").agg(F.max("date").alias("expected"))
    run = runs.select("market", F.col("trade_date").alias("last_completed_date"), F.col("status").alias("run_status"))
    rank = ranks.select("market", F.col("as_of").alias("last_completed_date"), F.lit(True).alias("ranked")).distinct()
    rows = (base.join(checkpoints, "market", "left").join(newest, "market", "left")
            .join(run, ["market", "last_completed_date"], "left").join(rank, ["market", "last_completed_date"], "left"))
    last = F.col("last_completed_date")
    after = last > F.col("base_as_of")
    status = (F.when(last.isNull(), "DAILY_CHECKPOINT_MISSING").when(F.col("expected") > last, "DAILY_STALE")
              .when(last < F.col("base_as_of"), "DAILY_CHECKPOINT_BEFORE_BASE")
              .when(after & F.col("run_status").isNull(), "DAILY_RUN_RECEIPT_MISSING")
              .when(after & (F.col("run_status") != "COMPLETE"), "DAILY_RUN_NOT_COMPLETE")
              .when(F.col("ranked").isNull(), "DERIVED_RANK_MISSING").otherwise("HEALTHY"))
    return rows.select("market", "last_completed_date", status.alias("status"))


def receipt_valid() -> Column:
    return F.coalesce((F.col("status") == "COMPLETE") & (F.col("active") > 0) & (F.col("available") > 0)
                      & (F.col("available") <= F.col("active")), F.lit(False))


def rank_violations(ranked: DataFrame, receipts: DataFrame, detail_parts: DataFrame) -> DataFrame:
    """Broken rules of stored rankings, per (market, as_of); empty when all are sound.

    `ranked`: market, as_of, security_id. `receipts`: market, as_of, active, available,
    stated_parts. `detail_parts`: market, as_of, part (those that exist).
    """
    keys = ["market", "as_of"]
    size = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("security_id").alias("ids"))
    stored = detail_parts.groupBy(*keys).agg(F.count_distinct("part").alias("present"))
    rows = receipts.join(size, keys, "left").join(stored, keys, "left").fillna(0, ["rows", "ids", "present"])
    parts = F.ceil(F.col("rows") / K.RANK_PART_ROWS)
    checks = F.array_compact(F.array(
        F.when(F.col("rows") == 0, "RANK_EMPTY"), F.when(F.col("stated_parts") != parts, "RANK_PARTS"),
        F.when(F.col("ids") != F.col("rows"), "RANK_DUPLICATE_ID"),
        F.when((F.col("rows") < F.col("available")) | (F.col("rows") > F.col("active")), "RANK_COVERAGE"),
        F.when(F.col("present") < parts, "RANK_DETAIL_MISSING")))
    return rows.select(*keys, F.explode(checks).alias("error"))


def contiguous_closeout(sessions: DataFrame, checkpoints: DataFrame, receipts: DataFrame) -> DataFrame:
    """Sessions after the checkpoint that can be closed: valid receipts up to the first gap."""
    pending = (sessions.join(checkpoints.select("market", "last_completed_date"), "market")
               .filter(F.col("date") > F.col("last_completed_date")))
    done = receipts.select("market", F.col("trade_date").alias("date"), receipt_valid().alias("ok"))
    rows = pending.join(done, ["market", "date"], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    upto = Window.partitionBy("market").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("all_ok", F.min(F.col("ok").cast("int")).over(upto)).filter("all_ok = 1").select("market", "date")


def shard_violations(rows: DataFrame, receipt: DataFrame, market: str, as_of) -> DataFrame:
    """Checks on precomputed indicator rows before they are ranked, as violation counts.

    `rows`: security_id, trade_date, rank_score, relative_strength_20d. `receipt`: one row with active, available and the
    digest that the rows had when they were issued (see `shard_digest`).
    """
    well_formed = F.col("security_id").rlike(f"^{market}-\\d{{6,}}$")
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("security_id").alias("ids"),
        F.count(F.when(~F.coalesce(well_formed, F.lit(False)), 1)).alias("malformed"),
        F.count(F.when(F.col("trade_date") > F.lit(as_of).cast("date"), 1)).alias("future"),
        F.count(F.when(F.col("rank_score").isNotNull() | F.col("relative_strength_20d").isNotNull(), 1)).alias("already_ranked"),
        digest(row_text(rows, sorted(rows.columns))).alias("found"))
    issued = receipt.select("digest").scalar()
    available, active = receipt.select("available").scalar(), receipt.select("active").scalar()
    coverage = ~F.col("rows").between(available, active)
    pairs = [("COVERAGE", F.when(coverage, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))),
             ("DUPLICATE_ID", F.col("rows") - F.col("ids")),
             ("MALFORMED_ID", F.col("malformed")), ("FUTURE_DATE", F.col("future")), ("RANK_FIELDS_SET", F.col("already_ranked")),
             ("DIGEST", (~F.col("found").eqNullSafe(issued)).cast("bigint"))]
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), v.alias("violations")) for n, v in pairs])))


def shard_digest(rows: DataFrame) -> DataFrame:
    """Digest over all columns of indicator rows, for their receipt."""
    return content_digest(rows, sorted(rows.columns)).select("digest")


def payload_violations(payload: DataFrame, market: str) -> DataFrame:
    """Rows of daily files that break identity rules.

    `payload`: path, folder_date, security_id, date, trade_date. A key may occur once over
    all files of its folder.
    """
    effective = F.coalesce("trade_date", "date")
    wrong = ~F.coalesce(F.col("security_id").startswith(market + "-") & (effective == F.col("folder_date"))
                        & (F.col("date") == F.col("folder_date")), F.lit(False))
    identity = payload.filter(wrong).select("security_id", "folder_date", F.lit("DAILY_ROW_IDENTITY_INVALID").alias("error"))
    twice = (payload.groupBy("security_id", "folder_date").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select("security_id", "folder_date", F.lit("DAILY_DUPLICATE_KEY").alias("error")))
    return identity.unionByName(twice).distinct()


def regression_contract(observed: DataFrame, expected: DataFrame, tolerance: float = K.REGRESSION_TOLERANCE) -> DataFrame:
    """Named equality checks: all values of a name within tolerance (null equals null)."""
    joined = expected.withColumnRenamed("value", "wanted").join(observed, ["name", "field"], "left")
    same = F.when(F.col("wanted").isNull() | F.col("value").isNull(),
                  F.col("wanted").isNull() & F.col("value").isNull()).otherwise(
        F.abs(F.col("wanted") - F.col("value")) <= tolerance)
    return joined.groupBy("name").agg(F.bool_and(same).alias("pass"), F.count(F.lit(1)).alias("fields"))


def expected_values(spark: SparkSession) -> DataFrame:
    """The frozen monthly numbers as a table (name, field, value)."""
    return spark.createDataFrame([tuple(v) for v in K.REGRESSION_VALUES], "name string, field string, value double")


def expected_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(v) for v in K.REGRESSION_LABELS], "name string, field string, value string")


def label_contract(observed: DataFrame, expected: DataFrame) -> DataFrame:
    joined = expected.withColumnRenamed("value", "wanted").join(observed, ["name", "field"], "left")
    return joined.groupBy("name").agg(F.bool_and(F.col("wanted").eqNullSafe(F.col("value"))).alias("pass"),
                                      F.count(F.lit(1)).alias("fields"))


def pointer_diff(prior: DataFrame, new: DataFrame, compared: list[str], same_keys: list[str]) -> DataFrame:
    """Next version of the monthly pointer of each market, or the fields that conflict.

    Both: market, the `same_keys` that identify a month, `compared` fields; prior has version.
    """
    old = prior.select("market", "version", *[F.col(c).alias("p_" + c) for c in set(compared + same_keys)])
    rows = new.join(old, "market", "left")
    same = F.lit(True)
    for c in same_keys:
        same = same & F.col(c).eqNullSafe(F.col("p_" + c))
    same = same & F.col("version").isNotNull()
    conflicts = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col("p_" + c)), c) for c in sorted(compared)]))
    return rows.select(
        "market", same.alias("same_month"),
        F.when(same, F.col("version")).otherwise(F.coalesce("version", F.lit(0)) + 1).alias("version"),
        F.when(same, F.concat_ws(",", conflicts)).otherwise("").alias("conflicts"))
