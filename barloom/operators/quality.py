"""Stored-bar inventory, gaps, quality flags, outages and the repair queue."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.checks import is_structural
from barloom.functions.digests import digest, row_text
from barloom.operators.universe import is_active


def last_stored(securities: DataFrame, daily: DataFrame, base_as_of) -> DataFrame:
    """Latest stored date of every security: the base date (not for new listings) or a daily bar."""
    newest = daily.groupBy("security_id").agg(F.max("date").alias("newest"))
    base = F.when(~F.coalesce(F.col("security_id_origin") == "NEW_LISTING", F.lit(False)),
                  F.lit(base_as_of).cast("date"))
    return (securities.select("security_id", base.alias("base")).join(newest, "security_id", "left")
            .select("security_id", F.greatest("base", "newest").alias("last_date")))


def duplicate_keys(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("security_id", "date").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
            .withColumn("error", F.lit("DAILY_DUPLICATE_STORED")))


def market_outage(securities: DataFrame, daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per open date: active, available and whether the gap means a source-wide outage."""
    active = securities.filter(is_active()).select("security_id")
    have = (daily.join(active, "security_id", "left_semi").groupBy("date")
            .agg(F.count_distinct("security_id").alias("available")))
    days = (calendar.select("date").distinct().join(have, "date", "left").fillna(0, ["available"])
            .withColumn("active", active.agg(F.count(F.lit(1))).scalar()))
    share = (F.col("active") - F.col("available")) / F.nullif(F.col("active"), F.lit(0))
    return days.withColumn("status", F.when(share >= K.OUTAGE_SHARE, "MARKET_WIDE_DATA_UNAVAILABLE").otherwise("COMPLETE"))


def five_day_failures(queue: DataFrame, calendar: DataFrame, as_of) -> DataFrame:
    """Securities with an open fetch failure on each of the last five open dates."""
    newest = Window.orderBy(F.desc("date"))
    last = (calendar.select("date").distinct().filter(F.col("date") <= F.lit(as_of).cast("date"))
            .withColumn("back", F.row_number().over(newest)).filter("back <= 5").select(F.col("date").alias("trade_date")))
    failed = queue.filter((F.col("category") == "FETCH_FAILED") & (F.coalesce("status", F.lit("OPEN")) == "OPEN"))
    return (failed.join(F.broadcast(last), "trade_date", "left_semi").groupBy("security_id")
            .agg(F.count_distinct("trade_date").alias("days")).filter("days = 5")
            .select("security_id", F.lit("SUSPECT_DELISTED").alias("review_status")))


def new_listing_history(securities: DataFrame, daily: DataFrame) -> DataFrame:
    counts = daily.groupBy("security_id").agg(F.count_distinct("date").alias("bar_count"))
    return (securities.filter("security_id_origin = 'NEW_LISTING'").select("security_id")
            .join(counts, "security_id", "left").fillna(0, ["bar_count"])
            .withColumn("history_status", F.when(F.col("bar_count") < K.WINDOW_SESSIONS, "SHORT_HISTORY")
                        .otherwise("FULL_HISTORY")))


def _on_sessions(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    return bars.join(F.broadcast(sessions.select("date", "idx")), "date")


def interior_gaps(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Open dates without a bar between a security's first and last bar.

    Each bar looks at the session before it; only the missing sessions are generated.
    """
    axis = Window.partitionBy("security_id").orderBy("idx")
    rows = _on_sessions(bars, sessions).withColumn("before", F.lag("idx").over(axis))
    holes = rows.filter(F.col("idx") - F.col("before") > 1).select(
        "security_id", F.explode(F.sequence(F.col("before") + 1, F.col("idx") - 1)).alias("idx"))
    return holes.join(F.broadcast(sessions.select("date", "idx")), "idx").select("security_id", "date")


def missing_sessions(bars: DataFrame, sessions: DataFrame, wanted: DataFrame, recent: int | None = None) -> DataFrame:
    """Sessions a security should have and has no structurally valid bar for.

    From its first valid bar to the end of the calendar; with `recent` only the last that
    many sessions. A wanted security without a valid bar misses them all.
    """
    valid = bars.filter(is_structural()).join(wanted.select("security_id"), "security_id", "left_semi")
    rows = _on_sessions(valid, sessions).select("security_id", "idx").distinct()
    end_idx, start_idx = sessions.agg(F.max("idx")).scalar(), sessions.agg(F.min("idx")).scalar()
    # One closing mark per security after the last session turns trailing gaps into inner ones.
    marks = wanted.select("security_id").distinct().select(
        "security_id", (end_idx + 1).alias("idx"), start_idx.alias("start_idx"), end_idx.alias("end_idx"))
    lane = rows.withColumn("start_idx", F.lit(None).cast("bigint")).withColumn("end_idx", F.lit(None).cast("bigint"))
    axis = Window.partitionBy("security_id").orderBy("idx")
    placed = lane.unionByName(marks).select(
        "security_id", "idx", F.last("idx", ignorenulls=True).over(axis.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), "start_idx", "end_idx")
    floor = F.when(F.col("start_idx").isNotNull(), F.col("start_idx") - 1)
    start = F.coalesce("before", floor)
    if recent:
        # Leading sessions count too: look from the recent floor for the first bar as well.
        whole = Window.partitionBy("security_id")
        lowest = F.max(F.col("end_idx") - recent).over(whole)
        placed = placed.withColumn("low", lowest)
        start = F.greatest(F.coalesce("before", F.col("low")), F.col("low"))
    holes = placed.withColumn("begin", start).filter(F.col("idx") - F.col("begin") > 1).select(
        "security_id", F.explode(F.sequence(F.col("begin") + 1, F.col("idx") - 1)).alias("idx"))
    return holes.join(F.broadcast(sessions.select("date", "idx")), "idx").select("security_id", "date")


def dates_in_reasons(queue: DataFrame, calendar: DataFrame) -> DataFrame:
    """Open dates quoted in queue reasons (20xx-xx-xx), per security."""
    found = F.explode(F.regexp_extract_all("reason", F.lit(r"\b(20\d{2}-\d{2}-\d{2})\b"), F.lit(1)))
    quoted = queue.select("security_id", found.alias("text")).select("security_id", F.col("text").try_cast("date").alias("date"))
    return quoted.join(F.broadcast(calendar.select("date").distinct()), "date", "left_semi").distinct()


def needed_dates(status: DataFrame, bars: DataFrame, sessions: DataFrame, queue: DataFrame) -> DataFrame:
    """Dates to fetch before a quarantined security can be closed.

    Data gaps need every missing session and the dates quoted in their queue reasons, the
    other kinds only the last 20 sessions. `status`: security_id, original_status.
    """
    gap = status.filter("original_status = 'QUARANTINED_DATA_GAP'")
    other = status.filter("original_status <> 'QUARANTINED_DATA_GAP'")
    quoted = dates_in_reasons(queue, sessions).join(gap.select("security_id"), "security_id", "left_semi").select("security_id", "date")
    full = missing_sessions(bars, sessions, gap).unionByName(quoted).distinct()
    return full.unionByName(missing_sessions(bars, sessions, other, recent=20))


def suspect_days(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Stored bad bars and interior gaps."""
    bad = bars.filter(~is_structural()).select("security_id", "date", F.lit("BAD_BAR").alias("kind"))
    gaps = interior_gaps(bars, sessions).withColumn("kind", F.lit("GAP"))
    return bad.unionByName(gaps)


def quality_flags(bars: DataFrame, sessions: DataFrame, securities: DataFrame, daily: bool = False) -> DataFrame:
    """Flags of every security, in their order of report.

    `securities`: security_id, identity_review. `sessions` (date, idx) is the calendar asked for.
    """
    axis = Window.partitionBy("security_id").orderBy("date")
    rows = bars.join(F.broadcast(sessions), "date", "left").select(
        "security_id", "date", "idx", is_structural().alias("good"),
        F.last("idx", ignorenulls=True).over(axis.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.lag("date").over(axis).alias("day_before"),
        F.lag("close").over(axis).alias("prev"), "close")
    jump = F.abs(F.col("close") / F.nullif(F.col("prev"), F.lit(0.0)) - 1) > 0.5
    seen = rows.groupBy("security_id").agg(
        F.count(F.lit(1)).alias("bar_count"), F.bool_or(~F.col("good")).alias("bad"),
        F.bool_or(F.col("date") == F.col("day_before")).alias("twice"),
        F.bool_or(F.col("idx") - F.col("before") > 1).alias("gap"),
        F.bool_or(jump).alias("jump"), F.count("idx").alias("on_calendar"))
    size = sessions.agg(F.count(F.lit(1))).scalar()
    flat = (securities.select("security_id", "identity_review").join(seen, "security_id", "left")
            .withColumn("wanted", size))

    def on(name):
        return F.coalesce(F.col(name), F.lit(False))

    suspect = on("bad") | on("twice")
    complete = (F.col("bar_count") == F.col("wanted")) & (F.col("on_calendar") == F.col("wanted")) & ~on("twice")
    late = ~complete & on("gap") & ~suspect
    good, short = ("PASS_DAILY", "MISSING_DAILY") if daily else ("PASS_501", "INSUFFICIENT_HISTORY_NEW_LISTING")
    present = F.array_compact(F.array(
        F.when(on("jump"), "LARGE_MOVE"), F.when(late, "DATA_SUSPECT"),
        F.when(on("identity_review"), "IDENTITY_REVIEW"), F.when(suspect, "DATA_SUSPECT"),
        F.when(complete, good).otherwise(short)))
    absent = F.array_compact(F.array(F.when(on("identity_review"), "IDENTITY_REVIEW"), F.lit("FETCH_FAILED")))
    return flat.select("security_id", F.when(F.col("bar_count").isNull(), absent).otherwise(present).alias("flags"))


def catchup_targets(securities: DataFrame, last: DataFrame, sessions: DataFrame, as_of) -> DataFrame:
    """Sessions every active security still needs up to `as_of`.

    A stored security starts after its last bar; a new listing at the calendar floor or,
    if verified, its listing date. The span is generated from session positions.
    """
    as_of = F.lit(as_of).cast("date")
    upto = sessions.filter(F.col("date") <= as_of)
    rows = (securities.filter(is_active()).join(last, "security_id")
            .filter(F.col("last_date").isNull() | (F.col("last_date") < as_of))
            .withColumn("floor", upto.agg(F.min("date")).scalar()).withColumn("end_idx", upto.agg(F.max("idx")).scalar()))
    listed = F.when(F.col("listing_date_verified"), F.col("listing_date"))
    start = F.when(F.col("last_date").isNotNull(), F.date_add("last_date", 1)).otherwise(
        F.greatest(F.col("floor"), F.coalesce(listed, F.col("floor"))))
    # First session on or after the start, looked up by day.
    starts = rows.withColumn("date", start)
    from barloom.operators.earnings import session_after
    lookup = F.broadcast(session_after(starts.select("date"), sessions))
    spans = starts.join(lookup, "date").filter(F.col("on_or_after") <= F.col("end_idx"))
    return (spans.select("security_id", F.explode(F.sequence("on_or_after", "end_idx")).alias("idx"))
            .join(F.broadcast(sessions), "idx").select("security_id", "date"))


QUEUE_KEY = ("market", "security_id", "category", "trade_date")
BATCH_KEY = ("market", "security_id", "batch", "category")


def queue_append(queue: DataFrame, incoming: DataFrame, key: tuple[str, ...] = QUEUE_KEY) -> DataFrame:
    """Incoming items whose key is not stored yet. Missing key parts compare equal.

    Duplicates inside the incoming set are not removed.
    """
    stored = queue.select(*[F.col(k).alias("s_" + k) for k in key]).distinct()
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col("s_" + k))
    return incoming.join(stored, same, "left_anti")


def queue_reconcile(queue: DataFrame, terminals: DataFrame) -> DataFrame:
    """Queue rows with the status and reason of their security's closed quarantine.

    `terminals`: security_id, listing_status, close_reason. Only quarantine rows and
    readiness targets change.
    """
    joined = queue.join(terminals.select("security_id", F.col("listing_status").alias("terminal"), "close_reason"),
                        "security_id", "left")
    movable = F.col("terminal").isNotNull() & (F.coalesce(F.col("status").isin(*K.QUARANTINE_STATES), F.lit(False))
                                               | (F.col("category") == "FINAL_READINESS_TARGET"))
    movable = F.coalesce(movable, F.lit(False))
    status = F.when(F.col("terminal") == "ACTIVE", "RESOLVED").otherwise(F.col("terminal"))
    changed = movable & (~F.col("status").eqNullSafe(status) | ~F.col("reason").eqNullSafe(F.col("close_reason")))
    kept = [c for c in queue.columns if c not in ("status", "reason")]
    return joined.select(*kept, F.when(movable, status).otherwise(F.col("status")).alias("status"),
                         F.when(movable, F.col("close_reason")).otherwise(F.col("reason")).alias("reason"), changed.alias("changed"))


def source_diff(saved: DataFrame, live: DataFrame) -> DataFrame:
    """Files by path: UNCHANGED, CHANGED, NEW or DELETED on (md5, size)."""
    old = saved.select("path", F.struct("md5", "size").alias("old"))
    new = live.select("path", F.struct("md5", "size").alias("new"))
    state = (F.when(F.col("old").isNull(), "NEW").when(F.col("new").isNull(), "DELETED")
             .when(F.col("old") == F.col("new"), "UNCHANGED").otherwise("CHANGED"))
    return old.join(new, "path", "full").select("path", state.alias("state"))


def batch_contents(rows: DataFrame, security: str, columns: list[str], digits: int | None = None) -> DataFrame:
    """What each batch of rows holds: row_count, security_count and a digest over the columns."""
    return rows.groupBy("batch").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(security).alias("security_count"),
                                     digest(row_text(rows, columns, digits)).alias("digest"))


def batch_receipts(receipts: DataFrame, batches: DataFrame) -> DataFrame:
    """Receipt against what is stored: row count, security count and digest must agree. Batches on either side count."""
    facts = ("row_count", "security_count", "digest")
    joined = receipts.select("batch", F.struct(*facts).alias("stated")).join(batches.select("batch", F.struct(*facts).alias("found")), "batch", "full")
    error = (F.when(F.col("stated").isNull(), "RECEIPT_MISSING").when(F.col("found").isNull(), "BATCH_MISSING")
             .when(F.col("stated.row_count") != F.col("found.row_count"), "ROW_COUNT")
             .when(F.col("stated.security_count") != F.col("found.security_count"), "SECURITY_COUNT")
             .when(F.col("stated.digest") != F.col("found.digest"), "DIGEST"))
    return joined.select("batch", error.isNull().alias("intact"), error.alias("error"))


def explode_chains(chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contracts and listed expiries out of chain documents (security_id, chain)."""
    legs = chains.select("security_id", F.explode("chain.options").alias("o"))
    kinds = F.array(F.struct(F.lit("calls").alias("side"), F.col("o.calls").alias("legs")),
                    F.struct(F.lit("puts").alias("side"), F.col("o.puts").alias("legs")))
    contracts = (legs.select("security_id", F.col("o.expirationDate").alias("expiry"), F.inline(kinds))
                 .select("security_id", "expiry", "side", F.inline("legs")))
    expiries = chains.select("security_id", F.explode("chain.expirationDates").alias("expiry"))
    return contracts, expiries


def option_labels(securities: DataFrame, contracts: DataFrame, expiries: DataFrame) -> DataFrame:
    """Option availability of each security.

    `contracts`: security_id, expiry (epoch seconds), side, strike, bid, ask. `expiries`:
    security_id, expiry, those the provider lists. `securities` has `answered` (the provider
    gave a chain document). A vertical needs two quoted legs with different strikes on one
    listed expiry and side: lowest and highest quoted strike differ, so pairs are never
    formed and everything combines on the map side.
    """
    quoted = F.coalesce((F.col("ask") >= F.col("bid")) & (F.col("bid") >= 0), F.lit(False))
    strike = F.when(quoted, F.col("strike"))
    per_side = contracts.groupBy("security_id", "expiry", "side").agg(
        F.min("strike").alias("low"), F.max("strike").alias("high"), F.bool_or(quoted).alias("any_quote"),
        F.coalesce(F.min(strike) < F.max(strike), F.lit(False)).alias("spread"))
    listed = expiries.select("security_id", "expiry").distinct()
    on_listed = per_side.join(listed.withColumn("listed", F.lit(True)), ["security_id", "expiry"], "left")
    found = on_listed.groupBy("security_id").agg(
        (F.min("low") < F.max("high")).alias("two_strikes"), F.bool_or("any_quote").alias("any_quote"),
        F.bool_or(F.col("spread") & F.coalesce("listed", F.lit(False))).alias("vertical"))
    dates = listed.groupBy("security_id").agg(F.min("expiry").alias("nearest"), F.count(F.lit(1)).alias("expiry_count"))
    rows = (securities.select("security_id", "answered").join(dates, "security_id", "left")
            .join(found, "security_id", "left").fillna(0, ["expiry_count"]))
    some = F.col("expiry_count") > 0
    has = F.when(~F.col("answered"), "UNKNOWN").when(some, "TRUE").otherwise("FALSE")

    def known(name):
        return F.when(some & F.col("answered") & F.col(name), "TRUE").otherwise("UNKNOWN")

    return rows.select(
        "security_id", has.alias("has_options"), F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("nearest") / 86400).cast("int")).alias("nearest_expiry"),
        "expiry_count", known("two_strikes").alias("strike_data_available"), known("any_quote").alias("bid_ask_available"),
        known("vertical").alias("vertical_usable"),
        F.when(~F.col("answered"), "SOURCE_UNAVAILABLE").when(some, "CHECKED").otherwise("NO_EXPIRIES").alias("status"))


def option_label(chains: DataFrame) -> DataFrame:
    """Labels straight from chain documents; a null document or expiry list is no answer."""
    contracts, expiries = explode_chains(chains)
    asked = chains.select("security_id", F.col("chain.expirationDates").isNotNull().alias("answered"))
    return option_labels(asked, contracts, expiries)


def stale_option_status(status: Column, checked: Column, month_start: Column) -> Column:
    """STALE when a month or more has passed since the check."""
    months = F.months_between(F.trunc(month_start, "month"), F.trunc(checked, "month"))
    return F.when(months >= 1, "STALE").otherwise(status)
