"""Decisions on queued data problems, and closing of quarantined securities."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.checks import PRICES, is_structural
from barloom.functions.text import closing_exclusion
from barloom.operators.quality import needed_dates, suspect_days
from barloom.session import stage


def _evidence(refreshed: DataFrame, stored: DataFrame, sessions: DataFrame) -> DataFrame:
    """What is stored and what the refreshed bars offer, per (security, date), staged as two results are made of it.

    Stored bars, suspect days and refreshed bars are laid together and counted by one grouping, which needs no sorting.
    """
    known = stored.select("security_id", "date", F.lit(True).alias("known"))
    suspects = suspect_days(stored, sessions).select("security_id", "date", F.lit(True).alias("suspect"))
    on_calendar = refreshed.join(F.broadcast(sessions.select("date")), "date", "left_semi").select(
        "security_id", "date", F.lit(1).alias("bar"), F.when(is_structural(), 0).otherwise(1).alias("bad"))
    laid = known.unionByName(suspects, allowMissingColumns=True).unionByName(on_calendar, allowMissingColumns=True)
    return stage(laid.groupBy("security_id", F.col("date").alias("trade_date")).agg(
        F.count("bar").alias("day_bars"), F.coalesce(F.sum("bad"), F.lit(0)).alias("day_bad"),
        F.count("known").alias("known"), F.count("suspect").alias("suspect")))


def _per_security(days: DataFrame) -> DataFrame:
    suspect, new = F.col("suspect") > 0, F.col("known") == 0
    return days.groupBy("security_id").agg(
        F.count(F.when(suspect, 1)).alias("suspect_days"), F.sum("day_bars").alias("all_bars"),
        F.sum(F.when(suspect, F.col("day_bars"))).alias("suspect_bars"), F.sum(F.when(suspect, F.col("day_bad"))).alias("suspect_bad"),
        F.sum(F.when(new, F.col("day_bars"))).alias("new_bars"), F.sum(F.when(new, F.col("day_bad"))).alias("new_bad"))


def repair_decisions(items: DataFrame, securities: DataFrame, sessions: DataFrame, outages: DataFrame,
                     stored: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Result, reason and acceptance of every queue item, by one ordered list of rules.

    `items`: item_id, market, security_id, category, problem, trade_date, batch.
    `securities`: ticker, exchange, isin, identity_review, listing_date, listing_date_verified,
    delisting_proven, proof (kind, isin, new_ticker, source_hash) and official (ticker,
    exchange, isin, source_hash). `refreshed` are bars obtained again from the source. The calendar and what is needed of
    the stored bars are read several times, so they are staged instead of being made again at every use.
    """
    sessions = stage(sessions.select("date", "idx"))
    days = _evidence(refreshed, stage(stored.select("security_id", "date", *PRICES, "volume")), sessions)
    dated = days.filter("day_bars > 0").select("security_id", "trade_date", "day_bars", "day_bad")
    per_security = _per_security(days)
    calendar = F.broadcast(sessions.select(F.col("date").alias("trade_date"), F.lit(True).alias("is_session")))
    halted = outages.select("market", "trade_date", F.lit(True).alias("halted")).distinct()
    own = securities.withColumn("known_security", F.lit(True)).drop("market")
    rows = (items.join(own, "security_id", "left").join(halted, ["market", "trade_date"], "left")
            .join(calendar, "trade_date", "left").join(dated, ["security_id", "trade_date"], "left")
            .join(per_security, "security_id", "left"))
    counts = ["day_bars", "day_bad", "suspect_days", "all_bars", "suspect_bars", "suspect_bad", "new_bars", "new_bad"]
    rows = rows.fillna(0, counts)
    category, has_day = F.col("category"), F.col("trade_date").isNotNull()
    review, suspect = category == "IDENTITY_REVIEW", category == "DATA_SUSPECT"
    official, proof, batch = F.col("official"), F.col("proof"), F.col("batch").isNotNull()
    hashed = F.coalesce(official["source_hash"] != "", F.lit(False))
    proven = ((F.col("problem") == "OFFICIAL_ISIN_SAME_NEW_TICKER") & (F.col("market") == "HK")
              & (proof["kind"] == "HK_ISIN_MATCH") & (proof["isin"] == F.col("isin"))
              & (proof["new_ticker"] == F.col("ticker")) & (proof["source_hash"] != ""))
    listed = (hashed & (F.col("identity_review") == F.lit(False)) & (official["ticker"] == F.col("ticker"))
              & official["exchange"].eqNullSafe(F.col("exchange")) & official["isin"].eqNullSafe(F.col("isin")))
    nameless = (F.coalesce("ticker", F.lit("")) == "") | (F.coalesce("exchange", F.lit("")) == "")
    early = has_day & (F.col("trade_date") < F.col("listing_date")) & F.coalesce("listing_date_verified", F.lit(False))
    undated_suspect = suspect & ~has_day
    fetched = F.when(has_day, F.col("day_bars")).when(undated_suspect, F.col("suspect_bars")).otherwise(F.col("all_bars"))
    left = F.when(has_day, F.col("day_bars")).when(undated_suspect, F.col("suspect_bars")).otherwise(F.col("new_bars"))
    broken = F.when(has_day, F.col("day_bad")).when(undated_suspect, F.col("suspect_bad")).otherwise(F.col("new_bad"))
    defects = F.when(batch, F.col("suspect_days")).otherwise(0)
    open_ended = ~has_day & ~suspect
    rules = [
        (F.col("known_security").isNull(), "UNRESOLVED", "SECURITY_ID_MISSING_OR_EXECUTION_EVENT"),
        (F.col("delisting_proven"), "DELISTED", "OFFICIAL_DELISTING_CONFIRMED"),
        (review & (proven | listed), "IDENTITY_FIXED", None),
        (F.col("halted"), "UNRESOLVED", "MARKET_WIDE_OUTAGE"),
        (category == "SUSPECT_DELISTED", "UNRESOLVED", "OFFICIAL_DELISTING_PROOF_REQUIRED"),
        (nameless, "UNRESOLVED", "IDENTITY_NOT_VERIFIED"),
        (review, "UNRESOLVED", "OFFICIAL_IDENTITY_PROOF_REQUIRED"),
        (~hashed | ~F.coalesce(official["ticker"] == F.col("ticker"), F.lit(False)), "UNRESOLVED", "OFFICIAL_LISTING_PROOF_REQUIRED"),
        (F.col("identity_review"), "UNRESOLVED", "IDENTITY_REVIEW_OPEN"),
        (undated_suspect & (defects == 0), "VALIDATED_NO_DATA_DEFECT", "NO_TRADE_BAR_VALID_OR_NOT_REPRODUCED"),
        (has_day & F.col("is_session").isNull(), "UNRESOLVED", "SESSION_NOT_CONFIRMED"),
        ((fetched == 0) & early, "SHORT_HISTORY", "PRE_LISTING_DATE"),
        (fetched == 0, "NO_DATA", "NO_PRIMARY_BAR_ACTIVE_LISTING"),
        (open_ended & (category != "FETCH_FAILED"), "UNRESOLVED", "EXACT_DATE_REQUIRED"),
        (open_ended & ~batch, "UNRESOLVED", "BASE_BATCH_UNKNOWN"),
        (left == 0, "UNRESOLVED", "NO_BAR_AT_REQUESTED_DATE"),
        (broken > 0, "UNRESOLVED", "BAR_STILL_SUSPECT"),
    ]
    result, reason = F, F
    for test, outcome, why in rules:
        test = F.coalesce(test, F.lit(False))
        result = result.when(test, F.lit(outcome))
        reason = reason.when(test, F.lit(why).cast("string"))
    result = result.otherwise("RESOLVED")
    return rows.select(*items.columns, result.alias("result"), reason.otherwise(F.lit(None)).alias("reason")).withColumn(
        "accepted", F.col("result").isin("RESOLVED", "IDENTITY_FIXED"))


def correction_rows(decisions: DataFrame, stored: DataFrame, refreshed: DataFrame, sessions: DataFrame) -> DataFrame:
    """The bars that accepted decisions put in place, keyed by item."""
    settled = decisions.filter("result = 'RESOLVED'").select("item_id", "security_id", "category", "trade_date")
    on_calendar = refreshed.join(F.broadcast(sessions.select("date")), "date", "left_semi")
    keys = ["security_id", "date"]
    day = on_calendar.join(settled.filter("trade_date IS NOT NULL").select(
        "item_id", "security_id", F.col("trade_date").alias("date")), keys)
    doubtful = on_calendar.join(suspect_days(stored, sessions).select(*keys).distinct(), keys, "left_semi").join(
        settled.filter("trade_date IS NULL AND category = 'DATA_SUSPECT'").select("item_id", "security_id"), "security_id")
    fresh = on_calendar.join(stored.select(*keys), keys, "left_anti").join(
        settled.filter("trade_date IS NULL AND category = 'FETCH_FAILED'").select("item_id", "security_id"), "security_id")
    return day.unionByName(doubtful).unionByName(fresh)


def apply_decisions(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Queue with the decided statuses; only OPEN and UNRESOLVED items move."""
    found = decisions.select("item_id", F.col("result").alias("decided"), F.col("reason").alias("why"))
    rows = queue.join(found, "item_id", "left")
    moves = F.coalesce(F.coalesce("status", F.lit("OPEN")).isin(*K.PENDING_STATES) & F.col("decided").isNotNull(), F.lit(False))
    kept = [c for c in queue.columns if c not in ("status", "reason")]
    return rows.select(*kept, F.when(moves, F.col("decided")).otherwise(F.col("status")).alias("status"),
                       F.when(moves, F.col("why")).otherwise(F.col("reason")).alias("reason"), moves.alias("processed"))


def queue_summary(queue: DataFrame) -> DataFrame:
    pending = F.coalesce("status", F.lit("OPEN")).isin(*K.PENDING_STATES)
    return queue.groupBy("market").agg(
        F.count(F.when(F.col("processed"), 1)).alias("processed"),
        F.count(F.when(F.col("processed") & F.col("status").isin("RESOLVED", "IDENTITY_FIXED"), 1)).alias("accepted"),
        F.count(F.when(pending, 1)).alias("open"))


def quarantine_closeout(targets: DataFrame, securities: DataFrame, composed: DataFrame, sessions: DataFrame,
                        queue: DataFrame, refreshed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terminal status of every quarantined target, and the bars that were added.

    `targets`: security_id, original_status. `securities`: security_id, name, official_ok.
    `composed` and `refreshed` are bars; only structurally valid refreshed ones are used.
    Each of the needed dates, the state and the merged bars is read by several later steps,
    so they are staged once instead of being planned again at every use.
    """
    status = targets.select("security_id", "original_status")
    own = securities.select("security_id", "name", "official_ok", F.lit(True).alias("known"))
    plan = status.join(own, "security_id", "left")
    code = F.when(F.col("official_ok"), closing_exclusion(F.col("name")))
    plan = plan.withColumn("excluded", code)
    open_ids = plan.filter(F.coalesce("official_ok", F.lit(False)) & F.col("excluded").isNull()).select(
        "security_id", "original_status")
    bars = composed.join(open_ids.select("security_id"), "security_id", "left_semi")
    bars = stage(bars)
    first = stage(needed_dates(open_ids, bars, sessions, queue))
    health = bars.groupBy("security_id").agg(F.count(F.lit(1)).alias("bar_count"), F.bool_and(is_structural()).alias("all_good"))
    gaps = first.groupBy("security_id").agg(F.count(F.lit(1)).alias("needed"))
    state = (open_ids.join(health, "security_id", "left").join(gaps, "security_id", "left").fillna(0, ["bar_count", "needed"]))
    done = (F.col("needed") == 0) & (F.col("bar_count") > 0) & F.coalesce("all_good", F.lit(False))
    state = stage(state.withColumn("complete", done))
    # Where bars are bad but no date is missing, the last 20 sessions are asked for.
    recent = F.broadcast(sessions.withColumn("back", F.row_number().over(Window.orderBy(F.desc("date")))).filter("back <= 20").select("date"))
    blind = state.filter(~F.col("complete") & (F.col("needed") == 0)).select("security_id")
    usable = refreshed.filter(is_structural())
    fresh = usable.join(first, ["security_id", "date"], "left_semi").unionByName(
        usable.join(blind, "security_id", "left_semi").join(recent, "date", "left_semi"))
    good = bars.filter(is_structural())
    added = (fresh.join(state.filter(~F.col("complete")).select("security_id"), "security_id", "left_semi")
             .join(good.select("security_id", "date"), ["security_id", "date"], "left_anti"))
    fields = ["security_id", "date", "open", "high", "low", "close", "volume"]
    added = stage(added)
    combined = good.select(*fields).unionByName(added.select(*fields))
    pending = state.filter(~F.col("complete")).select("security_id", "original_status")
    still = needed_dates(pending, combined, sessions, queue)
    dates = F.array_sort(F.collect_list(F.col("date").cast("string")))  # bounded by the calendar
    listed = still.groupBy("security_id").agg(dates.alias("missing_dates")).withColumn(
        "missing", F.concat_ws(",", F.slice("missing_dates", 1, 12)))  # the message names twelve
    have = combined.groupBy("security_id").agg(F.count(F.lit(1)).alias("combined"))
    rows = (plan.join(state.select("security_id", "complete"), "security_id", "left")
            .join(listed, "security_id", "left").join(have, "security_id", "left"))
    refilled = (F.col("combined") > 0) & F.col("missing").isNull()
    gap = F.when(F.col("original_status") == "QUARANTINED_DATA_GAP", "QUARANTINED_DATA_GAP").otherwise("QUARANTINED_UNCONFIRMED_SOURCE")
    unproven = ~F.coalesce("official_ok", F.lit(False))
    terminal = (F.when(F.col("known").isNull() | unproven, "QUARANTINED_IDENTITY").when(F.col("excluded").isNotNull(), F.col("excluded"))
                .when(F.col("complete") | F.coalesce(refilled, F.lit(False)), "ACTIVE").otherwise(gap))
    reason = (F.when(F.col("known").isNull(), "SECURITY_ID_MISSING_FROM_CURRENT_UNIVERSE")
              .when(unproven, "OFFICIAL_LISTING_NOT_CONFIRMED")
              .when(F.col("excluded").isNotNull(), "OFFICIAL_LISTING_SECURITY_TYPE_EXCLUDED")
              .when(F.col("complete"), "OFFICIAL_LISTING_AND_COMPOSED_HISTORY_CONFIRMED")
              .when(F.coalesce(refilled, F.lit(False)), "OFFICIAL_LISTING_AND_PRIMARY_HISTORY_REFRESH_CONFIRMED")
              .otherwise(F.concat(F.lit("PRIMARY_REFRESH_INCOMPLETE:MISSING_SESSIONS:"), F.coalesce("missing", F.lit("")))))
    closed = rows.select("security_id", "original_status", terminal.alias("terminal_status"), reason.alias("reason"),
                         F.coalesce(F.size("missing_dates"), F.lit(0)).alias("missing_count"), "missing_dates")
    result = (F.when(F.col("terminal_status") == "ACTIVE", "RESOLVED")
              .when(F.col("terminal_status").startswith("EXCLUDED_"), "IDENTITY_FIXED").otherwise(F.col("terminal_status")))
    closed = closed.withColumn("result", result)
    return closed.withColumn("accepted", F.col("result").isin("RESOLVED", "IDENTITY_FIXED")), added
