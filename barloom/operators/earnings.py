"""Earnings events: identity, calendar, history, provider figures and price reactions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.checks import ratio_change
from barloom.functions.text import hk_ticker_key, parse_number, us_ticker_key

OPEN_REACTIONS = ("PENDING_PRICE", "PARTIAL", "PRICE_MISSING")


def ticker_key(ticker: Column, market: Column | str) -> Column:
    market = F.lit(market) if isinstance(market, str) else market
    return F.when(market == "US", us_ticker_key(ticker)).otherwise(hk_ticker_key(ticker))


def resolve_tickers(mentions: DataFrame, active: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Security of each mention (market, ticker, day): only when exactly one active one fits.

    `aliases` (key, before, alias_id) adds a dated former ticker. Candidates are counted per
    key before the join, so a mention never meets more than one index row.
    """
    keyed = active.select("market", ticker_key(F.col("ticker"), F.col("market")).alias("key"), "security_id")
    index = keyed.groupBy("market", "key").agg(
        F.count_distinct("security_id").alias("ids"), F.min("security_id").alias("only"))
    rows = mentions.withColumn("key", ticker_key(F.col("ticker"), F.col("market"))).join(
        index, ["market", "key"], "left")
    ids, only = F.coalesce("ids", F.lit(0)), F.col("only")
    if aliases is not None:
        known = aliases.join(active.select(F.col("security_id").alias("alias_id")), "alias_id", "left_semi")
        held = keyed.select("key", F.col("security_id").alias("alias_id"), F.lit(True).alias("held"))
        known = known.join(held, ["key", "alias_id"], "left")
        rows = rows.join(known, "key", "left")
        extra = (F.col("alias_id").isNotNull() & (F.col("day") < F.col("before"))
                 & (F.col("market") == "US") & F.col("held").isNull())
        extra = F.coalesce(extra, F.lit(False))
        ids, only = ids + extra.cast("int"), F.coalesce(only, F.when(extra, F.col("alias_id")))
    resolved = F.when(ids == 1, only)
    return rows.select(*mentions.columns, "key", resolved.alias("security_id"),
                       F.when(ids > 1, "AMBIGUOUS").when(ids == 0, "UNKNOWN").otherwise("RESOLVED").alias("match"))


def session_of_report(time_text: Column) -> Column:
    return (F.when(time_text == "time-pre-market", "BMO").when(time_text == "time-after-hours", "AMC")
            .otherwise("UNKNOWN"))


def report_time(events: DataFrame) -> DataFrame:
    """Report date and boundary in Kuala Lumpur time; unknown sessions keep the date only."""
    known = F.col("session") != "UNKNOWN"
    clock = F.when(F.col("session") == "BMO", "09:30:00").otherwise("16:00:00")
    local = F.concat_ws(" ", F.col("report_date").cast("string"), clock).cast("timestamp_ntz")
    moved = F.convert_timezone(F.lit("America/New_York"), F.lit("Asia/Kuala_Lumpur"), local)
    return events.select(
        "*", F.when(known, moved.cast("date")).otherwise(F.col("report_date")).alias("report_date_myt"),
        F.when(known, F.date_format(moved, "yyyy-MM-dd'T'HH:mm'+08:00'")).alias("boundary_myt"),
        F.when(F.col("session") == "BMO", "BEFORE_OPEN").when(known, "AFTER_CLOSE").alias("window"),
        F.when(~known, "UNKNOWN_SOURCE_TIME").alias("time_reason"))


def unique_calendar(events: DataFrame) -> DataFrame:
    """First event per (security, report date) in source order (`sequence`)."""
    payload = [c for c in events.columns if c not in ("security_id", "report_date")]
    return (events.groupBy("security_id", "report_date")
            .agg(F.min_by(F.struct(*payload), "sequence").alias("event"))
            .select("security_id", "report_date", "event.*"))


def no_event_status(active: DataFrame, calendar: DataFrame, source_failed: bool = False) -> DataFrame:
    status = "DATE_UNKNOWN_SOURCE_FAILURE" if source_failed else "NO_DATE_IN_WINDOW"
    return (active.select("security_id").join(calendar.select("security_id"), "security_id", "left_anti")
            .withColumn("status", F.lit(status)))


def calendar_to_history(old: DataFrame, new: DataFrame, history: DataFrame, today) -> DataFrame:
    """Move past or re-dated calendar events into history, with their revisions.

    `history`: event_id, security_id, report_date, session, event_status, revisions
    (array of old_date, new_date). A security's new dates travel as one array (bounded by
    the calendar window), so old and new events are never paired row by row.
    """
    rows = _with_moved(old, new, history, today)
    return rows.select(*_history_fields(today, F.concat(_recorded(), _fresh())))


def calendar_moves(old: DataFrame, new: DataFrame, history: DataFrame, today) -> DataFrame:
    """`calendar_to_history` for callers with more joins to come: `revisions` holds what was recorded before.

    An event's revisions are as many as its security's new dates, so they outweigh all else an event has. Here
    `redated` stands for those found now; `with_revisions` adds them when the rows move no more.
    """
    rows = _with_moved(old, new, history, today)
    return rows.select(*_history_fields(today, _recorded(), F.col("redated")))


def with_revisions(moves: DataFrame, new: DataFrame) -> DataFrame:
    """Adds the revisions found now to events that come from `calendar_moves` with the same new calendar."""
    rows = moves.join(_new_dates(new), "security_id", "left").withColumn("revisions", F.concat(_recorded(), _fresh()))
    return rows.select(*[c for c in moves.columns if c != "redated"])


def _new_dates(new: DataFrame) -> DataFrame:
    return new.groupBy("security_id").agg(F.array_sort(F.collect_set("report_date")).alias("new_dates"))


def _with_moved(old: DataFrame, new: DataFrame, history: DataFrame, today) -> DataFrame:
    """History and the calendar events that moved; only their keys meet, the new dates join by security afterwards."""
    keys = ["security_id", "report_date"]
    dates = _new_dates(new)
    stays = F.coalesce(F.array_contains("new_dates", F.col("report_date")), F.lit(False))
    redated = F.coalesce(F.size("new_dates") > 0, F.lit(False)) & ~stays
    moved = (old.join(dates, "security_id", "left").withColumn("redated", redated)
             .filter((F.col("report_date") < F.lit(today).cast("date")) | F.col("redated"))
             .select(*keys, F.col("session").alias("new_session"), "redated"))
    rows = history.join(moved, keys, "full").withColumn("redated", F.coalesce("redated", F.lit(False)))
    return rows.join(dates, "security_id", "left")


def _recorded() -> Column:
    return F.coalesce("revisions", F.array().cast("array<struct<old_date:date,new_date:date>>"))


def _fresh() -> Column:
    """Revisions found now that were not recorded before."""
    empty = F.array().cast("array<struct<old_date:date,new_date:date>>")
    change = F.transform("new_dates", lambda d: F.struct(F.col("report_date").alias("old_date"), d.alias("new_date")))
    found = F.when(F.col("redated"), change).otherwise(empty)
    # array_except compares structs pairwise; with nothing recorded yet all found ones are new.
    return F.when(F.size(_recorded()) == 0, found).otherwise(F.array_except(found, _recorded()))


def _history_fields(today, revisions: Column, *more: Column) -> list[Column]:
    keys = ["security_id", "report_date"]
    revised = F.when(F.size(_recorded()) == 0, F.col("redated")).otherwise(F.size(_fresh()) > 0)
    return [
        F.coalesce("event_id", F.concat_ws(":", "security_id", F.col("report_date").cast("string"))).alias("event_id"),
        *map(F.col, keys), F.coalesce("session", "new_session").alias("session"),
        F.when(revised, "REVISED").otherwise(F.col("event_status")).alias("event_status"),
        revisions.alias("revisions"), *more, F.col("event_id").isNull().alias("is_new"),
        (F.col("event_id").isNull() & (F.col("report_date") < F.lit(today).cast("date"))).alias("eps_refresh_pending")]


def eps_refresh(history: DataFrame, provider: DataFrame, today) -> DataFrame:
    """Fill actual figures of past pending events from provider rows of their day.

    `provider`: report_date, symbol, eps, surprise, sequence; the last row per ticker counts.
    """
    figures = (provider.withColumn("key", us_ticker_key(F.col("symbol")))
               .groupBy("report_date", "key")
               .agg(F.max_by(F.struct(parse_number(F.col("eps")).alias("actual"),
                                      parse_number(F.col("surprise")).alias("surprise")), "sequence").alias("figure")))
    due = ((F.col("report_date") < F.lit(today).cast("date")) & F.col("eps_actual").isNull()
           & F.coalesce("eps_refresh_pending", F.lit(False)))
    rows = history.withColumn("key", us_ticker_key(F.col("ticker"))).withColumn("due", due)
    joined = rows.join(figures, ["report_date", "key"], "left")
    filled = F.col("due") & F.col("figure.actual").isNotNull()
    kept = [c for c in history.columns if c not in ("eps_actual", "eps_surprise_pct", "eps_status", "eps_refresh_pending")]
    return joined.select(
        *kept, F.when(filled, F.col("figure.actual")).otherwise(F.col("eps_actual")).alias("eps_actual"),
        F.when(filled, F.col("figure.surprise")).otherwise(F.col("eps_surprise_pct")).alias("eps_surprise_pct"),
        F.when(filled, "AVAILABLE").otherwise(F.col("eps_status")).alias("eps_status"),
        F.when(filled, False).when(F.col("due"), True).otherwise(F.col("eps_refresh_pending")).alias("eps_refresh_pending"))


def session_after(dates: DataFrame, sessions: DataFrame) -> DataFrame:
    """For each date: index of the first session on or after it, and strictly after it.

    An as-of lookup over the distinct days; both inputs are bounded by the calendar.
    """
    days = (dates.select("date").distinct().select("date", F.lit(None).cast("bigint").alias("idx"))
            .unionByName(sessions.select("date", "idx")))
    days = days.withColumn("number", F.unix_date("date"))
    later = Window.orderBy(F.desc("number"))
    found = days.select("date", "idx", F.min("idx").over(later.rangeBetween(Window.unboundedPreceding, 0)).alias("on_or_after"),
                        F.min("idx").over(later.rangeBetween(Window.unboundedPreceding, -1)).alias("after"))
    return found.groupBy("date").agg(F.min("on_or_after").alias("on_or_after"), F.min("after").alias("after"))


def day_lookup(sessions: DataFrame) -> DataFrame:
    """For every calendar day inside the session range: first session on or after it, and after it."""
    span = sessions.agg(F.min("date").alias("low"), F.max("date").alias("high"))
    return session_after(span.select(F.explode(F.sequence("low", "high")).alias("date")), sessions)


ASIDE = -1_000_000_000  # session position of events that are not measured


def reactions(events: DataFrame, bars: DataFrame, sessions: DataFrame, market: str = "US") -> DataFrame:
    """Price reaction of every open event; settled and revised events keep what they have.

    Events are laid among the bars of their security on the session axis and read the bars
    around them through range frames: one shuffle by security, no join on sessions, and
    missing sessions stay missing. Events and bars are read once.
    """
    due = (~F.coalesce(F.col("event_status") == "REVISED", F.lit(False))
           & (F.col("reaction_status").isNull() | F.col("reaction_status").isin(*OPEN_REACTIONS)))
    lookup = F.broadcast(day_lookup(sessions).withColumnRenamed("date", "report_date"))
    first, last = sessions.agg(F.min("date")).scalar(), sessions.agg(F.max("idx")).scalar()
    start = F.col("after")
    if market == "US":
        start = F.when(F.col("session") == "BMO", F.col("on_or_after")).otherwise(start)
    start = F.when(F.col("report_date") < first, F.lit(0).cast("bigint")).otherwise(start)
    placed = events.join(lookup, "report_date", "left").select(
        *events.columns, due.alias("due"), F.when(due, start).alias("at"))
    carried = [c for c in placed.columns if c != "security_id"]
    payload = F.struct(*carried)
    lane = bars.join(F.broadcast(sessions), "date").select(
        "security_id", "idx", "open", "close", "volume",
        F.lit(None).cast(placed.select(payload).schema[0].dataType).alias("event"))
    seats = placed.select(
        "security_id", F.coalesce("at", F.lit(ASIDE)).cast("bigint").alias("idx"),
        *[F.lit(None).cast("double").alias(c) for c in ("open", "close", "volume")], payload.alias("event"))
    axis = Window.partitionBy("security_id").orderBy("idx")

    def at(name, begin, end=None, how=F.max):
        return how(name).over(axis.rangeBetween(begin, begin if end is None else end))

    seen = lane.unionByName(seats).select(
        "security_id", "idx", "event", at("close", -1).alias("before"), at("open", 0).alias("bar_open"),
        at("close", 0).alias("bar_close"), at("volume", 0).alias("bar_volume"),
        at("volume", -20, -1, F.count).alias("volumes"), at("volume", -20, -1, F.sum).alias("volume_sum"),
        at("close", 5).alias("close_5")).filter(F.col("event").isNotNull())
    rows = (seen.join(F.broadcast(sessions.select(F.col("date").alias("reaction_date"), "idx")), "idx", "left")
            .select("*", "event.*").drop("event"))
    close, measured = F.col("before"), F.col("at").isNotNull()
    priced = F.coalesce(measured & (close > 0) & F.col("bar_close").isNotNull(), F.lit(False))
    base = F.when(F.col("volumes") == 20, F.col("volume_sum") / 20)
    ratio = F.when(base > 0, F.col("bar_volume") / F.nullif(base, F.lit(0.0)))
    later = F.col("at") + 5 <= last
    day5 = F.when(later, ratio_change(F.col("close_5"), close))

    def only(value):
        return F.when(priced, value)

    status = (F.when(~F.col("due"), F.col("reaction_status")).when(~measured, "PENDING_PRICE").when(~priced, "PRICE_MISSING")
              .when(day5.isNotNull() & ratio.isNotNull(), "COMPLETE").otherwise("PARTIAL"))
    kept = [c for c in events.columns if c not in ("security_id", "reaction_status")]
    return rows.select(
        "security_id", *kept, F.when(measured, F.col("reaction_date")).alias("reaction_date"),
        F.when(measured, close).alias("prev_close"),
        only(ratio_change(F.col("bar_open"), close)).alias("gap_pct"),
        only(ratio_change(F.col("bar_close"), close)).alias("day1_pct"),
        only(day5).alias("day5_pct"), only(ratio).alias("day1_volume_ratio"),
        only(F.when(ratio.isNull(), F.when(F.col("volumes") < 20, "INSUFFICIENT_20_SESSION_VOLUME")
                    .otherwise("ZERO_BASELINE_VOLUME"))).alias("day1_volume_ratio_reason"),
        only(F.when(~later, "PENDING_FIVE_SESSIONS").when(day5.isNull(), "PRICE_MISSING")).alias("day5_reason"),
        status.alias("reaction_status"))


def history_violations(previous_ids: DataFrame, history: DataFrame, active: DataFrame, market: str) -> DataFrame:
    """Rows for every broken rule of a history transition; empty when it is sound."""
    known = previous_ids.select("event_id").distinct()
    duplicate = (history.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                 .select("event_id", F.lit("DUPLICATE_EVENT").alias("error")))
    removed = (known.join(history.select("event_id"), "event_id", "left_anti")
               .select("event_id", F.lit("EVENT_REMOVED").alias("error")))
    expected = F.concat_ws(":", "security_id", F.col("report_date").cast("string"))
    wrong = history.filter(~(F.col("security_id").startswith(market + "-") & (F.col("event_id") == expected))).select(
        "event_id", F.lit("IDENTITY_MISMATCH").alias("error"))
    inactive = (history.join(active.select("security_id"), "security_id", "left_anti")
                .join(known, "event_id", "left_anti").select("event_id", F.lit("NEW_INACTIVE_EVENT").alias("error")))
    return duplicate.unionByName(removed).unionByName(wrong).unionByName(inactive).distinct()


def classify_sectors(active: DataFrame, screener: DataFrame, filings: DataFrame, prior: DataFrame | None = None,
                     source_failed: bool = False) -> DataFrame:
    """Sector and industry of each active security: screener first, then the filing code.

    `screener`: symbol, sector, industry. `filings`: symbol, sic (null when none is
    published), sic_description. `prior`: security_id, sector, industry, sic_code, changes.
    """
    key = us_ticker_key(F.col("ticker"))
    targets = active.select("security_id", "ticker", key.alias("key"))
    shared = targets.groupBy("key").agg(F.count(F.lit(1)).alias("ids"))
    listed = screener.withColumn("key", us_ticker_key(F.col("symbol"))).groupBy("key").agg(
        F.count(F.lit(1)).alias("source_rows"), F.first("sector").alias("src_sector"), F.first("industry").alias("src_industry"))
    filed = filings.withColumn("key", us_ticker_key(F.col("symbol"))).groupBy("key").agg(
        F.max("sic").alias("sic"), F.max_by("sic_description", "sic").alias("sic_description"), F.lit(True).alias("filed"))
    rows = targets.join(shared, "key", "left").join(listed, "key", "left").join(filed, "key", "left")
    ambiguous = F.coalesce((F.col("ids") > 1) | (F.col("source_rows") > 1), F.lit(False))
    sector, industry = (F.when(~ambiguous, F.nullif(F.col(c), F.lit(""))) for c in ("src_sector", "src_industry"))
    primary = sector.isNotNull() & industry.isNotNull()
    from_filing = ~primary & F.col("sic").isNotNull()
    source = F.when(primary, "NASDAQ").when(from_filing, "SEC_SIC")
    missing = "SOURCE_UNAVAILABLE" if source_failed else "NO_SOURCE_MATCH"
    reason = F.when(source.isNull(), F.when(F.col("filed") & F.col("sic").isNull(), "SEC_SIC_NOT_PUBLISHED").otherwise(missing))
    rows = rows.select(
        "security_id", "ticker", F.coalesce(sector, F.lit("UNCLASSIFIED")).alias("sector"),
        F.coalesce(F.when(from_filing, F.col("sic_description")), industry, F.lit("UNCLASSIFIED")).alias("industry"),
        F.when(from_filing, F.col("sic")).alias("sic_code"), source.alias("source"), reason.alias("reason"),
        ambiguous.alias("ambiguous"))
    return with_change_log(rows, prior, ["sector", "industry", "sic_code"])


def classify_industries(active: DataFrame, members: DataFrame, prior: DataFrame | None = None,
                        source_failed: bool = False) -> DataFrame:
    """Industry of each active security from index membership; two memberships are ambiguous.

    `members`: code, industry_symbol, industry, subsector.
    """
    targets = active.select("security_id", hk_ticker_key(F.col("ticker")).alias("code"))
    shared = targets.groupBy("code").agg(F.count(F.lit(1)).alias("ids"))
    found = members.groupBy("code").agg(
        F.count(F.lit(1)).alias("memberships"), *[F.min(c).alias(c) for c in ("industry_symbol", "industry", "subsector")])
    rows = targets.join(shared, "code", "left").join(found, "code", "left")
    ambiguous = F.coalesce((F.col("ids") > 1) | (F.col("memberships") > 1), F.lit(False))
    usable = F.col("memberships").isNotNull() & ~ambiguous
    missing = "INDUSTRY_SOURCE_INCOMPLETE" if source_failed else "NOT_IN_HSICS"
    rows = rows.select(
        "security_id", "code", F.when(usable, F.col("industry_symbol")).alias("industry_symbol"),
        F.when(usable, F.col("industry")).otherwise("UNCLASSIFIED").alias("industry"),
        F.when(usable, F.col("subsector")).alias("subsector"), F.when(usable, "AASTOCKS_HSICS").alias("source"),
        F.when(~usable, missing).alias("reason"), ambiguous.alias("ambiguous"))
    return with_change_log(rows, prior, ["industry", "subsector"])


def with_change_log(rows: DataFrame, prior: DataFrame | None, fields: list[str]) -> DataFrame:
    """Append a change entry (old, new) where the fields differ from the prior record."""
    if prior is None:
        return rows
    old = prior.select("security_id", F.struct(*fields).alias("old"), "changes")
    now = F.struct(*fields)
    joined = rows.join(old, "security_id", "left")
    entry = F.struct(F.col("old").alias("old"), now.alias("new"))
    empty = F.array().cast(joined.select(F.array(entry)).schema[0].dataType)
    kept = F.coalesce(F.col("changes"), empty)
    changed = F.col("old").isNotNull() & ~F.col("old").eqNullSafe(now)
    return joined.select(*rows.columns, F.when(changed, F.array_append(kept, entry)).otherwise(kept).alias("changes"))


def completeness(wanted: DataFrame, cached: DataFrame, fetched: DataFrame, today) -> DataFrame:
    """Per wanted date: reused, fetched or missing. Near dates are reused on the same day only,
    farther ones for up to seven days."""
    today = F.lit(today).cast("date")
    rows = (wanted.select("date").join(cached.select("date", "fetched_on"), "date", "left")
            .join(fetched.select("date", F.lit(True).alias("fetched")), "date", "left"))
    age = F.datediff(today, "fetched_on")
    allowed = F.when(F.datediff("date", today) <= 14, 0).otherwise(7)
    reused = F.coalesce((age >= 0) & (age <= allowed), F.lit(False))
    return rows.select("date", F.when(reused, "REUSED").when(F.col("fetched"), "FETCHED").otherwise("MISSING").alias("state"))


def completeness_summary(states: DataFrame, source_errors: int = 0) -> DataFrame:
    return states.agg(F.count(F.when(F.col("state") == "REUSED", 1)).alias("reused"),
                      F.count(F.when(F.col("state") == "FETCHED", 1)).alias("fetched"),
                      F.count(F.lit(1)).alias("wanted")).withColumn(
        "complete", (F.col("reused") + F.col("fetched") == F.col("wanted")) & F.lit(source_errors == 0))


def freshness(daily: Column, enriched: Column) -> Column:
    return (F.when(enriched.isNull(), "NOT_RECORDED").when(enriched == daily, "CURRENT")
            .when(enriched < daily, "BEHIND").otherwise("RECEIPT_CONFLICT"))
