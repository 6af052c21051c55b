"""Reconciling known securities with official listings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.text import exchange_code, hk_ticker, listing_exclusion
from barloom.operators.ordering import with_running_total
from barloom.operators.universe import is_active
from barloom.session import stage


def hk_listing(rows: DataFrame) -> DataFrame:
    """Main-board and GEM company shares in HKD; a bad board lot is kept with an error.

    Input: code, name, category, sub_category, currency, isin, board_lot (text).
    """
    board = F.lower(F.trim("sub_category"))
    kept = rows.filter((F.lower(F.trim("category")) == "equity")
                       & (board.contains("main board") | board.contains("gem"))
                       & (F.upper(F.trim("currency")) == "HKD")
                       & ~F.upper(F.trim("name")).contains("PREF"))
    code = F.col("code").cast("string")
    padded = F.when(F.length(code) < 5, F.lpad(code, 5, "0")).otherwise(code)
    lot = F.replace(F.trim("board_lot"), F.lit(","), F.lit("")).try_cast("double").cast("bigint")
    good = F.coalesce(lot > 0, F.lit(False))
    return kept.select(padded.alias("source_symbol"), hk_ticker(F.col("code")).alias("ticker"),
                       F.lit("HKEX").alias("exchange"), "name", "isin", F.when(good, lot).alias("board_lot_size"),
                       F.when(~good, "OFFICIAL_HK_BOARD_LOT_INVALID").alias("error"))


def us_listing(rows: DataFrame, exclude: bool = True) -> DataFrame:
    """Common shares out of the official symbol files.

    Input: file, symbol, name, etf, test_issue, exchange (one letter, null in the first
    file), sequence. The last row of a symbol counts. `exclude=False` keeps every symbol.
    """
    venue = F.when(F.col("file").startswith("nasdaq"), "NASDAQ")
    for letter, name in K.LISTED_EXCHANGES.items():
        venue = venue.when(F.col("exchange") == letter, name)
    kept = rows.filter(F.col("symbol") != "").withColumn("venue", venue)
    if exclude:
        kept = kept.filter((F.col("etf") == "N") & (F.col("test_issue") == "N")
                           & listing_exclusion(F.col("name")).isNull()
                           & F.col("venue").isin("NASDAQ", "NYSE", "NYSE_AMERICAN"))
    payload = F.struct("file", "name", "venue")
    return (kept.groupBy("symbol").agg(F.max_by(payload, F.struct("file", "sequence")).alias("row"))
            .select(F.col("symbol").alias("source_symbol"), F.replace("symbol", F.lit("."), F.lit("-")).alias("ticker"),
                    F.col("row.venue").alias("exchange"), F.col("row.name").alias("name"), F.col("row.file").alias("file")))


def excluded_active(securities: DataFrame) -> DataFrame:
    """Active securities whose name is excluded, with the values before and after."""
    code = listing_exclusion(F.col("name"))
    return securities.filter(is_active(default=False) & code.isNotNull()).select(
        "security_id", "name", F.col("listing_status").alias("before_status"), code.alias("after_status"),
        F.lit("EXCLUDED").alias("review_status"), F.lit("OFFICIAL_LISTING_SECURITY_TYPE_EXCLUDED").alias("exclusion_reason"))


def present(text: Column) -> Column:
    """The trimmed text; null where nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def listing_missing(known: DataFrame, observed: DataFrame) -> DataFrame:
    """Active known securities whose symbol the source does not list."""
    return known.filter(is_active(default=False)).join(
        observed.select("symbol"), "symbol", "left_anti").select("security_id", "symbol")


def shrink_guard(known: DataFrame, observed: DataFrame, floor: int = K.SHRINK_FLOOR, share: float = K.SHRINK_SHARE) -> DataFrame:
    """A violation row when so many are missing, more than `floor` and than `share` of all, that the source must be incomplete."""
    active = known.filter(is_active(default=False)).select("symbol").distinct()
    flagged = active.join(observed.select("symbol", F.lit(1).alias("seen")).distinct(), "symbol", "left")
    counts = flagged.agg(F.count(F.lit(1)).alias("listed"),
                         F.count(F.when(F.col("seen").isNull(), 1)).alias("missing"))
    limit = F.greatest(F.lit(float(floor)), F.col("listed") * share)
    return counts.select("listed", "missing", F.when(F.col("missing") > limit, "OFFICIAL_LIST_SHRINK_GUARD").alias("error"))


def universe_refresh(known: DataFrame, observed: DataFrame, market: str) -> DataFrame:
    """What a listing refresh does to every known and every observed symbol.

    `known`: security_id, symbol, name, isin, ticker, listing_status, sequence.
    `observed`: symbol, name, isin, ticker, exchange, sequence (source order, unique symbol).
    One row per decision: UPDATED, ISIN_CHANGED, NAME_CHANGED, REBOUND (same ISIN under a
    new ticker), NEW with the next identifiers in source order, ABSENT.
    """
    fields = F.struct("security_id", "name", "isin", "ticker", "listing_status", "sequence")
    latest = known.groupBy("symbol").agg(F.max_by(fields, "sequence").alias("sec"))
    seen = observed.select("symbol", F.struct("name", "isin", "ticker", "exchange", "sequence").alias("entry"))
    matched = latest.join(seen, "symbol", "full")
    sec, entry = F.col("sec"), F.col("entry")
    isin_changed = F.coalesce(present(sec["isin"]) != present(entry["isin"]), F.lit(False)) & F.lit(market == "HK")
    name_changed = F.coalesce(F.lower(present(sec["name"])) != F.lower(present(entry["name"])), F.lit(False)) & F.lit(market == "US")
    both = matched.filter(sec.isNotNull() & entry.isNotNull()).select(
        sec["security_id"].alias("security_id"), "symbol", entry["ticker"].alias("ticker"),
        sec["listing_status"].alias("listing_status"),
        F.when(isin_changed, "ISIN_CHANGED").when(name_changed, "NAME_CHANGED").otherwise("UPDATED").alias("decision"))
    unknown = matched.filter(sec.isNull()).select("symbol", "entry.*")
    absent = listing_missing(known, observed)
    rebound = _rebound(known, unknown, absent) if market == "HK" else None
    if rebound is not None:
        unknown = unknown.join(rebound.select("symbol"), "symbol", "left_anti")
        absent = absent.join(rebound.select("security_id"), "security_id", "left_anti")
    top = known.agg(F.coalesce(F.max(F.substring_index("security_id", "-", -1).cast("bigint")), F.lit(0).cast("bigint"))).scalar()
    numbered = with_running_total(unknown, [F.col("sequence").asc(), F.col("symbol").asc()], name="place")
    new = numbered.select(
        F.concat(F.lit(market + "-"), F.format_string("%06d", top + F.col("place"))).alias("security_id"),
        "symbol", "ticker", F.lit("ACTIVE").alias("listing_status"), F.lit("NEW").alias("decision"))
    gone = absent.select("security_id", "symbol", F.lit(None).cast("string").alias("ticker"),
                         F.lit("ACTIVE").alias("listing_status"), F.lit("ABSENT").alias("decision"))
    out = both.unionByName(new).unionByName(gone)
    return out if rebound is None else out.unionByName(rebound)


REVIEWS = {"ISIN_CHANGED": "ISIN_CHANGED", "NAME_CHANGED": "NAME_CHANGED", "REBOUND": "OFFICIAL_ISIN_SAME_NEW_TICKER", "ABSENT": "ABSENT_OFFICIAL_SNAPSHOT"}


def refreshed_universe(known: DataFrame, observed: DataFrame, market: str, floor: int = K.SHRINK_FLOOR, share: float = K.SHRINK_SHARE) -> tuple[DataFrame, DataFrame]:
    """The universe after a listing refresh, and the review items it gives rise to.

    A matched or rebound security takes over what the list says (symbol, name, ISIN, ticker, exchange) but keeps its listing
    status: presence lifts no gate. A changed identity and an absent security stay as they are and go to review. New ones are
    whole rows. A list from which too many are missing (`shrink_guard`) stops the job, before anything is changed.
    """
    decisions = stage(universe_refresh(known, observed, market))
    broken = shrink_guard(known, observed, floor, share).select("error").scalar()
    decisions = decisions.filter(F.when(broken.isNotNull(), F.raise_error(broken).cast("boolean")).otherwise(F.lit(True)))
    told = ("name", "isin", "ticker", "exchange")
    entries = observed.select(F.col("symbol").alias("new_symbol"), F.struct(*told).alias("entry"))
    decided = decisions.select("security_id", F.col("symbol").alias("new_symbol"), "decision").join(entries, "new_symbol", "left")
    takes = F.col("decision").isin("UPDATED", "REBOUND", "NEW")

    def value(name, old):
        return F.when(takes, F.col(f"entry.{name}")).otherwise(old).alias(name)

    def text(name):
        return F.col(name) if name in known.columns else F.lit(None).cast("string")
    currency = F.lit("HKD" if market == "HK" else "USD")
    stays = known.join(decided.filter("decision <> 'NEW'"), "security_id", "left").select(
        "security_id", F.when(takes, F.col("new_symbol")).otherwise(F.col("symbol")).alias("symbol"), *[value(c, text(c)) for c in told],
        F.coalesce(text("currency"), currency).alias("currency"), F.lit(market).alias("market"), "listing_status", text("security_id_origin").alias("security_id_origin"),
        text("history_status").alias("history_status"), F.when(F.col("decision") == "ABSENT", "LISTING_STATUS_REVIEW").otherwise(text("review_status")).alias("review_status"))
    new = decided.filter("decision = 'NEW'").select(
        "security_id", F.col("new_symbol").alias("symbol"), *[F.col(f"entry.{c}").alias(c) for c in told], currency.alias("currency"), F.lit(market).alias("market"),
        F.lit("ACTIVE").alias("listing_status"), F.lit("NEW_LISTING").alias("security_id_origin"), F.lit("SHORT_HISTORY").alias("history_status"), F.lit(None).cast("string").alias("review_status"))
    problem = F.create_map(*[F.lit(x) for pair in REVIEWS.items() for x in pair])[F.col("decision")]
    reviews = decisions.select(F.lit(market).alias("market"), "security_id", F.lit("IDENTITY_REVIEW").alias("category"), problem.alias("problem"), F.lit("OPEN").alias("status"))
    return stays.unionByName(new), reviews.filter("problem IS NOT NULL")


def _rebound(known: DataFrame, unknown: DataFrame, absent: DataFrame) -> DataFrame:
    """Absent securities found again by ISIN. The first unknown symbol of an ISIN, by source order, gets the security;
    later ones stay unknown. Blank ISINs are none."""
    single = known.withColumn("isin", present(F.col("isin"))).filter(F.col("isin").isNotNull()).groupBy("isin").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("security_id", "listing_status")).alias("sec")).filter("n = 1")
    missing = absent.select("security_id")
    first = (unknown.withColumn("isin", present(F.col("isin"))).filter(F.col("isin").isNotNull()).groupBy("isin")
             .agg(F.min(F.struct("sequence", "symbol", "ticker")).alias("entry")).select("isin", "entry.symbol", "entry.ticker"))
    return (first.join(single.select("isin", "sec.*"), "isin").join(missing, "security_id", "left_semi")
            .select("security_id", "symbol", "ticker", "listing_status", F.lit("REBOUND").alias("decision")))


def isin_rebind(known: DataFrame, observed: DataFrame) -> DataFrame:
    """Unmatched symbols that are one known security under a new ticker, with the proof."""
    unknown = observed.join(known.select("symbol"), "symbol", "left_anti")
    moved = _rebound(known, unknown, listing_missing(known, observed))
    old = known.select("security_id", F.col("ticker").alias("old_ticker"), "isin")
    return moved.select("security_id", F.col("ticker").alias("new_ticker")).join(old, "security_id").withColumn(
        "kind", F.lit("HK_ISIN_MATCH"))


def shortable(active: DataFrame, designated: DataFrame) -> DataFrame:
    return active.filter(is_active(default=False)).join(designated.select("ticker"), "ticker", "left_semi")


def official_match(securities: DataFrame, official: DataFrame) -> DataFrame:
    """Agreement with the official row on symbol, ticker, exchange and exact name."""
    source = official.select(F.col("source_symbol"), F.col("ticker").alias("o_ticker"),
                             F.col("exchange").alias("o_exchange"), F.col("name").alias("o_name"))
    joined = securities.join(source, "source_symbol", "left")
    agrees = ((F.col("o_ticker") == F.col("ticker"))
              & exchange_code(F.col("o_exchange")).eqNullSafe(exchange_code(F.col("exchange")))
              & (F.trim("o_name") == F.trim(F.coalesce("name", F.lit("")))))
    return joined.select("security_id", F.coalesce(agrees, F.lit(False)).alias("official_ok"))


def board_lot(securities: DataFrame, listing: DataFrame) -> DataFrame:
    """Lot size by code; missing code, other name or other ISIN are error rows."""
    source = listing.select("source_symbol", F.col("name").alias("l_name"), F.col("isin").alias("l_isin"),
                            "board_lot_size", F.lit(True).alias("found"))
    joined = securities.join(source, "source_symbol", "left")
    other_isin = F.coalesce((F.col("isin") != "") & (F.col("l_isin") != "") & (F.trim("isin") != F.trim("l_isin")), F.lit(False))
    error = (F.when(F.col("found").isNull(), "HK_BOARD_LOT_CODE_MISSING")
             .when(~F.trim("l_name").eqNullSafe(F.trim("name")), "HK_BOARD_LOT_NAME_MISMATCH")
             .when(other_isin, "HK_BOARD_LOT_ISIN_MISMATCH"))
    return joined.select("security_id", "source_symbol", F.when(error.isNull(), F.col("board_lot_size")).alias("board_lot_size"),
                         error.alias("error"))


def status_counts(securities: DataFrame) -> DataFrame:
    """Securities per market and listing status, with the quarantine total."""
    quarantined = F.coalesce(F.col("listing_status").isin(*K.QUARANTINE_STATES), F.lit(False))
    return securities.groupBy("market", "listing_status").agg(
        F.count(F.lit(1)).alias("securities"), F.count(F.when(quarantined, 1)).alias("remaining_quarantine"))

