"""Queries: listings, queues, gaps, repairs, calendars and monitoring."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions import dates as DT
from barloom.functions import text as X
from barloom.operators import listing as L
from barloom.operators import monitor as M
from barloom.operators import quality as Q
from barloom.operators import repair as P
from barloom.operators.indicators import session_index
from barloom.operators.universe import is_active
from workload import digests as D
from workload import inputs as W
from workload.registry import cte, day, query, with_ctes

AS_OF, BASE_AS_OF = W.AS_OF, W.BASE_AS_OF


# --- universe and names -----------------------------------------------------------------
@query("active_universe", with_ctes("securities") + """
SELECT security_id, listing_status, coalesce(listing_status, 'ACTIVE') = 'ACTIVE' AS active_by_default,
  coalesce(listing_status = 'ACTIVE', false) AS active_strict FROM securities""")
def active_universe(spark, d):
    return W.securities(spark, d).select("security_id", "listing_status", is_active().alias("active_by_default"),
                                         is_active(default=False).alias("active_strict"))


_NC = "(?i)" + "|".join(rf"\b{w}\b" for w in K.NON_COMMON_WORDS)
_SHARES = "(?i)" + "|".join(rf"\b{w}\b" for w in K.SPAC_SHARE_WORDS)


def _spac(n):
    return (rf"(regexp_matches({n}, '(?i)\bSPAC\b') OR (regexp_matches({n}, '(?i)\bACQUISITION\b') "
            f"AND regexp_matches({n}, '{_SHARES}')))")


def _noncommon(n):
    return f"regexp_matches({n}, '{_NC}')"


cte("names", f"SELECT c_custkey, c_name || ' ' || ({W._TAILS_SQL})[CAST(c_nationkey % {len(W.NAME_TAILS)} + 1 AS INTEGER)] AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer")


def names(spark, d):
    return W.table(spark, d, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" "), W._name_tail(F.col("c_nationkey"))).alias("name"), "c_nationkey",
        "c_acctbal", "c_mktsegment")


@query("name_exclusion", with_ctes("names") + f"""
SELECT c_custkey, name, CASE WHEN {_noncommon('name')} THEN 'EXCLUDED_NON_COMMON' WHEN {_spac('name')} THEN 'EXCLUDED_SPAC' END AS listing_code,
  CASE WHEN {_spac('name')} THEN 'EXCLUDED_SPAC' WHEN {_noncommon('name')} THEN 'EXCLUDED_NON_COMMON' END AS closing_code FROM names""")
def name_exclusion(spark, d):
    return names(spark, d).select("c_custkey", "name", X.listing_exclusion(F.col("name")).alias("listing_code"),
                                  X.closing_exclusion(F.col("name")).alias("closing_code"))


@query("exchange_normalize", with_ctes("securities") + """
SELECT security_id, replace(replace(upper(exchange), ' ', '_'), '-', '_') AS exchange_code FROM securities""")
def exchange_normalize(spark, d):
    return W.securities(spark, d).select("security_id", X.exchange_code(F.col("exchange")).alias("exchange_code"))


@query("excluded_active", with_ctes("securities") + f"""
SELECT security_id, name, listing_status AS before_status, CASE WHEN {_noncommon('name')} THEN 'EXCLUDED_NON_COMMON' ELSE 'EXCLUDED_SPAC' END AS after_status,
  'EXCLUDED' AS review_status, 'OFFICIAL_LISTING_SECURITY_TYPE_EXCLUDED' AS exclusion_reason
FROM securities WHERE listing_status = 'ACTIVE' AND ({_noncommon('name')} OR {_spac('name')})""")
def excluded_active(spark, d):
    return L.excluded_active(W.securities(spark, d))


_LISTING_SQL = """SELECT p_partkey AS code, p_name || CASE WHEN p_brand = 'Brand#7' THEN ' Pref' ELSE '' END AS name,
  CASE WHEN p_type = 'PROMO' THEN 'Debt' ELSE 'Equity' END AS category,
  CASE WHEN p_size > 25 THEN 'Equity Securities (Main Board)' WHEN p_size > 10 THEN 'Equity (GEM)' ELSE 'Investment Companies' END AS sub_category,
  CASE WHEN p_retailprice > 1050 THEN 'RMB' ELSE 'hkd' END AS currency, 'IS' || printf('%08d', p_partkey) AS isin,
  CASE WHEN p_size = 11 THEN '-' ELSE CAST(p_size AS VARCHAR) || ',000' END AS board_lot FROM part"""
cte("hk_source", _LISTING_SQL)
cte("hk_listing", """SELECT CASE WHEN code < 100000 THEN lpad(CAST(code AS VARCHAR), 5, '0') ELSE CAST(code AS VARCHAR) END AS source_symbol,
  printf('%04d', code) || '.HK' AS ticker, 'HKEX' AS exchange, name, isin,
  CAST(try_cast(replace(board_lot, ',', '') AS DOUBLE) AS BIGINT) AS board_lot_size,
  CASE WHEN board_lot = '-' THEN 'OFFICIAL_HK_BOARD_LOT_INVALID' END AS error FROM hk_source
WHERE category = 'Equity' AND sub_category <> 'Investment Companies' AND currency = 'hkd' AND name NOT LIKE '%Pref'""", "hk_source")


def hk_source(spark, d):
    return W.table(spark, d, "part").select(
        F.col("p_partkey").alias("code"), F.concat("p_name", F.when(F.col("p_brand") == "Brand#7", " Pref").otherwise("")).alias("name"),
        F.when(F.col("p_type") == "PROMO", "Debt").otherwise("Equity").alias("category"),
        F.when(F.col("p_size") > 25, "Equity Securities (Main Board)").when(F.col("p_size") > 10, "Equity (GEM)")
        .otherwise("Investment Companies").alias("sub_category"),
        F.when(F.col("p_retailprice") > 1050, "RMB").otherwise("hkd").alias("currency"),
        F.concat(F.lit("IS"), F.format_string("%08d", "p_partkey")).alias("isin"),
        F.when(F.col("p_size") == 11, "-").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(",000"))).alias("board_lot"))


@query("hk_listing_filter", with_ctes("hk_listing") + "SELECT * FROM hk_listing")
def hk_listing_filter(spark, d):
    return L.hk_listing(hk_source(spark, d))


# Known symbols are suppliers; the observed list is the customers in good standing.
cte("known", """SELECT security_id, 'C' || s_suppkey AS symbol, CASE WHEN s_acctbal > 9500 THEN ' ' ELSE 'Customer#' || printf('%09d', s_suppkey) || CASE WHEN s_acctbal > 8000 THEN ' Inc' ELSE '' END END AS name,
  CASE WHEN s_acctbal BETWEEN 6500 AND 7000 THEN '' ELSE 'I' || CASE WHEN s_acctbal > 7000 THEN s_suppkey + 1000000 ELSE s_suppkey END END AS isin, ticker, listing_status, s_suppkey AS sequence FROM securities""", "securities")
cte("observed", """SELECT 'C' || c_custkey AS symbol, c_name AS name, 'I' || c_custkey AS isin, 'T' || c_custkey AS ticker, 'NYSE' AS exchange, c_custkey AS sequence
FROM customer WHERE c_acctbal >= 0""")
cte("renamed", """SELECT 'R' || c_custkey AS symbol, c_name AS name, 'I' || c_custkey AS isin, 'T' || c_custkey AS ticker, 'HKEX' AS exchange, c_custkey AS sequence
FROM customer WHERE c_acctbal < 0 UNION ALL
  SELECT 'D' || c_custkey, c_name, 'I' || c_custkey, 'D' || c_custkey, 'HKEX', c_custkey + 10000000 FROM customer WHERE c_acctbal < -300 UNION ALL SELECT * FROM observed""", "observed")


def known(spark, d):
    s = W.securities(spark, d)
    key = F.col("s_suppkey")
    return s.select("security_id", F.concat(F.lit("C"), key).alias("symbol"),
                    F.when(F.col("s_acctbal") > 9500, " ").otherwise(
                        F.concat(F.lit("Customer#"), F.format_string("%09d", key), F.when(F.col("s_acctbal") > 8000, " Inc").otherwise(""))).alias("name"),
                    F.when(F.col("s_acctbal").between(6500, 7000), "").otherwise(
                        F.concat(F.lit("I"), F.when(F.col("s_acctbal") > 7000, key + 1000000).otherwise(key))).alias("isin"),
                    "ticker", "listing_status", key.alias("sequence"))


def observed(spark, d, renamed=False):
    c = W.table(spark, d, "customer")

    def shape(rows, letter, venue, ticker="T", later=0):
        return rows.select(F.concat(F.lit(letter), "c_custkey").alias("symbol"), F.col("c_name").alias("name"),
                           F.concat(F.lit("I"), "c_custkey").alias("isin"), F.concat(F.lit(ticker), "c_custkey").alias("ticker"),
                           F.lit(venue).alias("exchange"), (F.col("c_custkey") + later).alias("sequence"))
    good = shape(c.filter("c_acctbal >= 0"), "C", "NYSE")
    if not renamed:
        return good
    twice = shape(c.filter("c_acctbal < -300"), "D", "HKEX", "D", 10_000_000)  # a second symbol with the same ISIN
    return good.unionByName(shape(c.filter("c_acctbal < 0"), "R", "HKEX")).unionByName(twice)


cte("absent", "SELECT security_id, symbol FROM known WHERE listing_status = 'ACTIVE' AND symbol NOT IN (SELECT symbol FROM observed)", "known", "observed")


@query("listing_missing", with_ctes("absent") + "SELECT * FROM absent")
def listing_missing(spark, d):
    return L.listing_missing(known(spark, d), observed(spark, d))


@query("listing_shrink_guard", with_ctes("absent") + """
SELECT listed, missing, CASE WHEN missing > greatest(25, listed * 0.05) THEN 'OFFICIAL_LIST_SHRINK_GUARD' END AS error
FROM (SELECT (SELECT count(DISTINCT symbol) FROM known WHERE listing_status = 'ACTIVE') AS listed, (SELECT count(*) FROM absent) AS missing) t""")
def listing_shrink_guard(spark, d):
    return L.shrink_guard(known(spark, d), observed(spark, d))


@query("universe_refresh", with_ctes("absent") + """
SELECT k.security_id, k.symbol, o.ticker, k.listing_status, CASE WHEN lower(nullif(trim(k.name), '')) <> lower(nullif(trim(o.name), '')) THEN 'NAME_CHANGED' ELSE 'UPDATED' END AS decision
FROM known k JOIN observed o USING (symbol)
UNION ALL SELECT printf('US-%06d', (SELECT max(CAST(substr(security_id, 4) AS BIGINT)) FROM known) + row_number() OVER (ORDER BY sequence, symbol)), symbol, ticker, 'ACTIVE', 'NEW'
FROM observed WHERE symbol NOT IN (SELECT symbol FROM known)
UNION ALL SELECT security_id, symbol, NULL, 'ACTIVE', 'ABSENT' FROM absent""")
def universe_refresh(spark, d):
    return L.universe_refresh(known(spark, d), observed(spark, d), "US")


# The list here is of customers, so far more are missing than the guard allows: its share is set higher.
@query("universe_refreshed", with_ctes("absent") + """
, x AS (SELECT k.*, o.name AS oname, o.isin AS oisin, o.ticker AS oticker, o.exchange AS oexchange, coalesce(lower(nullif(trim(k.name), '')) <> lower(nullif(trim(o.name), '')), false) AS changed, o.symbol IS NOT NULL AS seen
  FROM known k LEFT JOIN observed o USING (symbol))
SELECT security_id, symbol, CASE WHEN seen AND NOT changed THEN oname ELSE name END AS name, CASE WHEN seen AND NOT changed THEN oisin ELSE isin END AS isin, CASE WHEN seen AND NOT changed THEN oticker ELSE ticker END AS ticker,
  CASE WHEN seen AND NOT changed THEN oexchange END AS exchange, 'USD' AS currency, 'US' AS market, listing_status, NULL AS security_id_origin, NULL AS history_status,
  CASE WHEN NOT seen AND listing_status = 'ACTIVE' THEN 'LISTING_STATUS_REVIEW' END AS review_status FROM x
UNION ALL SELECT printf('US-%06d', (SELECT max(CAST(substr(security_id, 4) AS BIGINT)) FROM known) + row_number() OVER (ORDER BY sequence, symbol)), symbol, name, isin, ticker, exchange, 'USD', 'US', 'ACTIVE', 'NEW_LISTING', 'SHORT_HISTORY', NULL
FROM observed WHERE symbol NOT IN (SELECT symbol FROM known)""")
def universe_refreshed(spark, d):
    return L.refreshed_universe(known(spark, d), observed(spark, d), "US", share=1.0)[0]


cte("rebound", """SELECT k.security_id, o.symbol, o.ticker, k.listing_status, k.ticker AS old_ticker, k.isin FROM renamed o JOIN known k USING (isin)
WHERE o.symbol NOT IN (SELECT symbol FROM known) AND k.listing_status = 'ACTIVE' AND k.symbol NOT IN (SELECT symbol FROM renamed)
  AND k.isin <> '' AND k.isin IN (SELECT isin FROM known GROUP BY 1 HAVING count(*) = 1)
QUALIFY row_number() OVER (PARTITION BY k.isin ORDER BY o.sequence, o.symbol) = 1""", "renamed", "known")


@query("universe_refresh_isin", with_ctes("rebound") + """
SELECT k.security_id, k.symbol, o.ticker, k.listing_status, CASE WHEN nullif(trim(k.isin), '') <> nullif(trim(o.isin), '') THEN 'ISIN_CHANGED' ELSE 'UPDATED' END AS decision
FROM known k JOIN renamed o USING (symbol)
UNION ALL SELECT security_id, symbol, ticker, listing_status, 'REBOUND' FROM rebound
UNION ALL SELECT printf('HK-%06d', (SELECT max(CAST(substr(security_id, 4) AS BIGINT)) FROM known) + row_number() OVER (ORDER BY sequence, symbol)), symbol, ticker, 'ACTIVE', 'NEW'
FROM renamed WHERE symbol NOT IN (SELECT symbol FROM known) AND symbol NOT IN (SELECT symbol FROM rebound)
UNION ALL SELECT security_id, symbol, NULL, 'ACTIVE', 'ABSENT' FROM known WHERE listing_status = 'ACTIVE' AND symbol NOT IN (SELECT symbol FROM renamed)
  AND security_id NOT IN (SELECT security_id FROM rebound)""")
def universe_refresh_isin(spark, d):
    return L.universe_refresh(known(spark, d), observed(spark, d, True), "HK")


@query("isin_rebind", with_ctes("rebound") + """
SELECT security_id, old_ticker, ticker AS new_ticker, isin, 'HK_ISIN_MATCH' AS kind FROM rebound""")
def isin_rebind(spark, d):
    return L.isin_rebind(known(spark, d), observed(spark, d, True))


@query("shortable_semi", with_ctes("securities") + """
SELECT security_id, ticker FROM securities WHERE listing_status = 'ACTIVE'
  AND ticker IN (SELECT 'N' || c_nationkey || '.' || (c_custkey // 4) FROM customer)""")
def shortable_semi(spark, d):
    designated = W.table(spark, d, "customer").select(
        F.concat(F.lit("N"), "c_nationkey", F.lit("."), F.floor(F.col("c_custkey") / 4).cast("bigint")).alias("ticker"))
    return L.shortable(W.securities(spark, d), designated).select("security_id", "ticker")


cte("official", """SELECT 'C' || c_custkey AS source_symbol, 'N' || c_nationkey || '.' || (c_custkey // 4) AS ticker, 'NYSE_AMERICAN' AS exchange,
  'NATION_' || c_nationkey || ' Holdings Ltd ' AS name, 'IS' || printf('%08d', c_custkey + CASE WHEN c_acctbal > 9000 THEN 1 ELSE 0 END) AS isin,
  c_nationkey * 100 AS board_lot_size FROM customer WHERE c_acctbal > -500""")
cte("own", "SELECT *, 'C' || s_suppkey AS source_symbol FROM securities", "securities")


def official(spark, d):
    return W.table(spark, d, "customer").filter("c_acctbal > -500").select(
        F.concat(F.lit("C"), "c_custkey").alias("source_symbol"),
        F.concat(F.lit("N"), "c_nationkey", F.lit("."), F.floor(F.col("c_custkey") / 4).cast("bigint")).alias("ticker"),
        F.lit("NYSE_AMERICAN").alias("exchange"), F.concat(F.lit("NATION_"), "c_nationkey", F.lit(" Holdings Ltd ")).alias("name"),
        F.concat(F.lit("IS"), F.format_string("%08d", F.col("c_custkey") + F.when(F.col("c_acctbal") > 9000, 1).otherwise(0))).alias("isin"),
        (F.col("c_nationkey") * 100).alias("board_lot_size"))


def own(spark, d):
    return W.securities(spark, d).withColumn("source_symbol", F.concat(F.lit("C"), "s_suppkey"))


@query("official_match", with_ctes("own", "official") + """
SELECT security_id, coalesce(o.ticker = s.ticker AND upper(replace(replace(o.exchange, ' ', '_'), '-', '_')) = upper(replace(replace(s.exchange, ' ', '_'), '-', '_'))
  AND trim(o.name) = trim(s.name), false) AS official_ok FROM own s LEFT JOIN official o USING (source_symbol)""")
def official_match(spark, d):
    return L.official_match(own(spark, d), official(spark, d))


@query("board_lot_apply", with_ctes("own", "official") + """
SELECT security_id, source_symbol, CASE WHEN error IS NULL THEN board_lot_size END AS board_lot_size, error FROM (
  SELECT s.security_id, source_symbol, o.board_lot_size, CASE WHEN o.name IS NULL THEN 'HK_BOARD_LOT_CODE_MISSING' WHEN trim(o.name) <> trim(s.name) THEN 'HK_BOARD_LOT_NAME_MISMATCH'
    WHEN s.isin <> o.isin THEN 'HK_BOARD_LOT_ISIN_MISMATCH' END AS error FROM own s LEFT JOIN official o USING (source_symbol)) t""")
def board_lot_apply(spark, d):
    return L.board_lot(own(spark, d), official(spark, d))


@query("status_counts", with_ctes("securities") + """
SELECT market, listing_status, count(*) AS securities, count(*) FILTER (listing_status LIKE 'QUARANTINED%') AS remaining_quarantine FROM securities GROUP BY 1, 2""")
def status_counts(spark, d):
    return L.status_counts(W.securities(spark, d))


# --- stored bars, gaps and flags -----------------------------------------------------------
cte("flawed", "SELECT security_id, date, open, high, CASE WHEN volume = 50 THEN -low ELSE low END AS low, close, volume FROM bars", "bars")
cte("refreshed", f"SELECT security_id, date, {W.BAR_SQL} FROM trades WHERE l_returnflag = 'A' GROUP BY 1, 2", "trades")
_GOOD = "(least(open, high, low, close) > 0 AND volume >= 0 AND high >= greatest(open, close, low) AND low <= least(open, close))"


def flawed(spark, d):
    """Stored bars in which full single lots carry a bad low."""
    return W.supplier_bars(spark, d).withColumn("low", F.when(F.col("volume") == 50, -F.col("low")).otherwise(F.col("low")))


def refreshed(spark, d):
    return W.by_supplier(W.trades(spark, d).filter("l_returnflag = 'A'"))


def sessions(spark, d):
    return session_index(W.calendar(spark, d))


@query("last_stored_bar", with_ctes("securities", "appended") + f"""
SELECT s.security_id, {day("greatest(CASE WHEN security_id_origin IS DISTINCT FROM 'NEW_LISTING' THEN DATE '" + str(BASE_AS_OF) + "' END, max(a.date))", 'last_date')}
FROM securities s LEFT JOIN appended a ON a.security_id = s.security_id GROUP BY s.security_id, security_id_origin""")
def last_stored_bar(spark, d):
    return Q.last_stored(W.securities(spark, d), W.appended_bars(spark, d), BASE_AS_OF)


@query("duplicate_stored_keys", with_ctes("trades") + f"""
SELECT security_id, {day('date', 'date')}, count(*) AS copies, 'DAILY_DUPLICATE_STORED' AS error FROM trades GROUP BY security_id, trades.date HAVING count(*) > 1""")
def duplicate_stored_keys(spark, d):
    return Q.duplicate_keys(W.trades(spark, d))


@query("market_outage", with_ctes("securities", "daily_bars", "calendar") + f"""
, act AS (SELECT security_id FROM securities WHERE coalesce(listing_status, 'ACTIVE') = 'ACTIVE'),
t AS (SELECT (SELECT count(*) FROM act) AS active),
h AS (SELECT date, count(DISTINCT security_id) AS available FROM daily_bars SEMI JOIN act USING (security_id) GROUP BY 1)
SELECT {day('date', 'date')}, coalesce(available, 0) AS available, active,
  CASE WHEN (active - coalesce(available, 0)) / active >= 0.8 THEN 'MARKET_WIDE_DATA_UNAVAILABLE' ELSE 'COMPLETE' END AS status
FROM (SELECT DISTINCT date FROM daily_bars) c LEFT JOIN h USING (date), t""")
def market_outage(spark, d):
    daily = W.daily_bars(spark, d)
    return Q.market_outage(W.securities(spark, d), daily, daily.select("date"))


# Queue: events are problems, the user is the security, the property picks the session.
cte("items", """SELECT event_id AS item_id, CASE WHEN value > 80 THEN 'HK' ELSE 'US' END AS market, printf('US-%06d', user_id + 1) AS security_id,
  CASE event_type WHEN 'click' THEN 'DATA_SUSPECT' WHEN 'error' THEN 'FETCH_FAILED' WHEN 'view' THEN 'IDENTITY_REVIEW' WHEN 'purchase' THEN 'SUSPECT_DELISTED' ELSE 'DATA_SUSPECT' END AS category,
  CASE WHEN value > 90 THEN 'OFFICIAL_ISIN_SAME_NEW_TICKER' ELSE event_type END AS problem,
  CASE WHEN event_type <> 'signup' AND value > 10 THEN DATE '1995-01-01' + 24 * CAST(json_extract(props, '$.k') AS INTEGER) END AS trade_date,
  CASE WHEN value > 5 THEN CAST(floor(value) AS INTEGER) END AS batch,
  CASE WHEN value < 40 THEN NULL WHEN value < 60 THEN 'UNRESOLVED' WHEN value < 95 THEN 'OPEN' ELSE 'QUARANTINED_DATA_GAP' END AS status,
  'gap at ' || strftime(DATE '1995-01-01' + 24 * CAST(json_extract(props, '$.k') AS INTEGER), '%Y-%m-%d') || ' or 2001-13-45' AS reason FROM events""")


def items(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    on = F.date_add(F.lit(W.EPOCH), k * 24)
    kind, value = F.col("event_type"), F.col("value")
    return W.table(spark, d, "events").select(
        F.col("event_id").alias("item_id"), F.when(value > 80, "HK").otherwise("US").alias("market"),
        W.security_id(F.col("user_id")).alias("security_id"),
        F.when(kind == "click", "DATA_SUSPECT").when(kind == "error", "FETCH_FAILED").when(kind == "view", "IDENTITY_REVIEW")
        .when(kind == "purchase", "SUSPECT_DELISTED").otherwise("DATA_SUSPECT").alias("category"),
        F.when(value > 90, "OFFICIAL_ISIN_SAME_NEW_TICKER").otherwise(kind).alias("problem"),
        F.when((kind != "signup") & (value > 10), on).alias("trade_date"), F.when(value > 5, F.floor(value).cast("int")).alias("batch"),
        F.when(value < 40, None).when(value < 60, "UNRESOLVED").when(value < 95, "OPEN").otherwise("QUARANTINED_DATA_GAP").alias("status"),
        F.concat(F.lit("gap at "), on.cast("string"), F.lit(" or 2001-13-45")).alias("reason"))


# Fetch failures for the five-day rule: sessions without a bar, seen from the last sessions.
@query("five_day_failures", with_ctes("securities", "calendar", "daily_bars") + f"""
, l5 AS (SELECT date FROM (SELECT DISTINCT date FROM daily_bars) t WHERE date <= DATE '{AS_OF}' ORDER BY date DESC LIMIT 5)
SELECT security_id, 'SUSPECT_DELISTED' AS review_status FROM securities, l5
LEFT JOIN daily_bars b USING (security_id, date) WHERE b.open IS NULL GROUP BY 1 HAVING count(*) = 5""".replace(
    "securities, l5\nLEFT JOIN daily_bars b USING (security_id, date)", "(SELECT s.security_id, l5.date FROM securities s, l5) x\nLEFT JOIN daily_bars b USING (security_id, date)"))
def five_day_failures(spark, d):
    daily = W.daily_bars(spark, d)
    days = session_index(daily.filter(F.col("date") <= F.lit(AS_OF)))
    gaps = Q.missing_sessions(daily.filter(F.col("date") <= F.lit(AS_OF)), days, W.securities(spark, d), recent=5)
    queue = gaps.select("security_id", F.col("date").alias("trade_date"), F.lit("FETCH_FAILED").alias("category"), F.lit("OPEN").alias("status"))
    return Q.five_day_failures(queue, days, AS_OF)


@query("history_status", with_ctes("securities", "daily_bars") + """
SELECT s.security_id, count(b.date) AS bar_count, CASE WHEN count(b.date) < 501 THEN 'SHORT_HISTORY' ELSE 'FULL_HISTORY' END AS history_status
FROM securities s LEFT JOIN daily_bars b USING (security_id) WHERE security_id_origin = 'NEW_LISTING' GROUP BY 1""")
def history_status(spark, d):
    return Q.new_listing_history(W.securities(spark, d), W.daily_bars(spark, d))


cte("gaps", """SELECT x.security_id, s.date FROM (SELECT security_id, min(date) AS lo, max(date) AS hi FROM flawed GROUP BY 1) x, sessions s
WHERE s.date > lo AND s.date < hi AND NOT EXISTS (SELECT 1 FROM flawed b WHERE b.security_id = x.security_id AND b.date = s.date)""", "flawed", "sessions")


@query("suspect_days", with_ctes("gaps") + f"""
SELECT security_id, {day('date', 'date')}, 'BAD_BAR' AS kind FROM flawed WHERE NOT {_GOOD}
UNION ALL SELECT security_id, {day('date', 'date')}, 'GAP' FROM gaps""")
def suspect_days(spark, d):
    return Q.suspect_days(flawed(spark, d), sessions(spark, d))


cte("targets", """SELECT security_id, CASE WHEN s_nationkey < 8 THEN 'QUARANTINED_DATA_GAP' WHEN s_nationkey < 16 THEN 'QUARANTINED_IDENTITY'
  ELSE 'QUARANTINED_UNCONFIRMED_SOURCE' END AS original_status FROM securities""", "securities")


def targets(spark, d):
    n = F.col("s_nationkey")
    return W.securities(spark, d).select("security_id", F.when(n < 8, "QUARANTINED_DATA_GAP").when(n < 16, "QUARANTINED_IDENTITY")
                                         .otherwise("QUARANTINED_UNCONFIRMED_SOURCE").alias("original_status"))


def _needed(bars, ids):
    """SQL: dates needed by the rows of `ids` given the bars in `bars`."""
    return f"""SELECT t.security_id, s.date FROM {ids} t LEFT JOIN (SELECT security_id, min(date) AS lo FROM {bars} WHERE {_GOOD} GROUP BY 1) f USING (security_id), sessions s
  WHERE (CASE WHEN original_status = 'QUARANTINED_DATA_GAP' THEN lo IS NULL OR s.date >= lo ELSE s.idx > (SELECT max(idx) - 20 FROM sessions) END
      AND NOT EXISTS (SELECT 1 FROM {bars} b WHERE b.security_id = t.security_id AND b.date = s.date AND {_GOOD.replace('open', 'b.open').replace('high', 'b.high').replace('low', 'b.low').replace('close', 'b.close').replace('volume', 'b.volume')}))
    OR (original_status = 'QUARANTINED_DATA_GAP' AND EXISTS (SELECT 1 FROM items q WHERE q.security_id = t.security_id AND s.date >= DATE '2000-01-01'
      AND q.reason LIKE 'gap at ' || strftime(s.date, '%Y-%m-%d') || '%'))"""


cte("needed", _needed("flawed", "targets"), "flawed", "targets", "sessions", "items")


@query("missing_sessions", with_ctes("needed") + f"SELECT security_id, {day('date', 'date')} FROM needed")
def missing_sessions(spark, d):
    return Q.needed_dates(targets(spark, d), flawed(spark, d), sessions(spark, d), items(spark, d))


@query("quality_flags", with_ctes("flawed", "sessions", "gaps", "securities") + f"""
, seq AS (SELECT *, lag(close) OVER (PARTITION BY security_id ORDER BY date) AS prev FROM flawed),
f AS (SELECT security_id, count(*) AS n, bool_or(NOT {_GOOD}) AS bad, coalesce(bool_or(abs(close / nullif(prev, 0) - 1) > 0.5), false) AS jump FROM seq GROUP BY 1),
x AS (SELECT s.security_id, s.s_acctbal > 9500 AS rev, n, bad, jump, EXISTS (SELECT 1 FROM gaps g WHERE g.security_id = s.security_id) AS gap,
  coalesce(n = (SELECT count(*) FROM sessions), false) AS full_ FROM securities s LEFT JOIN f USING (security_id))
SELECT security_id, CASE WHEN n IS NULL THEN concat_ws('|', CASE WHEN rev THEN 'IDENTITY_REVIEW' END, 'FETCH_FAILED') ELSE
  concat_ws('|', CASE WHEN jump THEN 'LARGE_MOVE' END, CASE WHEN NOT full_ AND gap AND NOT bad THEN 'DATA_SUSPECT' END, CASE WHEN rev THEN 'IDENTITY_REVIEW' END,
    CASE WHEN bad THEN 'DATA_SUSPECT' END, CASE WHEN full_ THEN 'PASS_501' ELSE 'INSUFFICIENT_HISTORY_NEW_LISTING' END) END AS flags FROM x""")
def quality_flags(spark, d):
    own_rows = W.securities(spark, d).select("security_id", (F.col("s_acctbal") > 9500).alias("identity_review"))
    out = Q.quality_flags(flawed(spark, d), sessions(spark, d), own_rows)
    return out.select("security_id", F.concat_ws("|", "flags").alias("flags"))


@query("catchup_targets", with_ctes("securities", "appended_to_date", "sessions") + f"""
, l AS (SELECT s.security_id, s_acctbal, greatest(CASE WHEN security_id_origin IS DISTINCT FROM 'NEW_LISTING' THEN DATE '{BASE_AS_OF}' END, max(a.date)) AS last_date
  FROM securities s LEFT JOIN (SELECT * FROM appended_to_date WHERE volume > 45) a ON a.security_id = s.security_id WHERE coalesce(listing_status, 'ACTIVE') = 'ACTIVE' GROUP BY s.security_id, s_acctbal, security_id_origin)
SELECT security_id, {day('s.date', 'date')} FROM l, sessions s WHERE (last_date IS NULL OR last_date < DATE '{AS_OF}') AND s.date <= DATE '{AS_OF}'
  AND CASE WHEN last_date IS NOT NULL THEN s.date > last_date ELSE s.date >= CASE WHEN s_acctbal > 9500 THEN DATE '2000-01-01' ELSE DATE '1995-01-01' END END""")
def catchup_targets(spark, d):
    universe = W.securities(spark, d).withColumn("listing_date", F.lit(dt.date(2000, 1, 1))).withColumn(
        "listing_date_verified", F.col("s_acctbal") > 9500)
    last = Q.last_stored(W.securities(spark, d), W.appended_bars(spark, d, AS_OF).filter("volume > 45"), BASE_AS_OF)
    return Q.catchup_targets(universe, last, sessions(spark, d), AS_OF)


# --- queue -------------------------------------------------------------------------------
@query("queue_append", with_ctes("items") + f"""
, stored AS (SELECT DISTINCT market, security_id, category, trade_date FROM items WHERE status IS NOT NULL)
SELECT i.item_id, i.market, i.security_id, i.category, {day('i.trade_date', 'trade_date')} FROM (SELECT * FROM items WHERE status IS NULL) i
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.market = i.market AND s.security_id = i.security_id AND s.category = i.category AND s.trade_date IS NOT DISTINCT FROM i.trade_date)""")
def queue_append(spark, d):
    rows = items(spark, d)
    return Q.queue_append(rows.filter("status IS NOT NULL"), rows.filter("status IS NULL")).select(
        "item_id", "market", "security_id", "category", "trade_date")


@query("queue_append_batch", with_ctes("items") + """
, stored AS (SELECT DISTINCT market, security_id, batch, category FROM items WHERE status IS NOT NULL)
SELECT i.item_id FROM (SELECT * FROM items WHERE status IS NULL) i WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.market = i.market
  AND s.security_id = i.security_id AND s.category = i.category AND s.batch IS NOT DISTINCT FROM i.batch)""")
def queue_append_batch(spark, d):
    rows = items(spark, d)
    return Q.queue_append(rows.filter("status IS NOT NULL"), rows.filter("status IS NULL"), Q.BATCH_KEY).select("item_id")


@query("queue_reconcile", with_ctes("items", "securities") + """
, j AS (SELECT i.*, s.security_id IS NOT NULL AND coalesce(i.status LIKE 'QUARANTINED%', false) AS mv, CASE WHEN s.listing_status = 'ACTIVE' THEN 'RESOLVED' ELSE s.listing_status END AS st,
    'closed ' || s.name AS cr FROM items i LEFT JOIN (SELECT * FROM securities WHERE listing_status IS NOT NULL) s ON s.security_id = i.security_id)
SELECT item_id, security_id, CASE WHEN mv THEN st ELSE status END AS status, CASE WHEN mv THEN cr ELSE reason END AS reason,
  mv AND (status IS DISTINCT FROM st OR reason IS DISTINCT FROM cr) AS changed FROM j""")
def queue_reconcile(spark, d):
    terminals = W.securities(spark, d).filter("listing_status IS NOT NULL").select(
        "security_id", "listing_status", F.concat(F.lit("closed "), "name").alias("close_reason"))
    return Q.queue_reconcile(items(spark, d), terminals).select("item_id", "security_id", "status", "reason", "changed")


@query("source_diff", """
WITH saved AS (SELECT url AS path, min(md5(html)) AS md5, min(strlen(html)) AS size FROM pages GROUP BY 1),
live AS (SELECT url AS path, max(md5(html)) AS md5, max(strlen(html)) AS size FROM pages WHERE page_id > 20 GROUP BY 1)
SELECT path, CASE WHEN s.md5 IS NULL THEN 'NEW' WHEN l.md5 IS NULL THEN 'DELETED' WHEN s.md5 = l.md5 AND s.size = l.size THEN 'UNCHANGED' ELSE 'CHANGED' END AS state
FROM saved s FULL JOIN live l USING (path)""".replace("WHERE page_id > 20 ", "WHERE html LIKE '%<article>%' "))
def source_diff(spark, d):
    pages = W.table(spark, d, "pages").select(F.col("url").alias("path"), F.md5(F.col("html").cast("binary")).alias("md5"),
                                              F.octet_length("html").alias("size"), F.col("html").contains("<article>").alias("article"))
    saved = pages.groupBy("path").agg(F.min("md5").alias("md5"), F.min("size").alias("size"))
    live = pages.filter("article").groupBy("path").agg(F.max("md5").alias("md5"), F.max("size").alias("size"))
    return Q.source_diff(saved, live)


LINE = {"l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
        "l_discount": "double", "l_tax": "double", "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "time"}


# Batches of ten suppliers. Of seven batches one holds a changed value, one lacks rows, one repeats rows, one lacks its receipt.
@query("batch_receipt_check", f"""
WITH i AS (SELECT *, l_suppkey // 10 AS batch FROM lineitem), hit AS (SELECT *, l_orderkey % 97 = 0 AS hit, batch % 7 AS kind FROM i),
s AS (SELECT * REPLACE (CASE WHEN hit AND kind = 1 THEN l_tax + 0.01 ELSE l_tax END AS l_tax) FROM hit WHERE NOT (hit AND kind = 2) UNION ALL SELECT * FROM hit WHERE hit AND kind = 3),
a AS (SELECT batch, count(*) AS n, count(DISTINCT l_suppkey) AS c, {D.digest(D.row_text(LINE))} AS g FROM hit WHERE kind <> 4 GROUP BY 1),
b AS (SELECT batch, count(*) AS n, count(DISTINCT l_suppkey) AS c, {D.digest(D.row_text(LINE))} AS g FROM s GROUP BY 1)
SELECT batch, error IS NULL AS intact, error FROM (SELECT batch, CASE WHEN a.n IS NULL THEN 'RECEIPT_MISSING' WHEN b.n IS NULL THEN 'BATCH_MISSING' WHEN a.n <> b.n THEN 'ROW_COUNT' WHEN a.c <> b.c THEN 'SECURITY_COUNT'
  WHEN a.g <> b.g THEN 'DIGEST' END AS error FROM a FULL JOIN b USING (batch))""")
def batch_receipt_check(spark, d):
    """Receipts are made from the rows as issued, batches are what a damaged store holds."""
    issued = W.table(spark, d, "lineitem").withColumn("batch", F.floor(F.col("l_suppkey") / 10).cast("bigint"))
    hit, kind = F.col("l_orderkey") % 97 == 0, F.col("batch") % 7
    stored = issued.filter(~(hit & (kind == 2))).withColumn("l_tax", F.when(hit & (kind == 1), F.col("l_tax") + 0.01).otherwise(F.col("l_tax")))
    stored = stored.unionByName(issued.filter(hit & (kind == 3)))
    receipts = Q.batch_contents(issued.filter(kind != 4), "l_suppkey", list(LINE), digits=6)
    return Q.batch_receipts(receipts, Q.batch_contents(stored, "l_suppkey", list(LINE), digits=6))


# --- options: an order is a contract, its customer the security ------------------------------
_CHAIN_SQL = """
WITH c AS (SELECT printf('US-%06d', o_custkey + 1) AS security_id, epoch(date_trunc('month', o_orderdate))::BIGINT AS expiry, CASE WHEN o_orderstatus = 'F' THEN 'calls' ELSE 'puts' END AS side,
  floor(o_totalprice / 50000) AS strike, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS bid, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice + CASE WHEN o_orderpriority = '3-MEDIUM' THEN -1 ELSE 1 END END AS ask FROM orders),
q AS (SELECT *, coalesce(ask >= bid AND bid >= 0, false) AS quoted FROM c),
v AS (SELECT security_id, count(DISTINCT strike) FILTER (quoted) >= 2 AND expiry >= 820454400 AS vert FROM q GROUP BY security_id, expiry, side),
s AS (SELECT security_id, count(DISTINCT expiry) FILTER (expiry >= 820454400) AS expiries, min(expiry) FILTER (expiry >= 820454400) AS nearest, count(DISTINCT strike) >= 2 AS two, bool_or(quoted) AS anyq FROM q GROUP BY 1)
SELECT security_id, CASE WHEN expiries > 0 THEN 'TRUE' ELSE 'FALSE' END AS has_options, strftime(to_timestamp(nearest), '%Y-%m-%d') AS nearest_expiry, expiries AS expiry_count,
  CASE WHEN expiries > 0 AND two THEN 'TRUE' ELSE 'UNKNOWN' END AS strike_data_available, CASE WHEN expiries > 0 AND anyq THEN 'TRUE' ELSE 'UNKNOWN' END AS bid_ask_available,
  CASE WHEN expiries > 0 AND bool_or(vert) THEN 'TRUE' ELSE 'UNKNOWN' END AS vertical_usable, CASE WHEN expiries > 0 THEN 'CHECKED' ELSE 'NO_EXPIRIES' END AS status
FROM s JOIN v USING (security_id) GROUP BY security_id, expiries, nearest, two, anyq"""


@query("option_chain_label", _CHAIN_SQL)
def option_chain_label(spark, d):
    o = W.table(spark, d, "orders")
    p, total = F.col("o_orderpriority"), F.col("o_totalprice")
    contracts = o.select(
        W.security_id(F.col("o_custkey")).alias("security_id"), (F.unix_date(F.trunc("o_orderdate", "month")).cast("bigint") * 86400).alias("expiry"),
        F.when(F.col("o_orderstatus") == "F", "calls").otherwise("puts").alias("side"), F.floor(total / 50000).cast("double").alias("strike"),
        F.when(p != "5-LOW", total).alias("bid"), F.when(p != "4-NOT SPECIFIED", total + F.when(p == "3-MEDIUM", -1).otherwise(1)).alias("ask"))
    asked = contracts.select("security_id", F.lit(True).alias("answered")).distinct()
    # Expiries before 1996 are not listed any more.
    return Q.option_labels(asked, contracts, contracts.filter("expiry >= 820454400"))


@query("option_status_stale", """SELECT o_orderkey, CASE WHEN (1998 - year(o_orderdate)) * 12 + 8 - month(o_orderdate) >= 1 THEN 'STALE' ELSE o_orderstatus END AS status FROM orders""")
def option_status_stale(spark, d):
    return W.table(spark, d, "orders").select(
        "o_orderkey", Q.stale_option_status(F.col("o_orderstatus"), F.col("o_orderdate"), F.lit(dt.date(1998, 8, 1))).alias("status"))


# --- calendars -----------------------------------------------------------------------------
@query("session_closed", """
SELECT event_id, market, strftime(local_ts, '%Y-%m-%d') AS local_date, CAST(ts AS DATE) < CAST(local_ts AS DATE)
  OR (CAST(ts AS DATE) = CAST(local_ts AS DATE) AND hour(local_ts) * 60 + minute(local_ts) >= 1050) AS closed
FROM (SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE CASE WHEN market = 'US' THEN 'America/New_York' ELSE 'Asia/Hong_Kong' END AS local_ts
  FROM (SELECT event_id, ts, CASE WHEN value > 50 THEN 'HK' ELSE 'US' END AS market FROM events) e) t""")
def session_closed(spark, d):
    rows = W.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                                              F.when(F.col("value") > 50, "HK").otherwise("US").alias("market"))
    rows = rows.withColumn("local", DT.local_time(F.col("ts"), F.col("market")))
    return rows.select("event_id", "market", F.col("local").cast("date").alias("local_date"),
                       DT.session_closed(F.col("ts").cast("date"), F.col("local")).alias("closed"))


@query("us_open_days", """
WITH starts AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS start FROM orders),
years AS (SELECT DISTINCT y + k AS y FROM (SELECT DISTINCT CAST(year(start) AS INTEGER) AS y FROM starts) a, (VALUES (0), (1)) b(k)),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS t FROM e3),
easter AS (SELECT y, make_date(y, CAST(t // 31 AS INTEGER), CAST(t % 31 + 1 AS INTEGER)) AS d FROM e4),
fixed AS (SELECT y, make_date(y, m, d) AS x FROM years, (VALUES (1, 1), (6, 19), (7, 4), (12, 25)) f(m, d)),
days AS (SELECT CAST(d AS DATE) AS d, year(d) AS y, month(d) AS m, day(d) AS dd, isodow(d) AS w FROM generate_series(DATE '1994-01-01', DATE '2006-12-31', INTERVAL 1 DAY) g(d)),
banned AS (SELECT CASE isodow(x) WHEN 6 THEN x - 1 WHEN 7 THEN x + 1 ELSE x END AS d FROM fixed
  UNION SELECT d FROM days WHERE w = 1 AND ((m = 1 AND dd BETWEEN 15 AND 21) OR (m = 2 AND dd BETWEEN 15 AND 21) OR (m = 9 AND dd <= 7) OR (m = 5 AND dd >= 25))
  UNION SELECT d FROM days WHERE w = 4 AND m = 11 AND dd BETWEEN 22 AND 28
  UNION SELECT d - 2 FROM easter)
SELECT strftime(start, '%Y-%m-%d') AS start, strftime(CAST(d.d AS DATE), '%Y-%m-%d') AS date FROM starts, days d
WHERE d.d >= start AND d.d < start + 96 AND w < 6 AND NOT EXISTS (SELECT 1 FROM banned b WHERE b.d = d.d)""")
def us_open_days(spark, d):
    return DT.us_open_days(W.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("start")).distinct())


# Observed sessions are trading days with a big order; overrides and outages come from orders too.
cte("order_days", """SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS top, count(*) AS c, min(o_orderpriority) AS pri, bool_or(o_orderstatus = 'P') AS p FROM orders GROUP BY 1""")


@query("market_calendar", with_ctes("order_days") + f"""
, days AS (SELECT CAST(d AS DATE) AS date FROM generate_series((SELECT min(date) FROM order_days WHERE top > 300000), DATE '{AS_OF}', INTERVAL 1 DAY) g(d)),
x AS (SELECT days.date, coalesce(top > 300000, false) AS seen, coalesce(top > 480000, false) AS outage,
    CASE WHEN c = 2 THEN 'CLOSED' WHEN c = 3 THEN 'HALF_DAY' WHEN c = 4 THEN 'MARKET_HALTED' END AS off FROM days LEFT JOIN order_days USING (date)),
y AS (SELECT *, CASE WHEN outage THEN 'MARKET_WIDE_DATA_UNAVAILABLE' WHEN off IS NOT NULL THEN off WHEN seen THEN 'OPEN' WHEN isodow(date) >= 6 THEN 'CLOSED' ELSE 'UNVERIFIED' END AS st FROM x)
SELECT {day('date', 'trade_date')}, st AS session_status, CASE WHEN st IN ('OPEN', 'HALF_DAY') THEN '09:30' END AS open_time,
  CASE WHEN off = 'HALF_DAY' THEN '12:00' WHEN st = 'OPEN' THEN '16:00' END AS close_time, 'America/New_York' AS time_zone, st = 'HALF_DAY' AS half_day,
  CASE WHEN off IS NOT NULL THEN 'bulletin' WHEN seen THEN 'BASE_CALENDAR/^GSPC' WHEN isodow(date) >= 6 THEN 'WEEKEND' ELSE 'PENDING_OFFICIAL_EVIDENCE' END AS source,
  CASE WHEN off IS NOT NULL THEN 'ref ' || off END AS evidence_ref FROM y""")
def market_calendar(spark, d):
    per_day = W.table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("c"))
    status = F.when(F.col("c") == 2, "CLOSED").when(F.col("c") == 3, "HALF_DAY").when(F.col("c") == 4, "MARKET_HALTED")
    overrides = per_day.select("date", status.alias("session_status")).filter("session_status IS NOT NULL").select(
        "date", "session_status", F.lit("bulletin").alias("official_source"), F.concat(F.lit("ref "), "session_status").alias("evidence_ref"),
        F.lit(None).cast("string").alias("open_time"), F.when(F.col("session_status") == "HALF_DAY", "12:00").alias("close_time"))
    return M.market_calendar(per_day.filter("top > 300000"), overrides, per_day.filter("top > 480000"), AS_OF)


# --- repair decisions ------------------------------------------------------------------------
cte("evidence", """SELECT security_id, ticker, exchange, isin, CASE WHEN s_acctbal > 9000 THEN NULL ELSE s_acctbal BETWEEN 3000 AND 4000 END AS identity_review,
  DATE '1997-01-01' AS listing_date, s_acctbal > 6000 AS listing_date_verified, s_acctbal < -500 AS delisting_proven,
  CASE WHEN s_acctbal > 7000 THEN 'X' ELSE ticker END AS o_ticker, exchange AS o_exchange, isin AS o_isin, CASE WHEN s_acctbal > 1000 THEN 'h' ELSE '' END AS o_hash,
  'HK_ISIN_MATCH' AS p_kind, CASE WHEN s_nationkey > 12 THEN isin ELSE 'other' END AS p_isin, ticker AS p_ticker, 'h' AS p_hash FROM securities""", "securities")


def evidence(spark, d):
    b = F.col("s_acctbal")
    return W.securities(spark, d).select(
        "security_id", "market", "ticker", "exchange", "isin", F.when(b <= 9000, b.between(3000, 4000)).alias("identity_review"),
        F.lit(dt.date(1997, 1, 1)).alias("listing_date"), (b > 6000).alias("listing_date_verified"), (b < -500).alias("delisting_proven"),
        F.struct(F.when(b > 7000, "X").otherwise(F.col("ticker")).alias("ticker"), "exchange", "isin",
                 F.when(b > 1000, "h").otherwise("").alias("source_hash")).alias("official"),
        F.struct(F.lit("HK_ISIN_MATCH").alias("kind"), F.when(F.col("s_nationkey") > 12, F.col("isin")).otherwise("other").alias("isin"),
                 F.col("ticker").alias("new_ticker"), F.lit("h").alias("source_hash")).alias("proof"))


def _outages(spark, d):
    return W.table(spark, d, "events").select(
        F.lit("US").alias("market"), F.date_add(F.lit(W.EPOCH), F.get_json_object("props", "$.k").cast("int") * 24).alias("trade_date"),
        F.col("value")).filter("value > 99.5").select("market", "trade_date").distinct()


cte("outages", "SELECT DISTINCT 'US' AS market, DATE '1995-01-01' + 24 * CAST(json_extract(props, '$.k') AS INTEGER) AS trade_date FROM events WHERE value > 99.5")
cte("suspects", f"SELECT security_id, date FROM flawed WHERE NOT {_GOOD} UNION SELECT security_id, date FROM gaps", "flawed", "gaps")
cte("offers", f"""SELECT r.security_id, count(*) AS all_bars, count(s.date) AS sb, count(s.date) FILTER (NOT r.ok) AS sbad,
  count(*) FILTER (f.date IS NULL) AS nb, count(*) FILTER (f.date IS NULL AND NOT r.ok) AS nbad
FROM (SELECT *, {_GOOD} AS ok FROM refreshed) r LEFT JOIN suspects s ON s.security_id = r.security_id AND s.date = r.date
LEFT JOIN flawed f ON f.security_id = r.security_id AND f.date = r.date GROUP BY 1""", "refreshed", "suspects")
cte("decisions", f"""
SELECT *, CASE
  WHEN NOT kn THEN 'UNRESOLVED|SECURITY_ID_MISSING_OR_EXECUTION_EVENT'
  WHEN delisting_proven THEN 'DELISTED|OFFICIAL_DELISTING_CONFIRMED'
  WHEN category = 'IDENTITY_REVIEW' AND ((problem = 'OFFICIAL_ISIN_SAME_NEW_TICKER' AND market = 'HK' AND p_isin = isin)
    OR (o_hash <> '' AND identity_review = false AND o_ticker = ticker)) THEN 'IDENTITY_FIXED|'
  WHEN halted THEN 'UNRESOLVED|MARKET_WIDE_OUTAGE'
  WHEN category = 'SUSPECT_DELISTED' THEN 'UNRESOLVED|OFFICIAL_DELISTING_PROOF_REQUIRED'
  WHEN category = 'IDENTITY_REVIEW' THEN 'UNRESOLVED|OFFICIAL_IDENTITY_PROOF_REQUIRED'
  WHEN o_hash = '' OR o_ticker <> ticker THEN 'UNRESOLVED|OFFICIAL_LISTING_PROOF_REQUIRED'
  WHEN identity_review THEN 'UNRESOLVED|IDENTITY_REVIEW_OPEN'
  WHEN undated AND (batch IS NULL OR sdays = 0) THEN 'VALIDATED_NO_DATA_DEFECT|NO_TRADE_BAR_VALID_OR_NOT_REPRODUCED'
  WHEN trade_date IS NOT NULL AND NOT is_session THEN 'UNRESOLVED|SESSION_NOT_CONFIRMED'
  WHEN got = 0 AND trade_date < listing_date AND listing_date_verified THEN 'SHORT_HISTORY|PRE_LISTING_DATE'
  WHEN got = 0 THEN 'NO_DATA|NO_PRIMARY_BAR_ACTIVE_LISTING'
  WHEN trade_date IS NULL AND category NOT IN ('DATA_SUSPECT', 'FETCH_FAILED') THEN 'UNRESOLVED|EXACT_DATE_REQUIRED'
  WHEN trade_date IS NULL AND category = 'FETCH_FAILED' AND batch IS NULL THEN 'UNRESOLVED|BASE_BATCH_UNKNOWN'
  WHEN left_ = 0 THEN 'UNRESOLVED|NO_BAR_AT_REQUESTED_DATE' WHEN bad > 0 THEN 'UNRESOLVED|BAR_STILL_SUSPECT' ELSE 'RESOLVED|' END AS verdict
FROM (SELECT *, CASE WHEN trade_date IS NOT NULL THEN db WHEN undated THEN sb ELSE all_bars END AS got,
    CASE WHEN trade_date IS NOT NULL THEN db WHEN undated THEN sb ELSE nb END AS left_, CASE WHEN trade_date IS NOT NULL THEN dbad WHEN undated THEN sbad ELSE nbad END AS bad FROM (
  SELECT i.item_id, i.market, i.security_id, i.category, i.problem, i.trade_date, i.batch, i.status, i.reason, e.* EXCLUDE (security_id), e.security_id IS NOT NULL AS kn,
    EXISTS (SELECT 1 FROM outages o WHERE o.market = i.market AND o.trade_date = i.trade_date) AS halted,
    i.trade_date IN (SELECT date FROM sessions) AS is_session, i.category = 'DATA_SUSPECT' AND i.trade_date IS NULL AS undated,
    coalesce(db, 0) AS db, coalesce(dbad, 0) AS dbad, coalesce(sdays, 0) AS sdays, coalesce(all_bars, 0) AS all_bars, coalesce(sb, 0) AS sb, coalesce(sbad, 0) AS sbad, coalesce(nb, 0) AS nb, coalesce(nbad, 0) AS nbad
  FROM items i LEFT JOIN evidence e ON e.security_id = i.security_id
  LEFT JOIN (SELECT security_id, date, count(*) AS db, count(*) FILTER (NOT {_GOOD}) AS dbad FROM refreshed GROUP BY 1, 2) r ON r.security_id = i.security_id AND r.date = i.trade_date
  LEFT JOIN (SELECT security_id, count(*) AS sdays FROM suspects GROUP BY 1) s ON s.security_id = i.security_id
  LEFT JOIN offers f ON f.security_id = i.security_id) a) b""", "items", "evidence", "outages", "sessions", "offers")


def decided(spark, d):
    return P.repair_decisions(items(spark, d).drop("status", "reason"), evidence(spark, d), sessions(spark, d), _outages(spark, d),
                              flawed(spark, d), refreshed(spark, d))


@query("repair_decisions", with_ctes("decisions") + """
SELECT item_id, security_id, category, split_part(verdict, '|', 1) AS result, nullif(split_part(verdict, '|', 2), '') AS reason,
  split_part(verdict, '|', 1) IN ('RESOLVED', 'IDENTITY_FIXED') AS accepted FROM decisions""")
def repair_decisions(spark, d):
    return decided(spark, d).select("item_id", "security_id", "category", "result", "reason", "accepted")


@query("repair_queue_update", with_ctes("decisions") + """
, u AS (SELECT market, coalesce(status, 'OPEN') IN ('OPEN', 'UNRESOLVED') AS mv, CASE WHEN coalesce(status, 'OPEN') IN ('OPEN', 'UNRESOLVED') THEN split_part(verdict, '|', 1) ELSE status END AS st FROM decisions)
SELECT market, count(*) FILTER (mv) AS processed, count(*) FILTER (mv AND st IN ('RESOLVED', 'IDENTITY_FIXED')) AS accepted,
  count(*) FILTER (st IN ('OPEN', 'UNRESOLVED')) AS open FROM u GROUP BY 1""")
def repair_queue_update(spark, d):
    return P.queue_summary(P.apply_decisions(items(spark, d), decided(spark, d)))


cte("own2", f"""SELECT security_id, name, s_acctbal > 500 AS official_ok FROM securities WHERE s_acctbal > -800""", "securities")
cte("live", f"""SELECT t.security_id, t.original_status FROM targets t JOIN own2 USING (security_id) WHERE official_ok AND NOT ({_noncommon('name')} OR {_spac('name')})""", "targets", "own2")
cte("live_bars", "SELECT * FROM flawed SEMI JOIN live USING (security_id)", "flawed", "live")
cte("need1", _needed("live_bars", "live"), "live_bars", "live", "sessions", "items")
cte("state1", f"""SELECT l.*, coalesce(n, 0) AS needed, coalesce(c > 0 AND good, false) AND coalesce(n, 0) = 0 AS complete FROM live l
LEFT JOIN (SELECT security_id, count(*) AS n FROM need1 GROUP BY 1) a USING (security_id)
LEFT JOIN (SELECT security_id, count(*) AS c, bool_and({_GOOD}) AS good FROM live_bars GROUP BY 1) b USING (security_id)""", "need1")
cte("added", f"""SELECT * FROM refreshed r WHERE {_GOOD} AND security_id IN (SELECT security_id FROM state1 WHERE NOT complete)
  AND (EXISTS (SELECT 1 FROM need1 n WHERE n.security_id = r.security_id AND n.date = r.date)
    OR (security_id IN (SELECT security_id FROM state1 WHERE needed = 0) AND date IN (SELECT date FROM sessions WHERE idx > (SELECT max(idx) - 20 FROM sessions))))
  AND NOT EXISTS (SELECT 1 FROM live_bars b WHERE b.security_id = r.security_id AND b.date = r.date AND {_GOOD.replace('open', 'b.open').replace('high', 'b.high').replace('low', 'b.low').replace('close', 'b.close').replace('volume', 'b.volume')})""", "refreshed", "state1")
cte("combined", f"SELECT security_id, date, open, high, low, close, volume FROM live_bars WHERE {_GOOD} UNION ALL SELECT security_id, date, open, high, low, close, volume FROM added", "added")
cte("pending1", "SELECT security_id, original_status FROM state1 WHERE NOT complete", "state1")
cte("need2", _needed("combined", "pending1"), "combined", "pending1", "sessions", "items")


@query("quarantine_closeout", with_ctes("need2") + f"""
, m AS (SELECT security_id, array_to_string(list_slice(list(strftime(date, '%Y-%m-%d') ORDER BY date), 1, 12), ',') AS missing, count(*) AS missing_count, string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) AS missing_dates FROM need2 GROUP BY 1),
x AS (SELECT t.*, o.name, o.security_id IS NOT NULL AS kn, coalesce(official_ok, false) AS ok, CASE WHEN official_ok THEN CASE WHEN {_spac('name')} THEN 'EXCLUDED_SPAC' WHEN {_noncommon('name')} THEN 'EXCLUDED_NON_COMMON' END END AS ex,
    coalesce(complete, false) AS complete, missing, coalesce(missing_count, 0) AS missing_count, coalesce(missing_dates, '') AS missing_dates, EXISTS (SELECT 1 FROM combined c WHERE c.security_id = t.security_id) AS hasbars
  FROM targets t LEFT JOIN own2 o USING (security_id) LEFT JOIN state1 s USING (security_id) LEFT JOIN m USING (security_id)),
y AS (SELECT *, CASE WHEN NOT kn OR NOT ok THEN 'QUARANTINED_IDENTITY' WHEN ex IS NOT NULL THEN ex WHEN complete OR (hasbars AND missing IS NULL) THEN 'ACTIVE'
    WHEN original_status = 'QUARANTINED_DATA_GAP' THEN original_status ELSE 'QUARANTINED_UNCONFIRMED_SOURCE' END AS terminal_status,
  CASE WHEN NOT kn THEN 'SECURITY_ID_MISSING_FROM_CURRENT_UNIVERSE' WHEN NOT ok THEN 'OFFICIAL_LISTING_NOT_CONFIRMED' WHEN ex IS NOT NULL THEN 'OFFICIAL_LISTING_SECURITY_TYPE_EXCLUDED'
    WHEN complete THEN 'OFFICIAL_LISTING_AND_COMPOSED_HISTORY_CONFIRMED' WHEN hasbars AND missing IS NULL THEN 'OFFICIAL_LISTING_AND_PRIMARY_HISTORY_REFRESH_CONFIRMED'
    ELSE 'PRIMARY_REFRESH_INCOMPLETE:MISSING_SESSIONS:' || coalesce(missing, '') END AS reason FROM x)
SELECT security_id, original_status, terminal_status, reason, CASE WHEN terminal_status = 'ACTIVE' THEN 'RESOLVED' WHEN terminal_status LIKE 'EXCLUDED%' THEN 'IDENTITY_FIXED' ELSE terminal_status END AS result,
  terminal_status = 'ACTIVE' OR terminal_status LIKE 'EXCLUDED%' AS accepted, missing_count, missing_dates FROM y""")
def quarantine_closeout(spark, d):
    own_rows = W.securities(spark, d).filter("s_acctbal > -800").select(
        "security_id", "name", (F.col("s_acctbal") > 500).alias("official_ok"))
    closed, _ = P.quarantine_closeout(targets(spark, d), own_rows, flawed(spark, d), sessions(spark, d), items(spark, d), refreshed(spark, d))
    return closed.withColumn("missing_dates", F.concat_ws(",", "missing_dates"))


# --- monitoring: a customer stands for a market, its orders for runs ---------------------------
cte("runs", """SELECT 'M' || o_custkey AS market, CAST(o_orderdate AS DATE) AS trade_date, CASE WHEN max(o_orderpriority) = '5-LOW' THEN 'FAILED' ELSE 'COMPLETE' END AS status,
  count(*) + 1 AS active, count(*) AS available FROM orders GROUP BY 1, 2""")


def runs(spark, d):
    return W.table(spark, d, "orders").groupBy(F.concat(F.lit("M"), "o_custkey").alias("market"), F.col("o_orderdate").cast("date").alias("trade_date")).agg(
        F.when(F.max("o_orderpriority") == "5-LOW", "FAILED").otherwise("COMPLETE").alias("status"),
        (F.count(F.lit(1)) + 1).alias("active"), F.count(F.lit(1)).alias("available"))


@query("daily_health", with_ctes("runs") + f"""
, cp AS (SELECT market, max(trade_date) AS last FROM runs WHERE status = 'COMPLETE' OR active > 2 GROUP BY 1 HAVING count(*) > 3),
ses AS (SELECT market, max(trade_date) AS expected FROM runs WHERE status = 'COMPLETE' GROUP BY 1),
base AS (SELECT 'M' || c_custkey AS market, CASE WHEN c_acctbal > 8000 THEN DATE '2001-06-01' ELSE DATE '1999-01-01' END AS b FROM customer)
SELECT market, {day('last', 'last_completed_date')}, CASE WHEN last IS NULL THEN 'DAILY_CHECKPOINT_MISSING' WHEN expected > last THEN 'DAILY_STALE' WHEN last < b THEN 'DAILY_CHECKPOINT_BEFORE_BASE'
  WHEN last > b AND r.status IS NULL THEN 'DAILY_RUN_RECEIPT_MISSING' WHEN last > b AND r.status <> 'COMPLETE' THEN 'DAILY_RUN_NOT_COMPLETE'
  WHEN coalesce(r.available, 0) < 1 OR r.status <> 'COMPLETE' THEN 'DERIVED_RANK_MISSING' ELSE 'HEALTHY' END AS status
FROM base LEFT JOIN cp USING (market) LEFT JOIN ses USING (market) LEFT JOIN runs r ON r.market = base.market AND r.trade_date = last""".replace("SELECT market, {day", "SELECT base.market, {day").replace("SELECT market, strftime", "SELECT base.market AS market, strftime"))
def daily_health(spark, d):
    r_ = runs(spark, d)
    checkpoints = r_.filter("status = 'COMPLETE' OR active > 2").groupBy("market").agg(
        F.max("trade_date").alias("last_completed_date"), F.count(F.lit(1)).alias("c")).filter("c > 3").drop("c")
    done = r_.filter("status = 'COMPLETE'")
    base = W.table(spark, d, "customer").select(F.concat(F.lit("M"), "c_custkey").alias("market"), F.when(
        F.col("c_acctbal") > 8000, F.lit(dt.date(2001, 6, 1))).otherwise(F.lit(dt.date(1999, 1, 1))).alias("base_as_of"))
    return M.daily_health(checkpoints, done.select("market", F.col("trade_date").alias("date")), base, r_,
                          done.select("market", F.col("trade_date").alias("as_of")))


@query("contiguous_closeout", with_ctes("runs") + f"""
, cp AS (SELECT market, min(trade_date) AS last FROM runs GROUP BY 1),
p AS (SELECT r.market, r.trade_date, status = 'COMPLETE' AS ok FROM runs r JOIN cp USING (market) WHERE trade_date > last),
w AS (SELECT *, bool_and(ok) OVER (PARTITION BY market ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS all_ok FROM p)
SELECT market, {day('trade_date', 'date')} FROM w WHERE all_ok""")
def contiguous_closeout(spark, d):
    r_ = runs(spark, d)
    return M.contiguous_closeout(r_.select("market", F.col("trade_date").alias("date")),
                                 r_.groupBy("market").agg(F.min("trade_date").alias("last_completed_date")), r_)


@query("rank_validate", f"""
WITH rk AS (SELECT 'M' || c_nationkey AS market, c_custkey // 2 AS id FROM customer),
n AS (SELECT market, count(*) AS c, count(DISTINCT id) AS ids FROM rk GROUP BY 1),
rc AS (SELECT 'M' || n_nationkey AS market, 62 AS active, 55 AS available, CASE WHEN n_regionkey = 1 THEN 2 ELSE 1 END AS parts FROM nation),
x AS (SELECT rc.*, coalesce(c, 0) AS c, coalesce(ids, 0) AS ids, CASE WHEN active IS NULL THEN 0 ELSE 1 END AS present FROM rc LEFT JOIN n USING (market))
SELECT market, '{AS_OF}' AS as_of, unnest([e FOR e IN [CASE WHEN c = 0 THEN 'RANK_EMPTY' END, CASE WHEN parts <> ceil(c / 250.0) THEN 'RANK_PARTS' END, CASE WHEN ids <> c THEN 'RANK_DUPLICATE_ID' END,
  CASE WHEN c < available OR c > active THEN 'RANK_COVERAGE' END, CASE WHEN present < ceil(c / 250.0) THEN 'RANK_DETAIL_MISSING' END] IF e IS NOT NULL]) AS error FROM x""")
def rank_validate(spark, d):
    as_of = F.lit(AS_OF).alias("as_of")
    ranked = W.table(spark, d, "customer").select(F.concat(F.lit("M"), "c_nationkey").alias("market"), as_of, F.floor(F.col("c_custkey") / 2).alias("security_id"))
    nation = W.table(spark, d, "nation").select(F.concat(F.lit("M"), "n_nationkey").alias("market"), as_of, F.lit(62).alias("active"), F.lit(55).alias("available"),
                                                F.when(F.col("n_regionkey") == 1, 2).otherwise(1).alias("stated_parts"))
    return M.rank_violations(ranked, nation, nation.select("market", "as_of", F.lit(1).alias("part")))


@query("indicator_shard_check", with_ctes("bars") + f"""
, s AS (SELECT security_id, max(date) AS trade_date, CASE WHEN max(volume) > 130 THEN 1 END AS rank_score FROM bars GROUP BY 1 UNION ALL SELECT 'X' || l_linenumber, DATE '2000-01-01', NULL FROM lineitem GROUP BY l_linenumber),
c AS (SELECT count(*) AS n, count(DISTINCT security_id) AS ids, count(*) FILTER (NOT regexp_matches(security_id, '^US-\\d{{6,}}$')) AS bad, count(*) FILTER (trade_date > DATE '{AS_OF}') AS future, count(rank_score) AS ranked FROM s),
a AS (SELECT count(*) AS active FROM supplier)
SELECT unnest(['COVERAGE', 'DUPLICATE_ID', 'MALFORMED_ID', 'FUTURE_DATE', 'RANK_FIELDS_SET', 'DIGEST']) AS "check",
  unnest([CASE WHEN n BETWEEN 1 AND active THEN 0 ELSE 1 END, n - ids, bad, future, ranked, CASE WHEN n = (SELECT count(DISTINCT security_id) FROM bars) THEN 0 ELSE 1 END]) AS violations FROM c, a""")
def indicator_shard_check(spark, d):
    rows = W.supplier_bars(spark, d).groupBy("security_id").agg(F.max("date").alias("trade_date"), F.max("volume").alias("v")).select(
        "security_id", "trade_date", F.when(F.col("v") > 130, 1.0).alias("rank_score"))
    odd = W.table(spark, d, "lineitem").select(F.concat(F.lit("X"), "l_linenumber").alias("security_id")).distinct().select(
        "security_id", F.lit(dt.date(2000, 1, 1)).alias("trade_date"), F.lit(None).cast("double").alias("rank_score"))
    everything = rows.unionByName(odd).withColumn("relative_strength_20d", F.lit(None).cast("double"))
    sent = M.shard_digest(rows.withColumn("relative_strength_20d", F.lit(None).cast("double")))
    receipt = W.table(spark, d, "supplier").agg(F.count(F.lit(1)).alias("active")).withColumn("available", F.lit(1)).join(sent)
    return M.shard_violations(everything, receipt, "US", AS_OF)


@query("daily_payload_check", with_ctes("trades") + f"""
, p AS (SELECT security_id, date AS folder, day FROM trades)
SELECT DISTINCT security_id, {day('folder', 'folder_date')}, 'DAILY_ROW_IDENTITY_INVALID' AS error FROM p WHERE day <> folder
UNION ALL SELECT security_id, {day('folder', 'folder_date')}, 'DAILY_DUPLICATE_KEY' FROM p GROUP BY security_id, folder HAVING count(*) > 1""")
def daily_payload_check(spark, d):
    rows = W.trades(spark, d).select("security_id", F.col("date").alias("folder_date"), F.col("day").alias("date"), F.col("day").alias("trade_date"))
    return M.payload_violations(rows, "US")


@query("regression_contract", with_ctes("bars") + """
, o AS (SELECT security_id AS name, unnest(['high', 'low']) AS field, unnest([max(high), min(low)]) AS v FROM bars GROUP BY 1),
e AS (SELECT security_id AS name, unnest(['high', 'low']) AS field, unnest([max(greatest(high, open)), CASE WHEN max(volume) > 120 THEN NULL ELSE min(close) END]) AS v FROM bars GROUP BY 1)
SELECT name, bool_and(CASE WHEN e.v IS NULL OR o.v IS NULL THEN e.v IS NULL AND o.v IS NULL ELSE abs(e.v - o.v) <= 1e-12 END) AS pass, count(*) AS fields FROM e LEFT JOIN o USING (name, field) GROUP BY 1""")
def regression_contract(spark, d):
    bars = W.supplier_bars(spark, d)

    def fields(high, low):
        return F.inline(F.array(F.struct(F.lit("high").alias("field"), high.alias("value")), F.struct(F.lit("low").alias("field"), low.alias("value"))))
    seen = bars.groupBy(F.col("security_id").alias("name")).agg(F.max("high").alias("h"), F.min("low").alias("l"), F.min("close").alias("c"), F.max("volume").alias("v"))
    return M.regression_contract(seen.select("name", fields(F.col("h"), F.col("l"))),
                                 seen.select("name", fields(F.col("h"), F.when(F.col("v") <= 120, F.col("c")))))


@query("month_pointer_diff", """
WITH prior AS (SELECT 'M' || c_custkey AS market, c_nationkey AS version, c_mktsegment AS month, c_mktsegment AS a, CASE WHEN c_acctbal > 5000 THEN 'x' END AS b FROM customer WHERE c_acctbal > 0),
new AS (SELECT 'M' || o_custkey AS market, CASE WHEN max(o_orderpriority) = '5-LOW' THEN 'BUILDING' ELSE 'MACHINERY' END AS month, 'BUILDING' AS a, CASE WHEN min(o_totalprice) > 20000 THEN 'x' END AS b FROM orders GROUP BY 1)
SELECT market, coalesce(n.month = p.month, false) AS same_month, CASE WHEN n.month = p.month THEN version ELSE coalesce(version, 0) + 1 END AS version,
  CASE WHEN n.month = p.month THEN concat_ws(',', CASE WHEN n.a IS DISTINCT FROM p.a THEN 'a' END, CASE WHEN n.b IS DISTINCT FROM p.b THEN 'b' END) ELSE '' END AS conflicts
FROM new n LEFT JOIN prior p USING (market)""")
def month_pointer_diff(spark, d):
    prior = W.table(spark, d, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("M"), "c_custkey").alias("market"), F.col("c_nationkey").alias("version"), F.col("c_mktsegment").alias("month"),
        F.col("c_mktsegment").alias("a"), F.when(F.col("c_acctbal") > 5000, "x").alias("b"))
    new = W.table(spark, d, "orders").groupBy(F.concat(F.lit("M"), "o_custkey").alias("market")).agg(
        F.when(F.max("o_orderpriority") == "5-LOW", "BUILDING").otherwise("MACHINERY").alias("month"), F.lit("BUILDING").alias("a"),
        F.when(F.min("o_totalprice") > 20000, "x").alias("b"))
    return M.pointer_diff(prior, new, ["a", "b"], ["month"])
