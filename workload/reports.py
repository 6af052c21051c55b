"""Queries: excursions, earnings events, sectors."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from barloom.functions import text as X
from barloom.operators import earnings as E
from barloom.operators.excursions import excursions as measure
from barloom.operators.indicators import session_index
from workload import inputs as W
from workload.registry import cte, day, query, r, with_ctes

TODAY = dt.date(1998, 6, 1)
HORIZONS = (5, 10, 20, 60)

# --- excursions: block trades of full lots are the anchors -----------------------------
cte("anchors", """SELECT DISTINCT security_id, date AS signal_date, CASE WHEN l_discount >= 0.05 THEN date + 4 END AS entry_date,
  CASE WHEN l_tax >= 0.06 THEN price END AS entry_price, CASE WHEN l_returnflag = 'R' THEN 'SHORT' ELSE 'LONG' END AS direction
FROM trades WHERE quantity = 50""", "trades")
cte("placed", "SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date) - 1 AS pos FROM bars", "bars")


def anchors(spark, d):
    return W.trades(spark, d).filter("quantity = 50").select(
        "security_id", F.col("date").alias("signal_date"),
        F.when(F.col("l_discount") >= 0.05, F.date_add("date", 4)).alias("entry_date"),
        F.when(F.col("l_tax") >= 0.06, F.col("price")).alias("entry_price"),
        F.when(F.col("l_returnflag") == "R", "SHORT").otherwise("LONG").alias("direction")).distinct()


def _horizon_sql(h):
    in_h = f"b.pos <= a.pos + {h}"
    known = f"count(b.pos) FILTER ({in_h}) = {h}"
    short = "direction = 'SHORT'"
    low, high = f"(min(b.low) FILTER ({in_h}) / price)", f"(max(b.high) FILTER ({in_h}) / price)"
    end = f"(max(b.close) FILTER (b.pos = a.pos + {h}) / price)"
    low_day = f"arg_min(b.pos - a.pos, b.low * 1e6 + (b.pos - a.pos) * 1e-3) FILTER ({in_h})"
    high_day = f"arg_max(b.pos - a.pos, b.high * 1e6 - (b.pos - a.pos) * 1e-3) FILTER ({in_h})"
    mfe = f"CASE WHEN {short} THEN 1 - {low} ELSE {high} - 1 END"
    back = f"CASE WHEN {short} THEN 1 - {end} ELSE {end} - 1 END"

    def k(expr):
        return f"CASE WHEN {known} THEN {expr} END"
    return ", ".join([
        r(k(f"CASE WHEN {short} THEN 1 - {high} ELSE {low} - 1 END"), f"mae_{h}"), r(k(mfe), f"mfe_{h}"),
        k(f"CASE WHEN {short} THEN {high_day} ELSE {low_day} END") + f" AS days_to_mae_{h}",
        k(f"CASE WHEN {short} THEN {low_day} ELSE {high_day} END") + f" AS days_to_mfe_{h}",
        r(k(back), f"final_return_{h}"), r(k(f"CASE WHEN {mfe} > 0 THEN ({back}) / nullif({mfe}, 0) END"), f"capture_{h}")])


#: From the CTEs `anchors` and `placed`.
EXCURSIONS_SQL = f"""
, found AS (SELECT a.*, coalesce(entry_date, signal_date) AS anchor_date, p.pos, coalesce(entry_price, p.close) AS price
  FROM anchors a LEFT JOIN placed p ON p.security_id = a.security_id AND p.date = coalesce(entry_date, signal_date))
SELECT a.security_id, {day('signal_date', 'signal_date')}, {day('anchor_date', 'anchor_date')}, direction, {r('price', 'price')},
  CASE WHEN a.pos IS NULL THEN 'ANCHOR_BAR_MISSING' END AS status, {', '.join(_horizon_sql(h) for h in HORIZONS)}
FROM found a LEFT JOIN placed b ON b.security_id = a.security_id AND b.pos > a.pos AND b.pos <= a.pos + 60
GROUP BY a.security_id, signal_date, anchor_date, direction, entry_date, entry_price, price, a.pos"""


@query("excursions", with_ctes("anchors", "placed") + EXCURSIONS_SQL)
def excursions(spark, d):
    return measure(anchors(spark, d), W.supplier_bars(spark, d)).drop("entry_date", "entry_price")


# --- earnings events: one per supplier and order date -------------------------------------
cte("reports", """SELECT printf('US-%06d', l_suppkey + 1) AS security_id, CAST(o_orderdate AS DATE) AS report_date,
  min(o_orderpriority) AS priority, min(o_orderstatus) AS status, max(o_totalprice) AS total
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
cte("report_events", """SELECT security_id || ':' || strftime(report_date, '%Y-%m-%d') AS event_id, security_id, report_date,
  CASE WHEN priority = '1-URGENT' THEN 'BMO' WHEN priority = '2-HIGH' THEN 'AMC' ELSE 'UNKNOWN' END AS session,
  CASE WHEN status = 'P' THEN 'REVISED' END AS event_status, CASE WHEN total > 450000 THEN 'COMPLETE' END AS reaction_status FROM reports""", "reports")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def reports(spark, d):
    """Orders meet their lines on the order key; the result is one row per supplier and day.

    Priority and status are compared by their first letter, as numbers: minima of text would
    turn the hash aggregation into a sort.
    """
    lines = W.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    orders = W.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("report_date"), F.ascii("o_orderpriority").alias("priority"),
        F.ascii("o_orderstatus").alias("status"), "o_totalprice")
    grouped = (orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("l_suppkey", "report_date")
               .agg(F.min("priority").alias("priority"), F.min("status").alias("status"), F.max("o_totalprice").alias("total")))
    names = F.array(*[F.lit(p) for p in PRIORITIES])
    return grouped.select(W.security_id(F.col("l_suppkey")).alias("security_id"), "report_date",
                          F.element_at(names, F.col("priority") - 48).alias("priority"),
                          F.chr(F.col("status").cast("bigint")).alias("status"), "total")


def report_events(spark, d):
    return reports(spark, d).select(
        F.concat_ws(":", "security_id", F.col("report_date").cast("string")).alias("event_id"), "security_id", "report_date",
        F.when(F.col("priority") == "1-URGENT", "BMO").when(F.col("priority") == "2-HIGH", "AMC").otherwise("UNKNOWN").alias("session"),
        F.when(F.col("status") == "P", "REVISED").alias("event_status"),
        F.when(F.col("total") > 450000, "COMPLETE").alias("reaction_status"))


def reaction_ctes(events: str) -> str:
    """CTEs up to `y`, the reactions of the events that are due."""
    return f"""
, due AS (SELECT * FROM {events} WHERE event_status IS NULL AND reaction_status IS NULL),
idxs AS (SELECT e.event_id, min(s.idx) AS idx FROM due e JOIN sessions s
    ON CASE WHEN e.session = 'BMO' THEN s.date >= e.report_date ELSE s.date > e.report_date END GROUP BY 1),
seq AS (SELECT b.*, s.idx FROM bars b JOIN sessions s USING (date)),
vols AS (SELECT e.event_id, count(v.volume) AS c, sum(v.volume) AS s FROM due e JOIN idxs i USING (event_id)
  JOIN seq v ON v.security_id = e.security_id AND v.idx >= i.idx - 20 AND v.idx < i.idx GROUP BY 1),
x AS (SELECT e.event_id, e.security_id, e.report_date, e.session, i.idx, p.close AS prev_close, b.open, b.close, b.volume, f.close AS c5,
    coalesce(c, 0) AS c, vols.s, (SELECT max(idx) FROM sessions) AS last_idx, ss.date AS reaction_date,
    coalesce(p.close > 0 AND b.close IS NOT NULL, false) AS priced
  FROM due e LEFT JOIN idxs i USING (event_id) LEFT JOIN vols USING (event_id) LEFT JOIN sessions ss ON ss.idx = i.idx
  LEFT JOIN seq p ON p.security_id = e.security_id AND p.idx = i.idx - 1 LEFT JOIN seq b ON b.security_id = e.security_id AND b.idx = i.idx
  LEFT JOIN seq f ON f.security_id = e.security_id AND f.idx = i.idx + 5),
y AS (SELECT *, CASE WHEN priced THEN open / prev_close - 1 END AS gap, CASE WHEN priced THEN close / prev_close - 1 END AS d1,
    CASE WHEN priced THEN c5 / prev_close - 1 END AS d5, CASE WHEN priced AND c = 20 AND s > 0 THEN volume / (s / 20) END AS ratio FROM x)"""


REACTION_STATUS = """CASE WHEN idx IS NULL THEN 'PENDING_PRICE' WHEN NOT priced THEN 'PRICE_MISSING' WHEN d5 IS NOT NULL AND ratio IS NOT NULL THEN 'COMPLETE' ELSE 'PARTIAL' END"""


@query("earnings_reaction", with_ctes("report_events", "bars", "sessions") + reaction_ctes("report_events") + f"""
SELECT event_id, security_id, {day('report_date', 'report_date')}, session, {day('reaction_date', 'reaction_date')}, {r('prev_close', 'prev_close')},
  {r('gap', 'gap_pct')}, {r('d1', 'day1_pct')}, {r('d5', 'day5_pct')}, {r('ratio', 'day1_volume_ratio')},
  CASE WHEN priced AND ratio IS NULL THEN CASE WHEN c < 20 THEN 'INSUFFICIENT_20_SESSION_VOLUME' ELSE 'ZERO_BASELINE_VOLUME' END END AS day1_volume_ratio_reason,
  CASE WHEN priced THEN CASE WHEN idx + 5 > last_idx THEN 'PENDING_FIVE_SESSIONS' WHEN d5 IS NULL THEN 'PRICE_MISSING' END END AS day5_reason,
  {REACTION_STATUS} AS reaction_status
FROM y
UNION ALL SELECT event_id, security_id, {day('report_date', 'report_date')}, session, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, reaction_status
FROM report_events WHERE event_status IS NOT NULL OR reaction_status IS NOT NULL""")
def earnings_reaction(spark, d):
    sessions = session_index(W.calendar(spark, d))
    return E.reactions(report_events(spark, d), W.supplier_bars(spark, d), sessions).drop("event_status")


@query("earnings_session_map", with_ctes("reports") + f"""
, t AS (SELECT security_id, report_date, CASE priority WHEN '1-URGENT' THEN 'time-pre-market' WHEN '2-HIGH' THEN 'time-after-hours'
    WHEN '3-MEDIUM' THEN 'time-not-supplied' ELSE priority END AS time_text FROM reports),
s AS (SELECT *, CASE time_text WHEN 'time-pre-market' THEN 'BMO' WHEN 'time-after-hours' THEN 'AMC' ELSE 'UNKNOWN' END AS session FROM t),
b AS (SELECT *, CASE WHEN session <> 'UNKNOWN' THEN
   (CAST(strftime(report_date, '%Y-%m-%d') || CASE WHEN session = 'BMO' THEN ' 09:30:00' ELSE ' 16:00:00' END AS TIMESTAMP)
     AT TIME ZONE 'America/New_York') AT TIME ZONE 'Asia/Kuala_Lumpur' END AS m FROM s)
SELECT security_id, {day('report_date', 'report_date')}, session, coalesce(strftime(m, '%Y-%m-%d'), strftime(report_date, '%Y-%m-%d')) AS report_date_myt,
  strftime(m, '%Y-%m-%dT%H:%M+08:00') AS boundary_myt, CASE session WHEN 'BMO' THEN 'BEFORE_OPEN' WHEN 'AMC' THEN 'AFTER_CLOSE' END AS window_name,
  CASE WHEN session = 'UNKNOWN' THEN 'UNKNOWN_SOURCE_TIME' END AS time_reason FROM b""")
def earnings_session_map(spark, d):
    text = (F.when(F.col("priority") == "1-URGENT", "time-pre-market").when(F.col("priority") == "2-HIGH", "time-after-hours")
            .when(F.col("priority") == "3-MEDIUM", "time-not-supplied").otherwise(F.col("priority")))
    events = reports(spark, d).select("security_id", "report_date", E.session_of_report(text).alias("session"))
    return E.report_time(events).withColumnRenamed("window", "window_name")


@query("calendar_sorted_unique", f"""
SELECT printf('US-%06d', o_custkey + 1) AS security_id, {day('CAST(o_orderdate AS DATE)', 'report_date')},
  arg_min(o_orderpriority, o_orderkey) AS priority, min(o_orderkey) AS sequence FROM orders GROUP BY 1, 2""")
def calendar_sorted_unique(spark, d):
    events = W.table(spark, d, "orders").select(
        W.security_id(F.col("o_custkey")).alias("security_id"), F.col("o_orderdate").cast("date").alias("report_date"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("sequence"))
    return E.unique_calendar(events)


cte("active", "SELECT * FROM securities WHERE listing_status = 'ACTIVE'", "securities")


def active(spark, d):
    return W.securities(spark, d).filter("listing_status = 'ACTIVE'")


@query("no_event_status", with_ctes("active", "report_events") + f"""
SELECT security_id, 'NO_DATE_IN_WINDOW' AS status FROM active
ANTI JOIN (SELECT security_id FROM report_events WHERE report_date >= DATE '2001-07-25') e USING (security_id)""")
def no_event_status(spark, d):
    upcoming = report_events(spark, d).filter(F.col("report_date") >= F.lit(dt.date(2001, 7, 25)))
    return E.no_event_status(active(spark, d), upcoming)


# Old calendar: open orders; new calendar: finished ones; history: pending ones.
@query("calendar_to_history", with_ctes("reports") + f"""
, old AS (SELECT security_id, report_date FROM reports WHERE status = 'O'), new AS (SELECT security_id, report_date FROM reports WHERE total > 400000),
hist AS (SELECT security_id, report_date FROM reports WHERE total < 100000),
dates AS (SELECT security_id, list_sort(list(DISTINCT report_date)) AS ds FROM new GROUP BY 1),
moved AS (SELECT o.*, CASE WHEN ds IS NULL OR list_contains(ds, report_date) THEN [] ELSE ds END AS revised FROM old o LEFT JOIN dates USING (security_id)),
kept AS (SELECT * FROM moved WHERE report_date < DATE '{TODAY}' OR len(revised) > 0)
SELECT security_id || ':' || strftime(report_date, '%Y-%m-%d') AS event_id, security_id, {day('report_date', 'report_date')},
  CASE WHEN len(revised) > 0 THEN 'REVISED' END AS event_status, coalesce(len(revised), 0) AS revision_count,
  strftime(revised[1], '%Y-%m-%d') AS first_new_date, h.security_id IS NULL AS is_new, h.security_id IS NULL AND report_date < DATE '{TODAY}' AS eps_refresh_pending
FROM hist h FULL JOIN kept USING (security_id, report_date)""".replace("h.security_id IS NULL", "h.k IS NULL").replace(
    "hist AS (SELECT security_id, report_date FROM", "hist AS (SELECT security_id, report_date, 1 AS k FROM"))
def calendar_to_history(spark, d):
    rows = reports(spark, d).withColumn("session", F.lit("UNKNOWN"))
    history = rows.filter("total < 100000").select(
        F.concat_ws(":", "security_id", F.col("report_date").cast("string")).alias("event_id"), "security_id", "report_date",
        "session", F.lit(None).cast("string").alias("event_status"),
        F.array().cast("array<struct<old_date:date,new_date:date>>").alias("revisions"))
    out = E.calendar_to_history(rows.filter("status = 'O'"), rows.filter("total > 400000"), history, TODAY)
    return out.select("event_id", "security_id", "report_date", "event_status", F.size("revisions").alias("revision_count"),
                      F.try_element_at("revisions", F.lit(1))["new_date"].alias("first_new_date"), "is_new", "eps_refresh_pending")


_EPS_TEXT_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN '$' || o_totalprice WHEN '2-HIGH' THEN '(' || o_totalprice || ')'
  WHEN '3-MEDIUM' THEN 'N/A' WHEN '4-NOT SPECIFIED' THEN o_totalprice || '%' ELSE '--' END"""


def _eps_text():
    total = F.col("o_totalprice").cast("string")
    p = F.col("o_orderpriority")
    return (F.when(p == "1-URGENT", F.concat(F.lit("$"), total)).when(p == "2-HIGH", F.concat(F.lit("("), total, F.lit(")")))
            .when(p == "3-MEDIUM", "N/A").when(p == "4-NOT SPECIFIED", F.concat(total, F.lit("%"))).otherwise("--"))


_EPS_VALUE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice WHEN '2-HIGH' THEN -o_totalprice WHEN '4-NOT SPECIFIED' THEN o_totalprice END"""


@query("numeric_text_parse", f"SELECT o_orderkey, {_EPS_TEXT_SQL} AS source_text, {r(_EPS_VALUE_SQL, 'value')} FROM orders")
def numeric_text_parse(spark, d):
    text = _eps_text()
    return W.table(spark, d, "orders").select("o_orderkey", text.alias("source_text"), X.parse_number(text).alias("value"))


@query("eps_refresh", with_ctes("reports") + f"""
, provider AS (SELECT CAST(o_orderdate AS DATE) AS report_date, 'C' || o_custkey AS k, arg_max({_EPS_VALUE_SQL.replace('END', 'ELSE -1e99 END')}, o_orderkey) AS v FROM orders GROUP BY 1, 2),
hist AS (SELECT security_id, report_date, 'C' || (CAST(substr(security_id, 4) AS BIGINT) - 1) AS k, CASE WHEN status = 'F' THEN 1.5::DOUBLE END AS eps_actual, total < 300000 AS pending FROM reports)
SELECT security_id, {day('h.report_date', 'report_date')}, {r("CASE WHEN filled THEN v ELSE eps_actual END", 'eps_actual')},
  CASE WHEN filled THEN 'AVAILABLE' ELSE 'EPS_ACTUAL_UNAVAILABLE' END AS eps_status, CASE WHEN filled THEN false ELSE pending END AS eps_refresh_pending
FROM (SELECT h.*, p.v, coalesce(h.report_date < DATE '{TODAY}' AND eps_actual IS NULL AND pending AND p.v > -1e90, false) AS filled
  FROM hist h LEFT JOIN provider p ON p.report_date = h.report_date AND p.k = h.k) h""")
def eps_refresh(spark, d):
    provider = W.table(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("report_date"), F.concat(F.lit("c."), F.col("o_custkey")).alias("symbol"),
        _eps_text().alias("eps"), F.lit(None).cast("string").alias("surprise"), F.col("o_orderkey").alias("sequence"))
    number = F.substring("security_id", 4, 20).cast("bigint") - 1
    history = reports(spark, d).select(
        "security_id", "report_date", F.concat(F.lit("C/"), number).alias("ticker"),
        F.when(F.col("status") == "F", 1.5).alias("eps_actual"), F.lit(None).cast("double").alias("eps_surprise_pct"),
        F.lit("EPS_ACTUAL_UNAVAILABLE").alias("eps_status"), (F.col("total") < 300000).alias("eps_refresh_pending"))
    return E.eps_refresh(history, provider, TODAY).drop("ticker", "eps_surprise_pct")


@query("history_transition_check", with_ctes("report_events", "active") + """
, prev AS (SELECT event_id FROM report_events WHERE event_status IS NULL AND security_id < 'US-000900'),
hist AS (SELECT event_id, security_id, report_date FROM report_events WHERE session <> 'AMC' UNION ALL
  SELECT event_id, security_id, report_date + 1 FROM report_events WHERE event_status = 'REVISED')
SELECT DISTINCT event_id, error FROM (
  SELECT event_id, 'DUPLICATE_EVENT' AS error FROM hist GROUP BY 1 HAVING count(*) > 1
  UNION ALL SELECT event_id, 'EVENT_REMOVED' FROM prev ANTI JOIN hist USING (event_id)
  UNION ALL SELECT event_id, 'IDENTITY_MISMATCH' FROM hist WHERE NOT (security_id LIKE 'US-%' AND event_id = security_id || ':' || strftime(report_date, '%Y-%m-%d'))
  UNION ALL SELECT event_id, 'NEW_INACTIVE_EVENT' FROM hist ANTI JOIN active USING (security_id) WHERE event_id NOT IN (SELECT event_id FROM prev)) t""".replace(" AND security_id < 'US-000900'", ""))
def history_transition_check(spark, d):
    events = report_events(spark, d)
    previous = events.filter(F.col("event_status").isNull()).select("event_id")
    keep = events.filter("session <> 'AMC'").select("event_id", "security_id", "report_date")
    moved = events.filter("event_status = 'REVISED'").select("event_id", "security_id", F.date_add("report_date", 1).alias("report_date"))
    return E.history_violations(previous, keep.unionByName(moved), active(spark, d), "US")


@query("ticker_normalize", """SELECT c_custkey, upper(replace(replace(replace(trim(t), '.', ''), '/', ''), '-', '')) AS us_key,
  CASE WHEN c_custkey < 100000 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS hk_key
FROM (SELECT c_custkey, ' ' || lower(substr(c_mktsegment, 1, 3)) || '.' || c_nationkey || '/a-b ' AS t FROM customer) x""")
def ticker_normalize(spark, d):
    us = F.concat(F.lit(" "), F.lower(F.substring("c_mktsegment", 1, 3)), F.lit("."), F.col("c_nationkey"), F.lit("/a-b "))
    hk = F.concat(F.lit("code "), F.col("c_custkey"), F.lit(".hk"))
    return W.table(spark, d, "customer").select("c_custkey", X.us_ticker_key(us).alias("us_key"), X.hk_ticker_key(hk).alias("hk_key"))


cte("mentions", """SELECT c_custkey, 'N' || c_nationkey || (c_custkey // 4) AS k FROM customer""")


@query("ticker_resolve", with_ctes("active", "mentions") + """
, idx AS (SELECT replace(ticker, '.', '') AS k, count(DISTINCT security_id) AS c, min(security_id) AS one FROM active WHERE market = 'US' GROUP BY 1)
SELECT c_custkey, k AS key, CASE WHEN c = 1 THEN one END AS security_id,
  CASE WHEN c > 1 THEN 'AMBIGUOUS' WHEN c = 1 THEN 'RESOLVED' ELSE 'UNKNOWN' END AS match FROM mentions LEFT JOIN idx USING (k)""")
def ticker_resolve(spark, d):
    mentions = W.table(spark, d, "customer").select(
        "c_custkey", F.lit("US").alias("market"), F.lit(TODAY).alias("day"),
        F.concat(F.lit(" n"), F.col("c_nationkey"), F.lit("-"), F.floor(F.col("c_custkey") / 4).cast("bigint")).alias("ticker"))
    from barloom.contracts import RENAMED_TICKER as A
    aliases = spark.range(1).select(F.lit(A["ticker"]).alias("key"), F.lit(A["before"]).cast("date").alias("before"),
                                    F.lit(A["security_id"]).alias("alias_id"))
    return E.resolve_tickers(mentions, active(spark, d), aliases).select("c_custkey", "key", "security_id", "match")


@query("results_meeting_filter", f"""
SELECT o_orderkey, {day('CAST(o_orderdate AS DATE)', 'meeting_date')} FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') AND o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) >= DATE '{TODAY}'""")
def results_meeting_filter(spark, d):
    p = F.col("o_orderpriority")
    purpose = (F.when(p == "1-URGENT", "FIN RES").when(p == "2-HIGH", "Int Res/Dividend").when(p == "3-MEDIUM", "DIVIDEND")
               .when(p == "4-NOT SPECIFIED", "Quarterly Results").otherwise("OTHERS"))
    text = F.when(F.col("o_orderstatus") == "P", "31/02/1999").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    rows = W.table(spark, d, "orders").select("o_orderkey", purpose.alias("purpose"), X.parse_day(text).alias("meeting_date"))
    return rows.filter(X.is_results_meeting(F.col("purpose")) & (F.col("meeting_date") >= F.lit(TODAY))).drop("purpose")


@query("enrichment_freshness", f"""
SELECT o_custkey, {day('daily', 'daily')}, CASE WHEN enriched IS NULL THEN 'NOT_RECORDED' WHEN enriched = daily THEN 'CURRENT'
  WHEN enriched < daily THEN 'BEHIND' ELSE 'RECEIPT_CONFLICT' END AS freshness
FROM (SELECT o_custkey, max(o_orderdate) FILTER (o_orderstatus <> 'P') AS daily, max(o_orderdate) FILTER (o_orderpriority < '3') AS enriched FROM orders GROUP BY 1) t
WHERE daily IS NOT NULL""")
def enrichment_freshness(spark, d):
    when = F.col("o_orderdate").cast("date")
    marks = W.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.max(F.when(F.col("o_orderstatus") != "P", when)).alias("daily"),
        F.max(F.when(F.col("o_orderpriority") < "3", when)).alias("enriched")).filter("daily IS NOT NULL")
    return marks.select("o_custkey", "daily", E.freshness(F.col("daily"), F.col("enriched")).alias("freshness"))


@query("enrichment_completeness", f"""
WITH wanted AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{TODAY}' AND DATE '{TODAY}' + 95),
cached AS (SELECT CAST(o_orderdate AS DATE) AS date, DATE '{TODAY}' - CAST(min(o_custkey) % 11 AS INTEGER) AS fetched_on FROM orders GROUP BY 1),
fetched AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders GROUP BY 1 HAVING max(o_totalprice) > 400000)
SELECT {day('date', 'date')}, CASE WHEN DATE '{TODAY}' - fetched_on <= CASE WHEN date - DATE '{TODAY}' <= 14 THEN 0 ELSE 7 END THEN 'REUSED'
  WHEN f.date IS NOT NULL THEN 'FETCHED' ELSE 'MISSING' END AS state FROM wanted JOIN cached USING (date) LEFT JOIN fetched f USING (date)""".replace(
    "f.date IS NOT NULL", "k IS NOT NULL").replace("fetched AS (SELECT CAST(o_orderdate AS DATE) AS date FROM", "fetched AS (SELECT CAST(o_orderdate AS DATE) AS date, 1 AS k FROM"))
def enrichment_completeness(spark, d):
    orders = W.table(spark, d, "orders").withColumn("date", F.col("o_orderdate").cast("date"))
    wanted = orders.filter(F.col("date").between(F.lit(TODAY), F.lit(TODAY + dt.timedelta(days=95)))).select("date").distinct()
    cached = orders.groupBy("date").agg(F.date_sub(F.lit(TODAY), (F.min("o_custkey") % 11).cast("int")).alias("fetched_on"))
    fetched = orders.groupBy("date").agg(F.max("o_totalprice").alias("top")).filter("top > 400000").select("date")
    return E.completeness(wanted, cached, fetched, TODAY)


# --- sectors: the screener lists customers, filings list parts ----------------------------
@query("sector_enrich", with_ctes("active") + """
, us AS (SELECT security_id, ticker, replace(ticker, '.', '') AS k FROM active WHERE market = 'US'),
shared AS (SELECT k, count(*) AS ids FROM us GROUP BY 1),
screener AS (SELECT 'N' || c_nationkey || (c_custkey // 4) AS k, count(*) AS c, any_value(c_mktsegment) AS sector, any_value(c_name) AS industry FROM customer GROUP BY 1),
filings AS (SELECT 'N' || (p_size % 25) || (p_partkey // 20) AS k, max(CASE WHEN p_type <> 'PROMO' THEN p_brand END) AS sic, 1 AS filed FROM part GROUP BY 1),
j AS (SELECT *, coalesce(ids > 1 OR c > 1, false) AS ambiguous FROM us LEFT JOIN shared USING (k) LEFT JOIN screener USING (k) LEFT JOIN filings USING (k)),
s AS (SELECT *, NOT ambiguous AND sector IS NOT NULL AS prim FROM j)
SELECT security_id, ticker, CASE WHEN prim THEN sector ELSE 'UNCLASSIFIED' END AS sector,
  CASE WHEN prim THEN industry WHEN sic IS NOT NULL THEN 'code ' || sic ELSE 'UNCLASSIFIED' END AS industry,
  CASE WHEN NOT prim THEN sic END AS sic_code, CASE WHEN prim THEN 'NASDAQ' WHEN sic IS NOT NULL THEN 'SEC_SIC' END AS source,
  CASE WHEN NOT prim AND sic IS NULL THEN CASE WHEN filed = 1 THEN 'SEC_SIC_NOT_PUBLISHED' ELSE 'NO_SOURCE_MATCH' END END AS reason, ambiguous,
  CASE WHEN CASE WHEN prim THEN sector ELSE 'UNCLASSIFIED' END <> 'BUILDING' THEN 1 ELSE 0 END AS change_count FROM s""")
def sector_enrich(spark, d):
    us = active(spark, d).filter("market = 'US'")
    screener = W.table(spark, d, "customer").select(
        F.concat(F.lit("N"), F.col("c_nationkey"), F.lit("."), F.floor(F.col("c_custkey") / 4).cast("bigint")).alias("symbol"),
        F.col("c_mktsegment").alias("sector"), F.col("c_name").alias("industry"))
    filings = W.table(spark, d, "part").select(
        F.concat(F.lit("N"), F.col("p_size") % 25, F.floor(F.col("p_partkey") / 20).cast("bigint")).alias("symbol"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("sic"), F.concat(F.lit("code "), F.col("p_brand")).alias("sic_description"))
    first = E.classify_sectors(us, screener, filings)
    # A prior record that says BUILDING everywhere: every other sector is logged as a change.
    record = "struct<sector:string,industry:string,sic_code:string>"
    prior = first.select("security_id", F.lit("BUILDING").alias("sector"), "industry", "sic_code",
                         F.array().cast(f"array<struct<old:{record},new:{record}>>").alias("changes"))
    return E.classify_sectors(us, screener, filings, prior).withColumn("change_count", F.size("changes")).drop("changes")


@query("industry_membership", """WITH targets AS (SELECT printf('HK-%06d', s_suppkey + 1) AS security_id, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS code FROM supplier WHERE s_suppkey < 100000),
m AS (SELECT lpad(CAST(c_custkey // 2 * 2 + c_nationkey % 2 AS VARCHAR), 5, '0') AS code, count(*) AS c, min(c_mktsegment) AS seg, min(c_name) AS name FROM customer GROUP BY 1)
SELECT security_id, code, CASE WHEN c = 1 THEN seg ELSE 'UNCLASSIFIED' END AS industry, CASE WHEN c = 1 THEN name END AS subsector,
  CASE WHEN c = 1 THEN 'AASTOCKS_HSICS' END AS source, CASE WHEN c = 1 THEN NULL ELSE 'NOT_IN_HSICS' END AS reason, coalesce(c > 1, false) AS ambiguous
FROM targets LEFT JOIN m USING (code)""")
def industry_membership(spark, d):
    hk = W.table(spark, d, "supplier").select(
        W.security_id(F.col("s_suppkey"), "HK").alias("security_id"), X.hk_ticker(F.col("s_suppkey")).alias("ticker"))
    code = F.floor(F.col("c_custkey") / 2).cast("bigint") * 2 + F.col("c_nationkey") % 2
    members = W.table(spark, d, "customer").select(
        F.lpad(code.cast("string"), 5, "0").alias("code"), F.col("c_mktsegment").alias("industry_symbol"),
        F.col("c_mktsegment").alias("industry"), F.col("c_name").alias("subsector"))
    return E.classify_industries(hk, members).drop("industry_symbol")
