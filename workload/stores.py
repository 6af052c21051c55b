"""Queries: files in and out, streaming, and whole pipelines."""
from __future__ import annotations

import datetime as dt
import functools
import os

from pyspark.sql import functions as F

from barloom import files
from barloom.functions.digests import digest, merged, row_text
from barloom.operators import indicators as I
from barloom.operators import compose as CP
from barloom.plans import daily_append as DA
from barloom.plans import incremental as INC
from barloom.plans import refresh as REF
from barloom.plans.combined_monthly import combined_pointer
from barloom.plans.daily_append import daily_append
from barloom.plans.daily_rank import daily_rank_run
from barloom.plans.earnings_daily import earnings_daily as earnings_plan
from barloom.plans.hk_monthly import hk_monthly as hk_plan
from barloom.plans.us_monthly import us_monthly as us_plan
from barloom.plans.us_monthly import us_pointer
from barloom.session import scratch_path, stage
from barloom.sinks import stores as ST
from barloom.sinks.buckets import append_buckets, read_buckets
from barloom.sinks.ledger import Write
from barloom.sources import charts as CH
from barloom.sources import documents as DOC
from barloom.sources import pages as PG
from barloom.streaming.ingest import ingest_bars
from workload import backtest as BT
from workload import digests as D
from workload import inputs as W
from workload import prices as PR
from workload import records as RC
from workload import reports as RP
from workload.registry import ORACLES, CTES, cte, day, query, r, with_ctes

BAR_COLUMNS = PR.BAR_COLUMNS
BARS_SQL = with_ctes("bars") + f"SELECT security_id, {day('date', 'date')}, {BAR_COLUMNS} FROM bars"
FIELDS = ["security_id", "date", "open", "high", "low", "close", "volume"]


def older_suffix(spark, folder):
    """Give the parts in a folder the older suffix."""
    for name in files.names(spark, folder):
        if name.endswith(".gz"):
            files.rename(spark, os.path.join(folder, name), os.path.join(folder, name.removesuffix(".gz") + ".gzip"))


@query("ndjson_bar_scan", BARS_SQL)
def ndjson_bar_scan(spark, d):
    """Parts under both suffixes: the sealed history under the older one."""
    path = scratch_path(spark, "bars-json")
    ST.write_bars_json(W.supplier_bars(spark, d, until=W.BASE_AS_OF), os.path.join(path, "history"))
    ST.write_bars_json(W.supplier_bars(spark, d, after=W.BASE_AS_OF), os.path.join(path, "days"))
    older_suffix(spark, os.path.join(path, "history"))
    return DOC.read_bars(spark, path).select(*FIELDS)


@query("csv_snapshot_scan", BARS_SQL)
def csv_snapshot_scan(spark, d):
    path = scratch_path(spark, "bars-csv")
    W.supplier_bars(spark, d).select(*FIELDS).write.option("header", True).option("compression", "gzip").csv(path)
    return DOC.read_csv_bars(spark, path)


@query("day_folder_scan", with_ctes("bars") + f"SELECT security_id, {day('date', 'date')}, {day('date', 'folder_date')}, {r('close', 'close')} FROM bars")
def day_folder_scan(spark, d):
    path = scratch_path(spark, "folders")
    bars = W.supplier_bars(spark, d).withColumn("folder", F.col("date"))
    bars.hint("rebalance", "folder").write.partitionBy("folder").option("compression", "gzip").json(path)
    for name in files.names(spark, path):
        if name.endswith("1"):  # days that end in one
            older_suffix(spark, os.path.join(path, name))
    return DOC.read_day_folders(spark, path).select("security_id", "date", "folder_date", "close")


@query("patch_documents", with_ctes("patch_rows") + f"""
SELECT security_id, {day('date', 'date')}, {r('close', 'close')}, accepted, result, item, position FROM (
  SELECT *, dense_rank() OVER (PARTITION BY security_id ORDER BY accepted, result) - 1 AS item2,
    row_number() OVER (PARTITION BY security_id, accepted, result ORDER BY date, close, path, item) - 1 AS position2 FROM patch_rows)""".replace(
    "result, item, position FROM", "result, item2 AS item, position2 AS position FROM"))
def patch_documents(spark, d):
    """Bulk documents, one per security, with one item per verdict; read back to rows."""
    bar = F.struct("date", F.col("close").alias("o_close"), "path", "item", F.struct(
        "security_id", "date", F.lit(None).cast("date").alias("trade_date"), "open", "high", "low", "close", "volume", "adjustment_as_of").alias("bar"))
    items = W.patch_rows(spark, d).groupBy("security_id", "accepted", "result").agg(F.array_sort(F.collect_list(bar)).alias("rows"))
    item = F.struct("accepted", "result", F.lit("US").alias("market"), "security_id", F.col("rows.bar").alias("rows"))
    documents = items.groupBy("security_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    path = scratch_path(spark, "patches")
    documents.select("items").write.json(path)
    return DOC.read_patches(spark, path, one_per_file=False).select("security_id", "date", "close", "accepted", "result", "item", "position")


@query("corporate_action_documents", with_ctes("splits") + f"""
SELECT DISTINCT security_id, {day('effective_date', 'effective_date')}, {r('factor', 'factor')} FROM splits""")
def corporate_action_documents(spark, d):
    path = scratch_path(spark, "actions")
    lists = W.splits(spark, d).distinct().groupBy("security_id").agg(F.collect_list(F.struct(
        F.col("security_id").alias("id"), "effective_date", "factor", "ticker")).alias("events"))
    lists.select(F.to_json(F.transform("events", lambda e: F.struct(
        e["id"].alias("security_id"), e["effective_date"].alias("effective_date"), e["factor"].alias("factor"),
        e["ticker"].alias("ticker")))).alias("value")).write.text(path)
    return DOC.read_corporate_actions(spark, path, one_per_file=False).select("security_id", "effective_date", "factor")


# Symbol files made of parts (first file) and customers (second file).
cte("symbols", """SELECT 'nasdaqlisted.txt' AS file, 'P.' || p_partkey AS symbol, p_name || ' Common Stock' || CASE WHEN p_size < 5 THEN ' Warrants' ELSE '' END AS name,
  CASE WHEN p_type = 'PROMO' THEN 'Y' ELSE 'N' END AS etf, 'N' AS test, NULL AS letter, p_partkey AS seq FROM part
UNION ALL SELECT 'otherlisted.txt', 'C' || c_custkey, c_name || CASE WHEN c_nationkey < 5 THEN ' Acquisition Corp Class A' ELSE '' END, 'N', CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'A' WHEN c_mktsegment = 'MACHINERY' THEN 'P' ELSE 'N' END, c_custkey FROM customer""")


def symbol_lines(spark, d):
    part, customer = W.table(spark, d, "part"), W.table(spark, d, "customer")
    first = part.select(F.lit("nasdaqlisted.txt").alias("file"), F.col("p_partkey").alias("place"), F.concat_ws(
        "|", F.concat(F.lit("P."), "p_partkey"), F.concat("p_name", F.lit(" Common Stock"), F.when(F.col("p_size") < 5, " Warrants").otherwise("")),
        F.lit("N"), F.when(F.col("p_type") == "PROMO", "Y").otherwise("N")).alias("value"))
    second = customer.select(F.lit("otherlisted.txt").alias("file"), F.col("c_custkey").alias("place"), F.concat_ws(
        "|", F.concat(F.lit("C"), "c_custkey"), F.concat("c_name", F.when(F.col("c_nationkey") < 5, " Acquisition Corp Class A").otherwise("")),
        F.when(F.col("c_mktsegment") == "BUILDING", "A").when(F.col("c_mktsegment") == "MACHINERY", "P").otherwise("N"),
        F.lit("N"), F.when(F.col("c_acctbal") < 0, "Y").otherwise("N")).alias("value"))
    body = first.unionByName(second)
    ends = body.groupBy("file").agg(F.max("place").alias("last"))
    heads = F.when(F.col("file") == "nasdaqlisted.txt", "Symbol|Security Name|Test Issue|ETF").otherwise("ACT Symbol|Security Name|Exchange|ETF|Test Issue")
    frame = ends.select("file", F.inline(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("place"), heads.alias("value")),
        F.struct((F.col("last") + 1).alias("place"), F.lit("File Creation Time: 0101202400:00|||").alias("value")))))
    return body.unionByName(frame)


@query("listing_file_scan", with_ctes("symbols") + f"""
SELECT symbol AS source_symbol, replace(symbol, '.', '-') AS ticker, CASE WHEN file = 'nasdaqlisted.txt' THEN 'NASDAQ' WHEN letter = 'A' THEN 'NYSE_AMERICAN' ELSE 'NYSE' END AS exchange, name, file
FROM symbols WHERE etf = 'N' AND test = 'N' AND coalesce(letter, '') <> 'P' AND NOT ({RC._noncommon('name')} OR {RC._spac('name')})""")
def listing_file_scan(spark, d):
    from barloom.operators.listing import us_listing
    return us_listing(PG.listing_rows(symbol_lines(spark, d)))


# Chart payloads: the parallel arrays of a security, market by nation.
def charts(spark, d):
    bars = W.supplier_bars(spark, d)
    market = W.securities(spark, d).select("security_id", "market", "ticker")
    stamp = F.unix_date("date").cast("bigint") * 86400 + 14 * 3600
    x = F.struct(stamp.alias("timestamp"), "open", F.when(F.col("volume") == 50, F.col("low")).otherwise(F.col("high")).alias("high"), "low",
                 F.when(F.col("volume") == 49, None).otherwise(F.col("close")).alias("close"),
                 F.when(F.col("volume") == 48, float("nan")).otherwise(F.col("volume")).alias("volume"))
    packed = bars.groupBy("security_id").agg(F.array_sort(F.collect_list(x)).alias("x"))
    splits = W.splits(spark, d).groupBy("security_id").agg(F.collect_set(F.struct(
        (F.unix_date("effective_date").cast("bigint") * 86400 + 14 * 3600).alias("date"), (F.col("factor") * 2).alias("numerator"), F.lit(2.0).alias("denominator"))).alias("s"))
    rows = packed.join(market, "security_id").join(splits, "security_id", "left")
    chart = F.struct(F.lit(None).cast("bigint").alias("gmtoffset"), *[F.col(f"x.{f}").alias(f) for f in ("timestamp", "open", "high", "low", "close", "volume")],
                     F.map_from_entries(F.transform("s", lambda e, i: F.struct(i.cast("string"), e))).alias("splits"))
    return rows.select("security_id", "market", "ticker", chart.alias("chart"))


cte("chart_rows", """SELECT b.security_id, s.market, b.date, b.open, CASE WHEN volume = 50 THEN b.low ELSE b.high END AS h, b.low, b.close, b.volume
FROM bars b JOIN securities s USING (security_id) WHERE volume NOT IN (48, 49)""", "bars", "securities")
_HK = "market = 'HK' AND least(open, h, low, close) > 0"


@query("chart_payload_bars", with_ctes("chart_rows") + f"""
SELECT security_id, {day('date', 'date')}, {r('open', 'open')}, {r(f'CASE WHEN {_HK} THEN greatest(open, h, low, close) ELSE h END', 'high')},
  {r(f'CASE WHEN {_HK} THEN least(open, h, low, close) ELSE low END', 'low')}, {r('close', 'close')}, {r('volume', 'volume')}
FROM chart_rows WHERE date <= DATE '{W.AS_OF}'""")
def chart_payload_bars(spark, d):
    return CH.chart_bars(charts(spark, d), W.calendar(spark, d), W.AS_OF).drop("adjustment_as_of")


@query("hk_envelope_fix", with_ctes("bars") + f"""
, z AS (SELECT security_id, date, open, CASE WHEN volume > 60 THEN low ELSE high END AS high, CASE WHEN volume = 1 THEN 0 ELSE low END AS low, close, CASE WHEN volume = 1 THEN 0 ELSE volume END AS volume FROM bars),
i AS (SELECT *, volume = 0 AND close > 0 AND least(open, high, low) <= 0 AS idle, least(open, high, low, close) > 0 AS pos FROM z)
SELECT security_id, {day('date', 'date')}, {r('CASE WHEN idle THEN close ELSE open END', 'open')}, {r('CASE WHEN idle THEN close WHEN pos THEN greatest(open, high, low, close) ELSE high END', 'high')},
  {r('CASE WHEN idle THEN close WHEN pos THEN least(open, high, low, close) ELSE low END', 'low')}, {r('close', 'close')} FROM i""")
def hk_envelope_fix(spark, d):
    bars = W.supplier_bars(spark, d).select(
        "security_id", "date", "open", F.when(F.col("volume") > 60, F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(F.col("volume") == 1, 0.0).otherwise(F.col("low")).alias("low"), "close", F.when(F.col("volume") == 1, 0.0).otherwise(F.col("volume")).alias("volume"))
    fixed = CH.hk_envelope()
    return bars.select("security_id", "date", *[fixed[c].alias(c) for c in ("open", "high", "low")], "close")


@query("chart_split_events", with_ctes("splits") + f"""
SELECT DISTINCT security_id, {day('effective_date', 'effective_date')}, {r('factor', 'factor')} FROM splits SEMI JOIN (SELECT security_id FROM securities) USING (security_id)""".replace(
    "SELECT security_id FROM securities", "SELECT printf('US-%06d', s_suppkey + 1) AS security_id FROM supplier"))
def chart_split_events(spark, d):
    return CH.chart_splits(charts(spark, d)).drop("ticker")


@query("later_splits_undone", with_ctes("bars", "splits") + f"""
, f AS (SELECT b.security_id, b.date, coalesce(product(e.factor), 1) AS f FROM bars b LEFT JOIN (SELECT DISTINCT security_id, effective_date, factor FROM splits WHERE effective_date > DATE '{W.BASE_AS_OF}') e
  ON e.security_id = b.security_id AND b.date < e.effective_date GROUP BY 1, 2)
SELECT b.security_id, {day('b.date', 'date')}, {r('open * f', 'open')}, {r('high * f', 'high')}, {r('low * f', 'low')}, {r('close * f', 'close')}, {r('volume / f', 'volume')}
FROM bars b JOIN f ON f.security_id = b.security_id AND f.date = b.date""")
def later_splits_undone(spark, d):
    return CH.undo_later_splits(W.supplier_bars(spark, d), W.splits(spark, d), W.BASE_AS_OF)


@query("html_table_rows", r"""
WITH rows_ AS (SELECT page_id, regexp_extract_all(html, '(?is)<ul\b[^>]*>(.*?)</ul>', 1) AS ms FROM pages),
a AS (SELECT page_id, unnest(range(len(ms))) AS row_no, unnest(ms) AS m FROM rows_),
b AS (SELECT page_id, row_no, regexp_extract_all(m, '(?is)<(?:li)\b[^>]*>(.*?)</(?:li)>', 1) AS cs FROM a),
c AS (SELECT page_id, row_no, unnest(range(len(cs))) AS cell_no, unnest(cs) AS cell FROM b)
SELECT page_id, row_no, cell_no, trim(regexp_replace(replace(replace(replace(regexp_replace(cell, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM c""")
def html_table_rows(spark, d):
    return PG.page_cells(W.table(spark, d, "pages").select("page_id", "html"), row="ul", cell="li")


@query("nested_table_rows", """
SELECT o_orderkey AS page_id, unnest([0, 0, 1, 2]) AS row_no, unnest([0, 1, 0, 0]) AS cell_no,
  unnest([o_orderkey::VARCHAR, o_orderpriority || ' & more', o_orderstatus, strftime(o_orderdate, '%Y-%m-%d')]) AS text FROM orders""")
def nested_table_rows(spark, d):
    """An order is a page; wanted is the table with the id, and what is nested in it is told apart."""
    inner = F.concat(F.lit("<table><tr><td>"), "o_orderstatus", F.lit("</td></tr></table>"))
    html = F.concat(F.lit("<p>Orders</p><table id='first'><tr><td>no</td></tr></table><table class='w' id=\"wanted\"><tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td> "),
                    "o_orderpriority", F.lit(" <i>&amp;</i>\n more</td></tr><tr><td>a"), inner, F.lit("b</td><td>not read</td></tr><tr><th>"), F.date_format("o_orderdate", "yyyy-MM-dd"),
                    F.lit("</th></tr></table><table><tr><td>after</td></tr></table>"))
    return PG.table_cells(W.table(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html")), "wanted")


@query("designated_list", f"""
WITH r AS (SELECT o_orderstatus AS list_id, DATE '2001-05-21' - CAST(o_orderkey % 3 AS INTEGER) AS page_date, o_orderkey, o_orderkey % 100000 AS code, o_orderpriority AS st FROM orders),
l AS (SELECT list_id, page_date, code, arg_max(st, o_orderkey) AS st FROM r GROUP BY 1, 2, 3),
n AS (SELECT list_id, max(page_date) AS page_date FROM (SELECT list_id, page_date FROM l GROUP BY 1, 2 HAVING count(*) >= 100) u GROUP BY 1)
SELECT list_id, {day('page_date', 'effective_date')}, code AS stock_code, printf('%04d', code) || '.HK' AS ticker, st || '!' AS name FROM l SEMI JOIN n USING (list_id, page_date)""")
def designated_list(spark, d):
    """An order is a page of its status' list; the pages of one day are one issue, three days make up all orders."""
    code = (F.col("o_orderkey") % 100000).cast("string")
    html = F.concat(F.lit("<h1>Designated Securities</h1><table><tr><td>1</td><td class='c'>"), code, F.lit("</td><td><b>"),
                    F.col("o_orderpriority"), F.lit("</b>&#33;</td></tr></table>"))
    pages = W.table(spark, d, "orders").select(F.col("o_orderstatus").alias("list_id"), F.date_sub(F.lit(dt.date(2001, 5, 21)), (F.col("o_orderkey") % 3).cast("int")).alias("page_date"),
                                               F.col("o_orderkey").alias("page_no"), html.alias("html"))
    return PG.designated_securities(pages, dt.date(2001, 5, 21))


@query("snapshot_identity", with_ctes("type_bars") + f"""
, w AS (SELECT * FROM (VALUES ('ECONOMY'), ('LARGE'), ('SPY')) v(ticker)), h AS (SELECT ticker, count(*) AS c, max(date) AS last FROM type_bars GROUP BY 1)
SELECT ticker, coalesce(c, 0) AS bar_count, CASE WHEN w.ticker IS NULL THEN 'UNEXPECTED_TICKER' WHEN c IS NULL THEN 'MISSING_TICKER' WHEN c <> 501 THEN 'BAR_COUNT' END AS error
FROM h FULL JOIN w USING (ticker)""".replace("CASE WHEN w.ticker IS NULL", "CASE WHEN k IS NULL").replace("v(ticker))", "v(ticker))").replace(
    "w AS (SELECT * FROM", "w AS (SELECT *, 1 AS k FROM"))
def snapshot_identity(spark, d):
    return DOC.snapshot_violations(W.type_bars(spark, d), ("ECONOMY", "LARGE", "SPY"))


# --- sinks --------------------------------------------------------------------------
@query("append_daily_store", BARS_SQL)
def append_daily_store(spark, d):
    """Two overlapping appends and one repeat: the store holds every bar once."""
    path = scratch_path(spark, "daily")
    bars = W.supplier_bars(spark, d)
    ST.append_daily(bars.filter(F.col("date") <= F.lit(W.AS_OF)), path)
    ST.append_daily(bars.filter(F.col("date") > F.lit(W.BASE_AS_OF)), path)
    ST.append_daily(bars.filter(F.col("date") > F.lit(W.AS_OF)), path)
    return spark.read.parquet(path).select(*FIELDS)


@query("incremental_bar_ingest", BARS_SQL)
def incremental_bar_ingest(spark, d):
    """The same bars arriving as files in two deliveries that overlap, taken in as a stream."""
    arrivals, store, checkpoint = (scratch_path(spark, n) for n in ("arrivals", "store", "progress"))
    bars = W.supplier_bars(spark, d)
    bars.filter(F.col("date") <= F.lit(W.AS_OF)).write.option("compression", "gzip").json(os.path.join(arrivals, "first"))
    older_suffix(spark, os.path.join(arrivals, "first"))
    ingest_bars(spark, arrivals, store, checkpoint)
    bars.filter(F.col("date") > F.lit(W.BASE_AS_OF)).write.option("compression", "gzip").json(os.path.join(arrivals, "second"))
    ingest_bars(spark, arrivals, store, checkpoint)
    return spark.read.parquet(store).select(*FIELDS)


# Corrections reach the quarantined securities only; all others keep their bars.
cte("repaired_bars", """SELECT security_id, date, open, high, low, close, volume FROM composed SEMI JOIN quarantined USING (security_id)
UNION ALL SELECT security_id, date, open, high, low, close, volume FROM bars ANTI JOIN quarantined USING (security_id)""", "composed", "bars", "quarantined")
cte("quarantined", "SELECT security_id FROM securities WHERE listing_status LIKE 'QUARANTINED%'", "securities")


@query("indicators_incremental", with_ctes("repaired_bars", recursive=True, extra=f"""known_bars AS (SELECT * FROM repaired_bars),
back AS ({CTES["back"][1]}), {PR.WALK_SQL}""") + f"""
, slow AS (SELECT security_id, {day('max(date)', 'trade_date')}, count(*) AS bar_count, {r(PR._ma(20), 'ma_20', 6)}, {r(PR._ma(200), 'ma_200', 6)},
    {r(f'{PR.LAST} / nullif(max(close) FILTER (back = 253), 0) - 1', 'return_252d')},
    {r(f'CASE WHEN max(n) >= 120 THEN {PR.LAST} / min(low) FILTER (back <= 120) - 1 END', 'low_distance_120')},
    coalesce({PR._CONFIRMED}, false) AS bottom_confirmation FROM back GROUP BY 1)
SELECT slow.*, {r('line', 'macd')}, {r('CASE WHEN n >= 34 THEN g END', 'macd_signal')},
  {r('CASE WHEN n <= 14 THEN NULL WHEN loss = 0 THEN CASE WHEN gain <> 0 THEN 100 ELSE 50 END ELSE 100 - 100 / (1 + gain / loss) END', 'rsi14')}
FROM slow JOIN walk USING (security_id) WHERE i = n""")
def indicators_incremental(spark, d):
    """Indicators carried over three deliveries: the sealed history, the days since, and late corrections with the newest days."""
    series = INC.open_series(spark, scratch_path(spark, "series"))
    bars = W.supplier_bars(spark, d)
    INC.take_in(series, "history", bars.filter(F.col("date") <= F.lit(W.BASE_AS_OF)))
    INC.take_in(series, "days", bars.filter(F.col("date").between(F.lit(W.BASE_AS_OF + dt.timedelta(days=1)), F.lit(W.AS_OF))))
    quarantined = W.securities(spark, d).filter(F.col("listing_status").startswith("QUARANTINED")).select("security_id")
    corrected = CP.accepted_corrections(W.patch_rows(spark, d)).join(quarantined, "security_id", "left_semi").select(*FIELDS)
    newest = bars.filter(F.col("date") > F.lit(W.AS_OF)).select(*FIELDS)
    INC.take_in(series, "late", newest.join(corrected, ["security_id", "date"], "left_anti").unionByName(corrected))
    return INC.indicators(series).select("security_id", "trade_date", "bar_count", "ma_20", "ma_200", "return_252d", "low_distance_120",
                                         "bottom_confirmation", "macd", "macd_signal", "rsi14")


@query("partition_refresh", with_ctes("bars") + f"""
, v AS (SELECT *, month(date) = 2 AS gone, month(date) = 3 AS doubled FROM bars)
SELECT {day('date', 'date')}, count(*) AS rows, {r('sum(CASE WHEN doubled THEN 2 * close ELSE close END)', 'closes')},
  CASE WHEN date > DATE '{W.AS_OF}' OR any_value(doubled) THEN 'NEW' ELSE 'UNCHANGED' END AS state FROM v WHERE NOT gone GROUP BY date""")
def partition_refresh(spark, d):
    """Day folders that a store follows: days come, days are corrected, days go; the others are not read again."""
    root = scratch_path(spark, "day-files")
    mirror = REF.open_mirror(spark, scratch_path(spark, "mirror"))
    bars = stage(W.supplier_bars(spark, d).select(*FIELDS).withColumn("folder", F.col("date")))

    def put(rows):
        rows.hint("rebalance", "folder").write.partitionBy("folder").mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").json(root)
    put(bars.filter(F.col("date") <= F.lit(W.AS_OF)))
    REF.refresh(mirror, root, "first")
    march = bars.filter(F.month("date") == 3).withColumn("close", F.col("close") * 2)
    put(bars.filter((F.col("date") > F.lit(W.AS_OF)) & (F.month("date") != 3)).unionByName(march).filter(F.month("date") != 2))
    for name in files.names(spark, root):
        if name.startswith("folder=") and name[-5:-3] == "02":
            files.delete(spark, os.path.join(root, name))
    states = REF.refresh(mirror, root, "second")
    date = F.to_date(F.regexp_extract("path", DOC.DAY_FOLDER, 1))
    by_day = states.filter("state <> 'DELETED'").groupBy(date.alias("date")).agg(F.min("state").alias("state"))
    return mirror.read("bars").groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.sum("close").alias("closes")).join(by_day, "date")


RANK_TEXT = {"security_id": "text", "filter_pass": "bool", "rank_score": "double", '"rank"': "int"}


@query("indicators_stored", with_ctes("composed", recursive=True, extra=f"""known_bars AS (SELECT * FROM composed),
back AS ({CTES["back"][1]}), {PR.WALK_SQL}""") + f"""
, slow AS (SELECT security_id, {day('max(date)', 'trade_date')}, {r(PR._ma(50), 'ma_50', 6)}, {r(f'{PR.LAST} / nullif(max(close) FILTER (back = 21), 0) - 1', 'return_20d')},
    {r(f'CASE WHEN max(n) >= 252 THEN {PR.LAST} / min(low) FILTER (back <= 252) - 1 END', 'low_distance_252')} FROM back GROUP BY 1)
SELECT slow.*, {r('line', 'macd')}, {r('CASE WHEN n >= 34 THEN g END', 'macd_signal')} FROM slow JOIN walk USING (security_id) WHERE i = n""")
def indicators_stored(spark, d):
    """Series stored in buckets of the security, composed and measured where they lie."""
    return I.latest_indicators(stored_bars(spark, d)).select("security_id", "trade_date", "ma_50", "return_20d", "low_distance_252", "macd", "macd_signal")


def stored_bars(spark, d, buckets=8):
    path = scratch_path(spark, "series")
    for source, rows in ((CP.BASE, W.base_bars(spark, d)), (CP.DAILY, W.appended_bars(spark, d)), (CP.CORRECTION, W.patch_rows(spark, d))):
        append_buckets(CP.as_series(rows, source), path, buckets)
    return CP.compose_series(read_buckets(spark, path, buckets))


@query("rank_store", f"""SELECT part, count(*) AS rows, min("rank") AS least, max("rank") AS greatest, {D.digest(D.row_text(RANK_TEXT))} AS digest,
  true AS first_written, false AS second_written, 1 AS files FROM ({ORACLES["rank_score"]}) t GROUP BY part""")
def rank_store(spark, d):
    """The ranking written in parts of 250 ranks, twice: what each part holds, and in how many files."""
    from barloom.operators import ranking as R
    path = scratch_path(spark, "rank")
    scored = R.score(R.relative_strength(PR.snapshot(spark, d, W.AS_OF)), W.AS_OF)
    ranked = stage(R.rank(scored).select(*PR.RANK_COLUMNS))
    first, second = ST.write_rank(ranked, path, W.AS_OF), ST.write_rank(ranked, path, W.AS_OF)
    detail = ST.open_rank(spark, path, W.AS_OF).read("detail").withColumn("file", F.col("_metadata.file_path"))
    text = row_text(detail, ["security_id", "filter_pass", "rank_score", "rank"], digits=6)
    return detail.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min("rank").alias("least"), F.max("rank").alias("greatest"), digest(text).alias("digest"),
                                      F.lit(first).alias("first_written"), F.lit(second).alias("second_written"), F.count_distinct("file").alias("files"))


@query("daily_rank_store", ORACLES["daily_rank"])
def daily_rank_store(spark, d):
    """The whole daily ranking, written in parts and read back."""
    path = scratch_path(spark, "daily-rank")
    ST.write_rank(PR.daily_rank(spark, d), path, W.AS_OF)
    return ST.open_rank(spark, path, W.AS_OF).read("detail").select(*PR.RANK_COLUMNS)


RANKED_BARS = f"""ranked_bars AS (SELECT * FROM adjusted SEMI JOIN (SELECT security_id FROM securities WHERE coalesce(listing_status, 'ACTIVE') = 'ACTIVE') USING (security_id)
  WHERE date <= DATE '{W.AS_OF}'),
placed AS (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date) - 1 AS pos FROM ranked_bars),
anchors AS (SELECT * FROM all_anchors SEMI JOIN ranked_bars USING (security_id))"""
cte("all_anchors", CTES["anchors"][1], "trades")


def rank_run(spark, d):
    """The day's ranking with the excursions of its securities, written together."""
    path = scratch_path(spark, "daily-run")
    run = daily_rank_run(W.base_bars(spark, d), W.patch_rows(spark, d, W.AS_OF), W.appended_bars(spark, d, W.AS_OF), W.splits(spark, d),
                         W.securities(spark, d), RP.anchors(spark, d), W.AS_OF)
    ST.write_rank(run.ranked, path, W.AS_OF, run.excursions)
    return ST.open_rank(spark, path, W.AS_OF)


@query("daily_rank_excursions", with_ctes("adjusted", "securities", "all_anchors", extra=RANKED_BARS) + RP.EXCURSIONS_SQL)
def daily_rank_excursions(spark, d):
    return rank_run(spark, d).read("excursions").drop("entry_date", "entry_price", "as_of")


@query("daily_rank_run", f"""SELECT t.*, coalesce(anchors, 0) AS anchors, coalesce(measured, 0) AS measured FROM ({ORACLES["daily_rank"]}) t LEFT JOIN (
  SELECT security_id, count(*) AS anchors, count(*) FILTER (status IS NULL) AS measured FROM (
    {with_ctes("adjusted", "securities", "all_anchors", extra=RANKED_BARS)} {RP.EXCURSIONS_SQL}) x GROUP BY 1) c USING (security_id)""")
def daily_rank_all(spark, d):
    return rank_run(spark, d).read("detail").select(*PR.RANK_COLUMNS, "anchors", "measured")


@query("designated_archive", ORACLES["designated_list"])
def designated_archive(spark, d):
    """The designated lists, written as an archive with a header line and read back."""
    path, rows = scratch_path(spark, "designated"), designated_list(spark, d)
    ST.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


SNAPSHOT_TEXT = {"close": "double", "date": "date", "high": "double", "low": "double", "open": "double", "security_id": "text", "volume": "double"}


@query("snapshot_manifest", with_ctes("bars") + f"SELECT count(*) AS rows, {D.digest(D.row_text(SNAPSHOT_TEXT))} AS digest, true AS hashed, true AS several FROM bars")
def snapshot_manifest(spark, d):
    """A snapshot in files; the digests of the files merge to that of all bars."""
    path = scratch_path(spark, "snapshot")
    ST.write_snapshot(W.supplier_bars(spark, d), path, rows_per_file=2_000)
    return ST.snapshot_manifest(spark, path, digits=6).agg(
        F.sum("rows").alias("rows"), merged(F.col("digest")).alias("digest"), F.bool_and(F.length("sha256") == 64).alias("hashed"), (F.count(F.lit(1)) > 1).alias("several"))


@query("grid_csv", with_ctes("grid", recursive=True) + "SELECT side, stop_atr, target_r, CAST(max_hold AS BIGINT) AS max_hold, oos_n FROM grid")
def grid_csv(spark, d):
    path = scratch_path(spark, "grid")
    from barloom.operators import trades as T
    ST.write_csv(T.edge_grid(BT.simulated(spark, d)), path)
    schema = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return schema.select("side", "stop_atr", "target_r", "max_hold", "oos_n")


@query("corporate_action_store", with_ctes("splits") + f"SELECT DISTINCT security_id, {day('effective_date', 'effective_date')}, {r('factor', 'factor')} FROM splits")
def corporate_action_store(spark, d):
    path = scratch_path(spark, "actions")
    ST.append_actions(W.splits(spark, d).filter("factor < 3"), path)
    ST.append_actions(W.splits(spark, d), path)
    return spark.read.parquet(path).select("security_id", "effective_date", "factor")


@query("patch_store", with_ctes("decisions") + """
SELECT DISTINCT market, security_id, category, CAST(batch AS BIGINT) AS batch, CAST(trade_date AS VARCHAR) AS trade_date, split_part(verdict, '|', 1) AS result
FROM decisions WHERE split_part(verdict, '|', 1) IN ('RESOLVED', 'IDENTITY_FIXED')""")
def patch_store(spark, d):
    path = scratch_path(spark, "patches")
    decided = stage(RC.decided(spark, d))
    ST.append_patches(decided.filter("market = 'HK'"), path)
    ST.append_patches(decided, path)
    return spark.read.parquet(path).select("market", "security_id", "category", "batch", "trade_date", "result")


# --- pipelines ------------------------------------------------------------------------
@query("daily_append", with_ctes("securities", "appended_to_date", "refreshed", "sessions") + f"""
, act AS (SELECT * FROM securities WHERE coalesce(listing_status, 'ACTIVE') = 'ACTIVE'),
stored AS (SELECT * FROM appended_to_date WHERE volume > 45),
l AS (SELECT s.security_id, greatest(CASE WHEN security_id_origin IS DISTINCT FROM 'NEW_LISTING' THEN DATE '{W.BASE_AS_OF}' END, max(a.date)) AS last_date FROM act s LEFT JOIN stored a ON a.security_id = s.security_id GROUP BY s.security_id, security_id_origin),
taken AS (SELECT r.* FROM refreshed r JOIN l USING (security_id) WHERE r.date <= DATE '{W.AS_OF}' AND (last_date IS NULL OR (last_date < DATE '{W.AS_OF}' AND r.date > last_date))),
h AS (SELECT l.*, coalesce(last_date >= DATE '{W.AS_OF}', false) AS st, EXISTS (SELECT 1 FROM taken t WHERE t.security_id = l.security_id AND t.date = DATE '{W.AS_OF}') AS arr, EXISTS (SELECT 1 FROM taken t WHERE t.security_id = l.security_id) AS anyb FROM l),
c AS (SELECT count(*) AS active, count(*) FILTER (st OR arr) AS available, count(*) FILTER (NOT st AND NOT anyb) AS failed FROM h),
s AS (SELECT *, (active - available) / active >= 0.8 AS out_ FROM c)
SELECT '{W.AS_OF}' AS trade_date, active, available, CASE WHEN out_ THEN 'MARKET_WIDE_DATA_UNAVAILABLE' ELSE 'COMPLETE' END AS status,
  CASE WHEN out_ THEN 0 ELSE (SELECT count(*) FROM taken) END AS written, CASE WHEN out_ THEN 0 ELSE failed END AS repairs FROM s""")
def daily_append_run(spark, d):
    universe = W.securities(spark, d).withColumn("listing_date", F.lit(None).cast("date")).withColumn("listing_date_verified", F.lit(False))
    run = daily_append(universe, W.appended_bars(spark, d, W.AS_OF).filter("volume > 45"), RC.refreshed(spark, d), RC.sessions(spark, d), W.BASE_AS_OF, W.AS_OF)
    return run.receipt


# A store whose securities end at different sessions, and a source that knows nothing of every fifth security.
_LAGS, _DAY1 = 7, W.AS_OF - dt.timedelta(days=W.SESSION_DAYS)


def _runs_sql():
    """For each of the two runs: (trade_date, active, the last date held before it, the bars taken)."""
    out = ""
    for k, (run, before) in enumerate(((_DAY1, None), (W.AS_OF, "t1")), 1):
        held = "seeded" if before is None else "(SELECT security_id, date FROM seeded UNION ALL SELECT security_id, date FROM t1)"
        out += f"""
l{k} AS (SELECT s.security_id, greatest(CASE WHEN security_id_origin IS DISTINCT FROM 'NEW_LISTING' THEN DATE '{W.BASE_AS_OF}' END, max(h.date)) AS last
  FROM act s LEFT JOIN {held} h ON h.security_id = s.security_id GROUP BY s.security_id, security_id_origin),
t{k} AS (SELECT o.* FROM offered o JOIN l{k} USING (security_id) WHERE o.date <= DATE '{run}' AND (last IS NULL OR last < DATE '{run}' AND o.date > last)),
q{k} AS (SELECT security_id, 'FETCH_FAILED' AS category, DATE '{run}' AS trade_date FROM l{k} WHERE coalesce(last < DATE '{run}', true) AND security_id NOT IN (SELECT security_id FROM t{k})
  UNION ALL SELECT DISTINCT security_id, 'DATA_SUSPECT', DATE '{run}' FROM t{k} WHERE NOT {RC._GOOD}),
r{k} AS (SELECT DATE '{run}' AS trade_date, count(*) AS active, count(*) FILTER (coalesce(last >= DATE '{run}', false) OR security_id IN (SELECT security_id FROM t{k} WHERE date = DATE '{run}')) AS available,
  (SELECT count(*) FROM t{k}) AS written, (SELECT count(*) FROM q{k}) AS repairs FROM l{k}),"""
    return out


@query("daily_append_store", with_ctes("securities", "flawed", "sessions") + f""",
act AS (SELECT * FROM securities WHERE coalesce(listing_status, 'ACTIVE') = 'ACTIVE'),
seeded AS (SELECT f.* FROM flawed f JOIN securities s USING (security_id) WHERE date > DATE '{W.BASE_AS_OF}' AND date <= DATE '{W.AS_OF}' - CAST({W.SESSION_DAYS} * (s_suppkey % {_LAGS}) AS INTEGER)),
offered AS (SELECT f.* FROM flawed f JOIN securities s USING (security_id) WHERE date > DATE '{W.BASE_AS_OF}' AND s_suppkey % 5 <> 0),
past AS (SELECT security_id, 'FETCH_FAILED' AS category, s.date AS trade_date FROM securities, sessions s WHERE s_suppkey % {_LAGS} = 6
  AND s.idx BETWEEN (SELECT idx - 4 FROM sessions WHERE date = DATE '{W.AS_OF}') AND (SELECT idx - 2 FROM sessions WHERE date = DATE '{W.AS_OF}')),{_runs_sql()}
queue AS (SELECT * FROM past UNION ALL SELECT * FROM q1 UNION ALL SELECT * FROM q2),
review AS (SELECT security_id FROM queue WHERE category = 'FETCH_FAILED' GROUP BY 1 HAVING count(DISTINCT trade_date) = 5),
bars_ AS (SELECT * FROM seeded UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2),
rows_ AS (
SELECT 'bar' AS kind, security_id, date, NULL AS detail, close AS amount FROM bars_
UNION ALL SELECT 'queue', security_id, trade_date, category, NULL FROM queue
UNION ALL SELECT 'queue', security_id, DATE '{W.AS_OF}', 'SUSPECT_DELISTED', NULL FROM review
UNION ALL SELECT 'review', security_id, DATE '{W.AS_OF}', 'SUSPECT_DELISTED', NULL FROM review
UNION ALL SELECT 'history', s.security_id, DATE '{W.AS_OF}', CASE WHEN count(b.date) < 501 THEN 'SHORT_HISTORY' ELSE 'FULL_HISTORY' END, count(b.date) FROM securities s LEFT JOIN bars_ b ON b.security_id = s.security_id WHERE security_id_origin = 'NEW_LISTING' GROUP BY 2
UNION ALL SELECT 'receipt', NULL, trade_date, 'COMPLETE ' || active || ' ' || available || ' ' || written || ' ' || repairs, NULL FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2))
SELECT kind, security_id, {day('date', 'date')}, detail, {r('amount', 'amount')} FROM rows_""")
def daily_append_store(spark, d):
    """Two days run against a store, one of them stopped between its writes and run again, one run twice: all that is stored."""
    store = DA.open_daily(spark, scratch_path(spark, "daily-store"))
    universe = stage(W.securities(spark, d).withColumn("listing_date", F.lit(None).cast("date")).withColumn("listing_date_verified", F.lit(False)))
    bars = stage(RC.flawed(spark, d).withColumn("adjustment_as_of", F.col("date")).filter(F.col("date") > F.lit(W.BASE_AS_OF)).join(universe.select("security_id", "s_suppkey"), "security_id"))
    days = stage(RC.sessions(spark, d))
    lag = (F.col("s_suppkey") % _LAGS).cast("int")
    held = bars.filter(F.col("date") <= F.date_sub(F.lit(W.AS_OF), lag * W.SESSION_DAYS)).drop("s_suppkey").withColumn("trade_date", F.col("date"))
    place = days.filter(F.col("date") == F.lit(W.AS_OF)).agg(F.max("idx")).scalar()
    past = days.filter(F.col("idx").between(place - 4, place - 2)).select(F.col("date").alias("trade_date"))
    failed = universe.filter(lag == 6).select("market", "security_id", F.lit("FETCH_FAILED").alias("category"), F.lit("OPEN").alias("status")).join(F.broadcast(past))
    store.commit("before", {"bars": Write(held.select(*[c.split(" ")[0] for c in DA.BARS.split(", ")])), "queue": Write(failed.select("market", "security_id", "category", "trade_date", "status"))})
    offered = bars.filter("s_suppkey % 5 <> 0").drop("s_suppkey")
    DA.append_day(store, universe, offered, days, W.BASE_AS_OF, _DAY1)

    def stop(table):
        if table == "queue":
            raise InterruptedError("stopped between two writes")
    try:
        DA.append_day(store, universe, offered, days, W.BASE_AS_OF, W.AS_OF, after_write=stop)
    except InterruptedError:
        pass
    for _ in range(2):
        DA.append_day(store, universe, offered, days, W.BASE_AS_OF, W.AS_OF)
    none = F.lit(None).cast("string")
    date = F.col("trade_date").alias("date")
    rows = [store.read("bars").select(F.lit("bar").alias("kind"), "security_id", date, none.alias("detail"), F.col("close").alias("amount")),
            store.read("queue").select(F.lit("queue"), "security_id", date, "category", F.lit(None).cast("double")),
            store.read("reviews").select(F.lit("review"), "security_id", date, "review_status", F.lit(None).cast("double")),
            store.read("history").select(F.lit("history"), "security_id", date, "history_status", F.col("bar_count").cast("double")),
            store.read("receipts").select(F.lit("receipt"), none, date, F.concat_ws(" ", "status", "active", "available", "written", "repairs"), F.lit(None).cast("double"))]
    return functools.reduce(lambda a, b: a.union(b), rows)


@query("earnings_daily", with_ctes("reports", "active", "bars", "sessions") + f"""
, hist AS (SELECT security_id, report_date FROM reports WHERE total < 60000),
due_dates AS (SELECT security_id, list_sort(list(DISTINCT report_date)) AS ds FROM reports WHERE total > 450000 GROUP BY 1),
old AS (SELECT o.security_id, report_date, ds IS NOT NULL AND NOT list_contains(ds, report_date) AS revised FROM reports o LEFT JOIN due_dates USING (security_id) WHERE status = 'O'),
kept AS (SELECT *, true AS k FROM old WHERE report_date < DATE '{RP.TODAY}' OR revised),
merged AS (SELECT h.security_id || ':' || strftime(h.report_date, '%Y-%m-%d') AS event_id, h.*, upper(replace(a.ticker, '.', '')) AS key FROM (
    SELECT security_id, report_date, CASE WHEN revised THEN 'REVISED' END AS event_status, coalesce(was, report_date < DATE '{RP.TODAY}') AS pending
    FROM (SELECT *, true AS was FROM hist) FULL JOIN kept USING (security_id, report_date)) h LEFT JOIN active a USING (security_id)),
provider AS (SELECT CAST(o_orderdate AS DATE) AS report_date, 'N' || o_custkey AS key, arg_max(coalesce({RP._EPS_VALUE_SQL}, -1e99), o_orderkey) AS v FROM orders GROUP BY 1, 2),
events AS (SELECT m.event_id, m.security_id, m.report_date, 'UNKNOWN' AS session, m.event_status, NULL::VARCHAR AS reaction_status,
    CASE WHEN m.report_date < DATE '{RP.TODAY}' AND pending AND v > -1e90 THEN 'AVAILABLE' ELSE 'EPS_ACTUAL_UNAVAILABLE' END AS eps_status
  FROM merged m LEFT JOIN provider p ON p.report_date = m.report_date AND p.key = m.key)
{RP.reaction_ctes("events")},
settled AS (SELECT e.event_id, e.event_status, e.eps_status, s.status AS reaction_status FROM events e LEFT JOIN (SELECT event_id, {RP.REACTION_STATUS} AS status FROM y) s USING (event_id))
SELECT reaction_status, event_status, eps_status, count(*) AS events FROM settled GROUP BY 1, 2, 3
UNION ALL SELECT 'NEW_INACTIVE_EVENT', NULL, NULL, count(*) FROM events e ANTI JOIN active USING (security_id) WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.security_id = e.security_id AND h.report_date = e.report_date) HAVING count(*) > 0""")
def earnings_daily(spark, d):
    read = RP.reports(spark, d).filter("status = 'O' OR total < 60000 OR total > 450000")  # old calendar, history, new calendar
    rows = stage(read.select("security_id", "report_date", "status", "total"), drop_shuffles=True).withColumn("session", F.lit("UNKNOWN"))
    keys = ["security_id", "report_date"]
    history = rows.filter("total < 60000").select(
        F.concat_ws(":", "security_id", F.col("report_date").cast("string")).alias("event_id"), *keys, "session",
        F.lit(None).cast("string").alias("event_status"), F.array().cast("array<struct<old_date:date,new_date:date>>").alias("revisions"),
        F.lit(None).cast("double").alias("eps_actual"), F.lit(None).cast("double").alias("eps_surprise_pct"),
        F.lit("EPS_ACTUAL_UNAVAILABLE").alias("eps_status"), F.lit(True).alias("eps_refresh_pending"), F.lit(None).cast("string").alias("reaction_status"))
    provider = W.table(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("report_date"), F.concat(F.lit("N"), F.col("o_custkey")).alias("symbol"), RP._eps_text().alias("eps"),
        F.lit(None).cast("string").alias("surprise"), F.col("o_orderkey").alias("sequence"))
    done, violations = earnings_plan(rows.filter("status = 'O'").select(*keys, "session"), rows.filter("total > 450000").select(*keys, "session"),
                                     history, provider, W.supplier_bars(spark, d), stage(RC.sessions(spark, d)), RP.active(spark, d), RP.TODAY)
    counted = done.groupBy("reaction_status", "event_status", "eps_status").agg(F.count(F.lit(1)).alias("events"))
    broken = violations.groupBy("error").agg(F.count(F.lit(1)).alias("events")).select(
        F.col("error").alias("reaction_status"), F.lit(None).cast("string").alias("event_status"), F.lit(None).cast("string").alias("eps_status"), "events")
    return counted.unionByName(broken)


@query("monthly_snapshot", with_ctes("adjusted", "securities") + f"""
SELECT security_id, {day('date', 'date')}, {BAR_COLUMNS} FROM adjusted
SEMI JOIN (SELECT security_id FROM securities WHERE listing_status = 'ACTIVE') USING (security_id) WHERE date <= DATE '2001-01-01'""")
def monthly_snapshot(spark, d):
    """Composed and adjusted bars of the active candidates, cut, frozen as files and read back."""
    from barloom.plans.us_monthly import monthly_bars
    path = scratch_path(spark, "month")
    ST.write_snapshot(monthly_bars(W.base_bars(spark, d), W.patch_rows(spark, d), W.appended_bars(spark, d), W.splits(spark, d),
                                   W.securities(spark, d), dt.date(2001, 1, 1)), path)
    return spark.read.parquet(path).select(*FIELDS)


def us_month(spark, d):
    index = W.type_bars(spark, d).filter(F.col("ticker").isin(*W.INDEX_TYPES))
    return us_plan(index, W.daily_bars(spark, d), BT.LEAD_TICKER)


# The month's directions: the candidates that pass, pruned in two rounds and replayed; the verdict of the stock baseline.
US_MONTH = BT.CANDIDATES + f""",
active AS (SELECT c.side, c.ticker, c.signal, c.h FROM chosen c JOIN candidates o ON o.ticker = c.ticker AND o.signal = c.signal AND o.h = c.h AND o.side = c.side AND o.segment = 'FINAL_OOS'
  WHERE o.wr >= 0.55 AND o.ci_low > 0),{BT.replay_round(1, "active")},{BT.replay_round(2, "left1")},{BT.replay_round(3, "left2")},
{BT.BASELINE_SQL},
us_pointer AS (SELECT b.side, coalesce(l.ticker || '|' || l.signal || '|' || l.h, '无合格信号') AS direction_signal,
  (SELECT coalesce(count(e.side) / nullif(count(*), 0), 0.0::DOUBLE) FROM oos_dates d LEFT JOIN r3_emitted e ON e.date = d.date) AS coverage, b.verdict AS vertical_baseline
  FROM (SELECT side, any_value(verdict) AS verdict FROM baseline GROUP BY 1) b LEFT JOIN left2 l ON l.side = b.side)
"""
US_MONTH_NEEDS = ("directed", "rates", "oos_dates", "drifted")


@query("us_monthly", with_ctes(*US_MONTH_NEEDS, recursive=True, extra=US_MONTH) + f"SELECT side, direction_signal, {r('coverage', 'coverage')}, vertical_baseline FROM us_pointer")
def us_monthly(spark, d):
    return us_pointer(us_month(spark, d))


def hk_month(spark, d):
    bars = BT.grid_bars(spark, d)
    # Designated: every second group of suppliers.
    group = F.floor(F.col("s_suppkey") / BT.GROUPED)
    designated = W.table(spark, d, "supplier").filter(group % 2 == 0).select(W.security_id(group, "HK").alias("security_id")).distinct()
    return hk_plan(bars, W.calendar(spark, d), designated)


cte("taken_hk", "SELECT * FROM taken WHERE side = 'LONG' OR CAST(substr(security_id, 4) AS BIGINT) % 2 = 1", "taken")
for _name in ("grid", "gated", "stable"):
    _needs, _text = CTES[_name]
    cte(_name + "_hk", _text.replace("FROM taken", "FROM taken_hk").replace("FROM grid)", "FROM grid_hk)").replace("FROM gated", "FROM gated_hk"),
        *[{"taken": "taken_hk", "grid": "grid_hk", "gated": "gated_hk"}.get(n, n) for n in _needs])


@query("hk_monthly", with_ctes("stable_hk", "full_bars", recursive=True) + f"""
SELECT side, count(*) FILTER (s.stability = 'PASS') AS pass_count, count(*) AS parameter_points, CASE WHEN count(*) FILTER (s.stability = 'PASS') > 0 THEN 'CERTIFIED' ELSE 'EDGE_NOT_CERTIFIED' END AS status,
  any_value(b.stop_atr) AS stop_atr, any_value(b.target_r) AS target_r, any_value(b.max_hold) AS max_hold, any_value(b.oos_n) AS n, {r('any_value(b.oos_exp)', 'expectancy_r')}
FROM (SELECT side, stability FROM stable_hk) s JOIN (SELECT * FROM stable_hk QUALIFY row_number() OVER (PARTITION BY side ORDER BY coalesce(oos_exp, -1e300) DESC, stop_atr, target_r, max_hold) = 1) b USING (side) GROUP BY side""")
def hk_monthly(spark, d):
    return hk_month(spark, d).summary.select("side", "pass_count", "parameter_points", "status", "stop_atr", "target_r", "max_hold", "n", "expectancy_r")


_MONTH = f"{W.AS_OF:%Y-%m}"


@query("combined_monthly", with_ctes(*US_MONTH_NEEDS, "stable_hk", "full_bars", recursive=True, extra=US_MONTH) + f"""
SELECT {", ".join(f"max({c}) FILTER (side = '{s}') AS {s.lower()}_{c}" for s in ("LONG", "SHORT") for c in ("direction_signal", "vertical_baseline"))},
  {", ".join(f"(SELECT CASE WHEN count(*) FILTER (stability = 'PASS') > 0 THEN 'CERTIFIED' ELSE 'EDGE_NOT_CERTIFIED' END FROM stable_hk WHERE side = '{s}') AS hk_{s.lower()}_edge" for s in ("LONG", "SHORT"))},
  'MONTH_{_MONTH}' AS month_file, 'HK_MONTH_{_MONTH}' AS hk_month_file, 1 AS version FROM us_pointer""")
def combined_monthly(spark, d):
    return combined_pointer(us_pointer(us_month(spark, d)), hk_month(spark, d).summary, W.AS_OF, W.AS_OF)
