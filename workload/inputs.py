"""Market tables derived by Spark from the given tables, with the same rules as SQL.

A supplier is a security and a line item is a trade in it: price is extended price per
unit, volume is quantity. Sessions are four days long so that many securities share one.
Part types give a few index-like series. Corrections, splits, reports, listings and
queue entries come from attributes of the same rows. Every rule runs on whole tables.
"""
from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.sources.trades import bars_from_trades
from workload.registry import cte

EPOCH = dt.date(1995, 1, 1)
SESSION_DAYS = 4
BASE_AS_OF = EPOCH + dt.timedelta(days=4 * 500)
AS_OF = EPOCH + dt.timedelta(days=4 * 600)
INDEX_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def security_id(key: Column, market: str = "US") -> Column:
    number = (key.cast("bigint") + 1).cast("string")
    return F.concat(F.lit(market + "-"), F.lpad(number, F.greatest(F.length(number), F.lit(6)), F.lit("0")))


def session_of(day: Column) -> Column:
    days = F.datediff(day.cast("date"), F.lit(EPOCH))
    return F.date_add(F.lit(EPOCH), (F.floor(days / SESSION_DAYS) * SESSION_DAYS).cast("int"))


def _midnight(day: dt.date) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def trades(spark: SparkSession, sf_dir: str, after: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Line items as trades. `after` and `until` are sessions; they become bounds on the
    ship date, which the Parquet scan can use."""
    lines = table(spark, sf_dir, "lineitem")
    if after:
        lines = lines.filter(F.col("l_shipdate") >= _midnight(after + dt.timedelta(days=SESSION_DAYS)))
    if until:
        lines = lines.filter(F.col("l_shipdate") < _midnight(until + dt.timedelta(days=SESSION_DAYS)))
    return lines.select(
        security_id(F.col("l_suppkey")).alias("security_id"), F.col("l_suppkey").alias("supplier"), "l_partkey", "l_orderkey",
        F.col("l_shipdate").cast("date").alias("day"),
        session_of(F.col("l_shipdate")).alias("date"),
        F.col("l_linenumber").alias("sequence"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        "l_returnflag", "l_linestatus", "l_discount", "l_tax")


cte("trades", """
SELECT printf('US-%06d', l_suppkey + 1) AS security_id, l_partkey, l_orderkey,
  CAST(l_shipdate AS DATE) AS day,
  DATE '1995-01-01' + CAST(4 * (date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) // 4) AS INTEGER) AS date,
  l_linenumber AS sequence, l_extendedprice / l_quantity AS price,
  l_quantity AS quantity, l_returnflag, l_linestatus, l_discount, l_tax
FROM lineitem""")

BAR_SQL = """min({'s': sequence, 'p': price}).p AS open, max(price) AS high, min(price) AS low,
  max({'s': sequence, 'p': price}).p AS close, sum(quantity) AS volume"""


def supplier_bars(spark: SparkSession, sf_dir: str, after=None, until=None) -> DataFrame:
    """Security by session, the whole history or the sessions in (after, until]."""
    return by_supplier(trades(spark, sf_dir, after, until))


def by_supplier(rows: DataFrame) -> DataFrame:
    """Bars grouped by the supplier number; the identifier text is made per bar, not per trade."""
    return bars_from_trades(rows, ["supplier", "date"]).select(
        security_id(F.col("supplier")).alias("security_id"), "date", "open", "high", "low", "close", "volume")


def known_bars(spark: SparkSession, sf_dir: str, until: dt.date | None = None) -> DataFrame:
    """All bars, or those up to the date of a ranking."""
    return supplier_bars(spark, sf_dir, until=until)


cte("bars", f"SELECT security_id, date, {BAR_SQL} FROM trades GROUP BY 1, 2", "trades")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Security by calendar day."""
    return by_supplier(trades(spark, sf_dir).withColumn("date", F.col("day")))


cte("daily_bars", f"SELECT security_id, day AS date, {BAR_SQL} FROM trades GROUP BY 1, 2", "trades")


def type_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part type by session: a handful of complete, index-like series (ticker, date)."""
    types = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("ticker"))
    rows = trades(spark, sf_dir).join(types, F.col("l_partkey") == F.col("p_partkey"))
    return bars_from_trades(rows, ["ticker", "date"])


cte("type_bars", f"""SELECT p_type AS ticker, date, {BAR_SQL}
FROM trades JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""", "trades")


def base_bars(spark, sf_dir) -> DataFrame:
    return supplier_bars(spark, sf_dir, until=BASE_AS_OF).withColumn("adjustment_as_of", F.lit(BASE_AS_OF))


def appended_bars(spark, sf_dir, until: dt.date | None = None) -> DataFrame:
    return supplier_bars(spark, sf_dir, BASE_AS_OF, until).withColumn("adjustment_as_of", F.col("date"))


cte("base", f"SELECT *, DATE '{BASE_AS_OF}' AS adjustment_as_of FROM bars WHERE date <= DATE '{BASE_AS_OF}'", "bars")
cte("appended", f"SELECT *, date AS adjustment_as_of FROM bars WHERE date > DATE '{BASE_AS_OF}'", "bars")
cte("appended_to_date", f"SELECT * FROM appended WHERE date <= DATE '{AS_OF}'", "appended")


def patch_rows(spark, sf_dir, until: dt.date | None = None) -> DataFrame:
    """Corrections: returned goods, one correction per line status and line number."""
    returned = trades(spark, sf_dir, until=until).filter(F.col("l_returnflag") == "R")
    keys = ["security_id", "date", "l_linestatus", "sequence"]
    marks = returned.groupBy(*keys).agg(
        (F.max("l_discount") >= 0.03).alias("accepted"),
        F.when(F.max("l_tax") >= 0.04, "RESOLVED").when(F.max("l_tax") >= 0.02, "IDENTITY_FIXED")
        .otherwise("UNRESOLVED").alias("result"),
        F.max("price").alias("top"), F.min("price").alias("bottom"), F.sum("quantity").alias("volume"))
    return marks.select(
        "security_id", "date", F.col("bottom").alias("open"), F.col("top").alias("high"), F.col("bottom").alias("low"), F.col("top").alias("close"), "volume",
        F.col("date").alias("adjustment_as_of"), "accepted", "result",
        F.col("l_linestatus").alias("path"), F.col("sequence").alias("item"), F.lit(0).alias("position"))


cte("patch_rows", """
SELECT security_id, date, min(price) AS open, max(price) AS high, min(price) AS low,
  max(price) AS close, sum(quantity) AS volume, date AS adjustment_as_of,
  max(l_discount) >= 0.03 AS accepted,
  CASE WHEN max(l_tax) >= 0.04 THEN 'RESOLVED' WHEN max(l_tax) >= 0.02 THEN 'IDENTITY_FIXED'
       ELSE 'UNRESOLVED' END AS result,
  l_linestatus AS path, sequence AS item, 0 AS position
FROM trades WHERE l_returnflag = 'R'
GROUP BY security_id, date, l_linestatus, sequence""", "trades")


def splits(spark, sf_dir) -> DataFrame:
    """Corporate actions: full lots at the top tax rate; the factor follows the line number."""
    return (trades(spark, sf_dir).filter((F.col("quantity") == 50) & (F.col("l_tax") >= 0.08))
            .select("security_id", F.col("date").alias("effective_date"),
                    (F.col("sequence") / 2.0 + 1.0).alias("factor"), F.col("security_id").alias("ticker")))


cte("splits", """SELECT security_id, date AS effective_date, sequence / 2.0::DOUBLE + 1.0::DOUBLE AS factor,
  security_id AS ticker FROM trades WHERE quantity = 50 AND l_tax >= 0.08""", "trades")

cte("composed", """
SELECT security_id, date, open, high, low, close, volume, adjustment_as_of, source FROM (
  SELECT *, row_number() OVER (PARTITION BY security_id, date ORDER BY source DESC, path DESC, item DESC, position DESC) AS pick
  FROM (
    SELECT security_id, date, open, high, low, close, volume, adjustment_as_of, 0 AS source, '' AS path, 0 AS item, 0 AS position FROM base
    UNION ALL SELECT security_id, date, open, high, low, close, volume, adjustment_as_of, 1, '', 0, 0 FROM appended
    UNION ALL SELECT security_id, date, open, high, low, close, volume, adjustment_as_of, 2, path, item, position
      FROM patch_rows WHERE accepted AND result IN ('RESOLVED', 'IDENTITY_FIXED')) u) v
WHERE pick = 1""", "base", "appended", "patch_rows")

cte("adjusted", """
SELECT c.security_id, c.date, c.open / s.f AS open, c.high / s.f AS high, c.low / s.f AS low,
  c.close / s.f AS close, c.volume * s.f AS volume, c.adjustment_as_of
FROM composed c JOIN (
  SELECT c.security_id, c.date, coalesce(product(e.factor), 1.0::DOUBLE) AS f
  FROM composed c LEFT JOIN (SELECT DISTINCT security_id, effective_date, factor FROM splits) e
    ON e.security_id = c.security_id AND c.date < e.effective_date AND c.adjustment_as_of < e.effective_date
  GROUP BY 1, 2) s ON s.security_id = c.security_id AND s.date = c.date""", "composed", "splits")


def securities(spark, sf_dir) -> DataFrame:
    """Universe: suppliers with their nation and region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = (table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
              .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return joined.select(
        security_id(F.col("s_suppkey")).alias("security_id"), "s_suppkey",
        F.when(F.col("r_name").isin("ASIA"), "HK").otherwise("US").alias("market"),
        F.concat(F.lit("N"), F.col("s_nationkey"), F.lit("."), F.floor(F.col("s_suppkey") / 4).cast("bigint")).alias("ticker"),
        F.when(F.col("r_name") == "AFRICA", "NASDAQ").when(F.col("r_name") == "AMERICA", "NYSE")
        .when(F.col("r_name") == "EUROPE", "NYSE American").when(F.col("r_name") == "ASIA", "HKEX")
        .otherwise("nyse-arca").alias("exchange"),
        F.concat(F.col("n_name"), F.lit(" "), _name_tail(F.col("s_nationkey"))).alias("name"),
        F.when(F.col("s_acctbal") < 0, "QUARANTINED_DATA_GAP").when(F.col("s_acctbal") < 500, "QUARANTINED_IDENTITY")
        .when(F.col("s_acctbal") < 1500, None).otherwise("ACTIVE").alias("listing_status"),
        F.when(F.col("s_acctbal") > 9000, "NEW_LISTING").alias("security_id_origin"),
        F.concat(F.lit("IS"), F.format_string("%08d", F.col("s_suppkey"))).alias("isin"),
        "s_acctbal", "s_nationkey")


# Plain words for security names, picked by nation: common shares and every excluded kind.
NAME_TAILS = ("Common Stock", "Acquisition Corp Class A", "Preferred Stock", "SPAC Holdings",
              "Warrants", "Acquisition Ltd Ordinary Shares", "Holdings Ltd", "Unit Trust",
              "Income Fund", "Acquisition Rights Common Stock", "Reit Plc", "United Parts",
              "Senior Notes", "Notes Due 2030", "Acquisition Group", "Group Pref")


def _name_tail(nation: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in NAME_TAILS]),
                        (F.pmod(nation, F.lit(len(NAME_TAILS))) + 1).cast("int"))


_TAILS_SQL = "[" + ", ".join(f"'{t}'" for t in NAME_TAILS) + "]"
cte("securities", f"""
SELECT printf('US-%06d', s_suppkey + 1) AS security_id, s_suppkey,
  CASE WHEN r_name = 'ASIA' THEN 'HK' ELSE 'US' END AS market,
  'N' || s_nationkey || '.' || (s_suppkey // 4) AS ticker,
  CASE r_name WHEN 'AFRICA' THEN 'NASDAQ' WHEN 'AMERICA' THEN 'NYSE' WHEN 'EUROPE' THEN 'NYSE American'
    WHEN 'ASIA' THEN 'HKEX' ELSE 'nyse-arca' END AS exchange,
  n_name || ' ' || ({_TAILS_SQL})[CAST(s_nationkey % {len(NAME_TAILS)} + 1 AS INTEGER)] AS name,
  CASE WHEN s_acctbal < 0 THEN 'QUARANTINED_DATA_GAP' WHEN s_acctbal < 500 THEN 'QUARANTINED_IDENTITY'
    WHEN s_acctbal < 1500 THEN NULL ELSE 'ACTIVE' END AS listing_status,
  CASE WHEN s_acctbal > 9000 THEN 'NEW_LISTING' END AS security_id_origin,
  'IS' || printf('%08d', s_suppkey) AS isin, s_acctbal, s_nationkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")


def calendar(spark, sf_dir) -> DataFrame:
    """Open sessions: every session any security traded in."""
    return trades(spark, sf_dir).select("date").distinct()


cte("calendar", "SELECT DISTINCT date FROM trades", "trades")
cte("sessions", "SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx FROM calendar", "calendar")
