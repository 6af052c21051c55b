"""One daily append: what is missing, what arrived, what is queued, and the receipt."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.operators import quality as Q
from barloom.operators.universe import active_securities
from barloom.session import stage
from barloom.sinks.ledger import Ledger, Write
from barloom.sinks.stores import BAR_CONTENT, conflicts


@dataclass
class DailyAppend:
    new_bars: DataFrame
    queue_items: DataFrame
    receipt: DataFrame
    violations: DataFrame


def daily_append(securities: DataFrame, daily: DataFrame, fetched: DataFrame, sessions: DataFrame,
                 base_as_of, as_of) -> DailyAppend:
    """`fetched` are bars from the source; only sessions a security still needs are taken.

    Equal copies of a bar are merged; a security and date that come with different prices
    are violations and nothing of them is taken. A source-wide outage (80 % of the active securities without a bar) yields no bars and
    no queue items.
    """
    day = F.lit(as_of).cast("date")
    last = Q.last_stored(securities, daily, base_as_of)
    needed = Q.catchup_targets(securities, last, sessions, as_of)
    offered = fetched.join(needed, ["security_id", "date"], "left_semi")
    key = ["security_id", "date"]
    wrong = conflicts(offered, None, key, [c for c in BAR_CONTENT if c in offered.columns])
    taken = offered.join(wrong.select(*key), key, "left_anti").dropDuplicates(key)
    active = active_securities(securities).select("security_id")
    have = (active.join(last, "security_id").withColumn("stored", F.coalesce(F.col("last_date") >= day, F.lit(False)))
            .join(taken.filter(F.col("date") == day).select("security_id", F.lit(True).alias("arrived")), "security_id", "left")
            .join(taken.select("security_id").distinct().withColumn("any_bar", F.lit(True)), "security_id", "left"))
    counts = have.agg(F.count(F.lit(1)).alias("active"),
                      F.count(F.when(F.col("stored") | F.col("arrived"), 1)).alias("available"))
    outage = (F.col("active") - F.col("available")) / F.nullif(F.col("active"), F.lit(0)) >= K.OUTAGE_SHARE
    receipt = counts.select(day.alias("trade_date"), "active", "available", F.when(
        outage, "MARKET_WIDE_DATA_UNAVAILABLE").otherwise("COMPLETE").alias("status"))
    open_market = F.broadcast(receipt.filter("status = 'COMPLETE'").select("trade_date"))
    new = taken.withColumn("trade_date", day).join(open_market, "trade_date", "left_semi").drop("trade_date")
    failed = have.filter(~F.col("stored") & F.col("any_bar").isNull()).select(
        "security_id", F.lit("FETCH_FAILED").alias("category"), day.alias("trade_date"), F.lit("OPEN").alias("status"))
    suspect = new.filter(~Q.is_structural()).select("security_id").distinct().select(
        "security_id", F.lit("DATA_SUSPECT").alias("category"), day.alias("trade_date"), F.lit("OPEN").alias("status"))
    queue = failed.unionByName(suspect).join(open_market, "trade_date", "left_semi")
    written = new.agg(F.count(F.lit(1)).alias("written")).withColumn("trade_date", day)
    repairs = queue.agg(F.count(F.lit(1)).alias("repairs")).withColumn("trade_date", day)
    return DailyAppend(new, queue, receipt.join(written, "trade_date").join(repairs, "trade_date"), wrong)


TABLES = {"bars": "trade_date", "queue": "trade_date", "reviews": "trade_date", "history": "trade_date", "receipts": "trade_date", "violations": "trade_date"}
BARS = "security_id string, date date, open double, high double, low double, close double, volume double, adjustment_as_of date, trade_date date"
QUEUE = "market string, security_id string, category string, trade_date date, status string"
REVIEWS = "security_id string, review_status string, trade_date date"


def open_daily(spark: SparkSession, root: str) -> Ledger:
    """The daily store: bars by their own date; queue, reviews, receipts and violations by the day of the run that wrote
    them; the newest history states of new listings. A run's writes become visible together."""
    return Ledger(spark, root, TABLES)


def _held(store: Ledger, table: str, schema: str) -> DataFrame:
    rows = store.read(table)
    return store.spark.createDataFrame([], schema) if rows is None else rows


def append_day(store: Ledger, securities: DataFrame, fetched: DataFrame, sessions: DataFrame, base_as_of, as_of, after_write=lambda table: None) -> bool:
    """Run one day against the store and commit all that it brings; False where the day was committed before.

    Bars go to their own dates, new queue items (a key once) and, after an open failure on each of the last five sessions,
    a review of the security and its queue item; history states of new listings follow the bars now held. A source-wide
    outage leaves its receipt only and does not close the day: a later run does. `securities`: also market.
    """
    day, spark = F.lit(as_of).cast("date"), store.spark
    if str(as_of) in store.batches():
        return False
    known = _held(store, "bars", BARS)
    run = daily_append(securities, known.drop("trade_date"), fetched, sessions, base_as_of, as_of)
    receipt = stage(run.receipt)
    wrong = run.violations.select("security_id", "date", "error", day.alias("trade_date"))
    if receipt.filter("status = 'COMPLETE'").isEmpty():
        return store.commit(f"{as_of} outage {len(store.batches())}", {"receipts": Write(receipt, replace=True)})
    bars = stage(run.new_bars.select(*[c.split(" ")[0] for c in BARS.split(", ")[:-1]], F.col("date").alias("trade_date")))
    queue = _held(store, "queue", QUEUE)
    names = [c.split(" ")[0] for c in QUEUE.split(", ")]
    market = securities.select("security_id", "market")
    items = stage(Q.queue_append(queue, run.queue_items.join(market, "security_id").select(*names)))
    failing = Q.five_day_failures(queue.select(*names).unionByName(items), sessions, as_of)
    reviewed = stage(failing.join(_held(store, "reviews", REVIEWS), "security_id", "left_anti").withColumn("trade_date", day))
    marked = reviewed.join(market, "security_id").select("market", "security_id", F.col("review_status").alias("category"), "trade_date", F.lit("OPEN").alias("status"))
    history = Q.new_listing_history(securities, known.select("security_id", "date").unionByName(bars.select("security_id", "date")))
    return store.commit(str(as_of), {
        "bars": Write(bars), "queue": Write(items.unionByName(Q.queue_append(queue, marked))), "reviews": Write(reviewed),
        "history": Write(history.withColumn("trade_date", day), emptied=tuple(store.values("history"))), "receipts": Write(receipt, replace=True),
        "violations": Write(wrong)}, after_write)
