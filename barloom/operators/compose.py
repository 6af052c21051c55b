"""One clean, split-adjusted bar per (security, date) out of three kinds of input."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.checks import PRICES

FIELDS = PRICES + ("volume", "adjustment_as_of")
KEY = ("security_id", "date")


def effective_bars(stored: DataFrame) -> DataFrame:
    """Bars keyed by their trade date where one is given, else by their date."""
    if "trade_date" in stored.columns:
        stored = stored.withColumn("date", F.coalesce("trade_date", "date")).drop("trade_date")
    return stored.select(*KEY, *FIELDS)


def accepted_corrections(patch_rows: DataFrame) -> DataFrame:
    """The correction that counts for each key: accepted, and the last one in order.

    Input rows carry `accepted`, `result` and the order columns path, item, position.
    Reducing to one row per key first keeps a much-corrected key from growing the merge.
    """
    usable = patch_rows.filter(F.col("accepted") & F.col("result").isin("RESOLVED", "IDENTITY_FIXED"))
    payload = F.struct(*FIELDS)
    order = F.struct("path", "item", "position")
    return (usable.groupBy(*KEY).agg(F.max_by(payload, order).alias("bar"))
            .select(*KEY, "bar.*"))


def base_daily_overlap(base: DataFrame, daily: DataFrame) -> DataFrame:
    """Violations: keys stored in the sealed base and appended again."""
    return (base.select(*KEY).join(daily.select(*KEY), list(KEY), "left_semi").distinct()
            .withColumn("error", F.lit("BASE_DAILY_OVERLAP")))


def compose_bars(base: DataFrame, patch_rows: DataFrame, daily: DataFrame,
                 wanted: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Sealed base, overridden by accepted corrections; daily bars fill uncorrected keys.

    `wanted` (security_id) restricts all inputs before anything is shuffled. The union is
    placed by security once; the merge, and every later step keyed by security, reuse that
    placement. An overlap of base and daily stops the job; only where `strict` is off the
    daily bar is preferred.
    """
    parts = [(base, 0), (daily, 1), (accepted_corrections(patch_rows), 2)]
    if wanted is not None:
        ids = wanted.select("security_id").distinct()
        parts = [(p.join(ids, "security_id", "left_semi"), rank) for p, rank in parts]
    tagged = [p.select(*KEY, *FIELDS, F.lit(rank).alias("source")) for p, rank in parts]
    merged = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).repartition("security_id")
    per_key = Window.partitionBy(*KEY)
    picked = merged.withColumn("pick", F.row_number().over(per_key.orderBy(F.desc("source"))))
    if strict:
        both = F.bool_or(F.col("source") == 0).over(per_key) & F.bool_or(F.col("source") == 1).over(per_key)
        picked = picked.withColumn("clash", both).filter(
            F.when(F.col("clash"), F.raise_error(F.concat_ws(
                ":", F.lit("BASE_DAILY_OVERLAP"), F.col("security_id"), F.col("date"))))
            .otherwise(F.lit(True)).cast("boolean"))
    return picked.filter("pick = 1").select(*KEY, *FIELDS, "source")


BASE, DAILY, CORRECTION = range(3)
SERIES = KEY + FIELDS + ("source", "path", "item", "position")


def as_series(rows: DataFrame, source: int) -> DataFrame:
    """Rows of one kind of input in the form that stored series share; of corrections the accepted ones."""
    if source == CORRECTION:
        rows = rows.filter(F.col("accepted") & F.col("result").isin("RESOLVED", "IDENTITY_FIXED"))
        order = ["path", "item", "position"]
    else:
        order = [F.lit("").alias("path"), F.lit(0).alias("item"), F.lit(0).alias("position")]
    return rows.select(*KEY, *FIELDS, F.lit(source).alias("source"), *order)


def compose_series(series: DataFrame, wanted: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """What `compose_bars` gives, from one store of all kinds of input (`as_series`) in buckets of the security.

    One window picks the row of each key; neither it nor what is later keyed by security moves a row. `wanted` should be
    small enough to go to all tasks.
    """
    rows = series
    if wanted is not None:
        rows = rows.join(wanted.select("security_id").distinct(), "security_id", "left_semi")
    per_key = Window.partitionBy(*KEY)
    picked = rows.withColumn("pick", F.row_number().over(per_key.orderBy(F.desc("source"), F.desc("path"), F.desc("item"), F.desc("position"))))
    if strict:
        both = F.bool_or(F.col("source") == BASE).over(per_key) & F.bool_or(F.col("source") == DAILY).over(per_key)
        picked = picked.withColumn("clash", both).filter(
            F.when(F.col("clash"), F.raise_error(F.concat_ws(":", F.lit("BASE_DAILY_OVERLAP"), F.col("security_id"), F.col("date")))).otherwise(F.lit(True)).cast("boolean"))
    return picked.filter("pick = 1").select(*KEY, *FIELDS, "source")


def unique_splits(events: DataFrame) -> DataFrame:
    return events.dropDuplicates(["security_id", "effective_date", "factor"])


def later_factor(bars: DataFrame, events: DataFrame, reach: Column, name: str = "later_factor") -> DataFrame:
    """Adds the product of the factors of all distinct events of the bar's security that take effect after `reach`.

    Bars and events of a security lie in one descending order, a bar before the events of its own day, and one running
    product serves all bars: linear in bars and events, and no list of events is built. Bars that are placed by security
    stay where they are. A bar without `reach` has factor 1. A factor that is null or not above 0 stops the job where a
    bar lies before it.
    """
    rows = bars.withColumn("_reach", reach).withColumn("_event", F.lit(False))
    marks = unique_splits(events).select("security_id", F.col("effective_date").alias("_reach"), F.col("factor").alias("_factor"),
                                         F.lit(True).alias("_event")).repartition("security_id")
    both = rows.unionByName(marks, allowMissingColumns=True)
    so_far = (Window.partitionBy("security_id").orderBy(F.desc("_reach"), "_event")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sound = F.coalesce(F.col("_factor") > 0, F.lit(False))
    lined = both.select("*", F.product(F.when(F.col("_event") & sound, F.col("_factor")).otherwise(1.0)).over(so_far).alias("_product"),
                        F.bool_or(F.col("_event") & ~sound).over(so_far).alias("_bad"))
    factor = (F.when(F.col("_reach").isNull(), 1.0).when(F.col("_bad"), F.raise_error(F.lit("BAD_SPLIT_FACTOR")).cast("double"))
              .otherwise(F.col("_product")))
    return lined.filter(~F.col("_event")).select(*bars.columns, factor.alias(name))


def split_adjust(bars: DataFrame, events: DataFrame) -> DataFrame:
    """Apply each later split once: after the bar's date and after its adjustment anchor.

    Prices are divided, and volumes multiplied, by the product of the splits due. (Dividing split by split, as one may
    also do, can differ in the last bit.)
    """
    reach = F.when(F.col("date").isNotNull() & F.col("adjustment_as_of").isNotNull(), F.greatest("date", "adjustment_as_of"))
    due = later_factor(bars, events, reach)
    kept = [c for c in bars.columns if c not in PRICES + ("volume",)]
    return due.select(*kept, *[(F.col(p) / F.col("later_factor")).alias(p) for p in PRICES],
                      (F.col("volume") * F.col("later_factor")).alias("volume"))
