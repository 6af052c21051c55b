"""Both markets' months under one pointer."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_name(as_of: Column, market: str = "US") -> Column:
    return F.concat(F.lit("MONTH_" if market == "US" else market + "_MONTH_"), F.date_format(as_of, "yyyy-MM"))


def combined_pointer(us_pointer: DataFrame, hk_summary: DataFrame, us_as_of, hk_as_of,
                     prior: DataFrame | None = None) -> DataFrame:
    """One row: month names, the signals of each side, certifications, version.

    Months that disagree between the markets stop the job. `prior`: month_file,
    hk_month_file, version of the pointer in force.
    """
    us_month, hk_month = month_name(F.lit(us_as_of).cast("date")), month_name(F.lit(hk_as_of).cast("date"), "HK")

    def of(side, name):
        return F.max(F.when(F.col("side") == side, F.col(name)))

    sides = [(s, s.lower()) for s in ("LONG", "SHORT")]
    us = us_pointer.agg(*[of(s, c).alias(f"{n}_{c}") for s, n in sides for c in ("direction_signal", "vertical_baseline")])
    hk = hk_summary.agg(*[of(s, "status").alias(f"hk_{n}_edge") for s, n in sides])
    one = F.lit(1).alias("one")
    row = us.select("*", one).join(hk.select("*", one), "one").select(
        "*", us_month.alias("month_file"), hk_month.alias("hk_month_file"))
    agree = F.when(F.col("hk_month_file") != F.concat(F.lit("HK_"), "month_file"), F.raise_error(F.lit("MONTH_MARKET_MISMATCH")))
    row = row.filter(F.coalesce(agree.cast("boolean"), F.lit(True)))
    if prior is None:
        return row.drop("one").withColumn("version", F.lit(1))
    old = prior.select("version", F.col("month_file").alias("p_us"), F.col("hk_month_file").alias("p_hk"), one)
    same = (F.col("month_file") == F.col("p_us")) & (F.col("hk_month_file") == F.col("p_hk"))
    return row.join(old, "one").withColumn("version", F.when(same, F.col("version")).otherwise(F.col("version") + 1)).drop(
        "one", "p_us", "p_hk")
