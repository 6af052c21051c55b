"""Which securities are in play."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_active(default: bool = True) -> Column:
    """Listing status is ACTIVE; with `default` a missing status counts as ACTIVE."""
    status = F.col("listing_status")
    return F.coalesce(status, F.lit("ACTIVE")) == "ACTIVE" if default else status.eqNullSafe("ACTIVE")


def active_securities(securities: DataFrame, default: bool = True) -> DataFrame:
    return securities.filter(is_active(default))
