"""Register of runnable queries and, where SQL can say the same, their oracle text."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    """Register a query; its result is put into the comparable form by `present`."""
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir), digits)
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def rounded(x: Column) -> Column:
    """`round(x)` of doubles, ties away from zero, in plain arithmetic: Spark's own makes a decimal text of every value.

    From 2^52 on doubles are whole. The number below 0.5 lifts a tie to the next whole number and nothing less than a tie.
    """
    return F.when(F.abs(x) < 2.0**52, F.signum(x) * F.floor(F.abs(x) + 0.49999999999999994)).otherwise(x)


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Dates as ISO text, doubles rounded (negative zero made plain), integers as bigint."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            value = value.cast("string")
        elif isinstance(field.dataType, T.DoubleType):
            scaled = value * 10.0**digits  # as the SQL engine rounds, ties too; what cannot be scaled stays
            value = F.when(F.abs(scaled) < 1e300, rounded(scaled) / 10.0**digits).otherwise(value) + F.lit(0.0)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        columns.append(value.alias(field.name))
    return df.select(*columns)


# --- SQL building blocks ------------------------------------------------------
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (needs, text)


def with_ctes(*names: str, extra: str = "", recursive: bool = False) -> str:
    """`WITH a AS (...), b AS (...)` holding the named blocks and all they need."""
    seen: list[str] = []

    def visit(name):
        for need in CTES[name][0]:
            visit(need)
        if name not in seen:
            seen.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in seen]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + (",\n" + extra if extra else "") + "\n"


def r(expr: str, alias: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {alias}"


def day(expr: str, alias: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {alias}"
