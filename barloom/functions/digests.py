"""Digests of what a table holds, whatever its order and layout.

A row's text lists its columns; the digest counts rows and sums two 60-bit pieces of each text's MD5. Digests of parts can
be merged by adding, a row that is dropped, repeated or changed in any column changes the digest, and any engine with MD5
and wide integers can compute the same.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_text(rows: DataFrame, columns: list[str], digits: int | None = None) -> Column:
    """The columns' values, joined by bars: `~` for null, texts with their length before them, dates in ISO form.

    Doubles are written in full, so that any change shows; with `digits` as whole numbers of that many decimals.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def cell(name):
        value, kind = F.col(f"`{name}`"), kinds[name]
        if isinstance(kind, T.StringType):
            text = F.concat(F.length(value).cast("string"), F.lit(":"), value)
        elif isinstance(kind, (T.DoubleType, T.FloatType)) and digits is not None:
            text = F.round(value * 10.0**digits).cast("bigint").cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        else:
            text = value.cast("string")
        return F.coalesce(text, F.lit("~"))
    return F.concat_ws("|", *[cell(c) for c in columns])


def digest(text: Column) -> Column:
    """Aggregate of row texts: count, and the sums of both pieces, joined by colons."""
    md5 = F.md5(text.cast("binary"))
    sums = [F.sum(F.conv(F.substring(md5, at, 15), 16, 10).cast("decimal(20,0)")) for at in (1, 16)]
    return F.concat_ws(":", F.count(text), *[F.coalesce(s, F.lit(0)).cast("string") for s in sums])


def merged(digests: Column) -> Column:
    """Aggregate of digests of parts: the digest of the whole."""
    pieces = [F.coalesce(F.sum(F.split_part(digests, F.lit(":"), F.lit(i)).cast("decimal(30,0)")), F.lit(0)).cast("string") for i in (1, 2, 3)]
    return F.concat_ws(":", *pieces)


def content_digest(rows: DataFrame, columns: list[str], by: list[str] = (), digits: int | None = None) -> DataFrame:
    """rows and digest of the content, for each value of `by`, in one pass."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), digest(row_text(rows, columns, digits)).alias("digest"))
