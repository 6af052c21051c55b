"""Table schemas."""
from pyspark.sql import types as T

BAR = T.StructType([
    T.StructField("security_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("adjustment_as_of", T.DateType()),
])

# A stored bar may carry a separate trade date; `effective_bars` folds it in.
STORED_BAR = T.StructType(BAR.fields[:2] + [T.StructField("trade_date", T.DateType())] + BAR.fields[2:])

PATCH = T.StructType([
    T.StructField("market", T.StringType()),
    T.StructField("security_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("accepted", T.BooleanType()),
    T.StructField("rows", T.ArrayType(STORED_BAR)),
])
PATCH_DOCUMENT = T.StructType(PATCH.fields + [T.StructField("items", T.ArrayType(PATCH))])

CORPORATE_ACTION = T.StructType([
    T.StructField("security_id", T.StringType()),
    T.StructField("effective_date", T.DateType()),
    T.StructField("factor", T.DoubleType()),
    T.StructField("ticker", T.StringType()),
])

CONTRACT = T.StructType([
    T.StructField("strike", T.DoubleType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask", T.DoubleType()),
])
OPTION_CHAIN = T.StructType([
    T.StructField("expirationDates", T.ArrayType(T.LongType())),
    T.StructField("options", T.ArrayType(T.StructType([
        T.StructField("expirationDate", T.LongType()),
        T.StructField("calls", T.ArrayType(CONTRACT)),
        T.StructField("puts", T.ArrayType(CONTRACT)),
    ]))),
])

SPLIT_EVENT = T.StructType([
    T.StructField("date", T.LongType()),
    T.StructField("numerator", T.DoubleType()),
    T.StructField("denominator", T.DoubleType()),
])
CHART = T.StructType([
    T.StructField("gmtoffset", T.LongType()),
    T.StructField("timestamp", T.ArrayType(T.LongType())),
    T.StructField("open", T.ArrayType(T.DoubleType())),
    T.StructField("high", T.ArrayType(T.DoubleType())),
    T.StructField("low", T.ArrayType(T.DoubleType())),
    T.StructField("close", T.ArrayType(T.DoubleType())),
    T.StructField("volume", T.ArrayType(T.DoubleType())),
    T.StructField("splits", T.MapType(T.StringType(), SPLIT_EVENT)),
])
