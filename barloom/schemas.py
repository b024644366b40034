"""Declared schemas of the tables the library reads and writes."""

from pyspark.sql import types as T


def _fields(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols.items()])


BARS_DAY = _fields(
    code=T.StringType(), date=T.DateType(), open=T.DoubleType(), high=T.DoubleType(),
    low=T.DoubleType(), close=T.DoubleType(), adj_close=T.DoubleType(), volume=T.DoubleType(),
)

BARS_INTRADAY = _fields(
    timestamp=T.TimestampType(), open=T.DoubleType(), high=T.DoubleType(), low=T.DoubleType(),
    close=T.DoubleType(), volume=T.DoubleType(), code=T.StringType(),
    timestamp_vn=T.TimestampType(),
)

CODE_LIST = _fields(code=T.StringType(), type=T.StringType())

REPORT = _fields(
    code=T.StringType(), nb=T.IntegerType(), min_date=T.DateType(), max_date=T.DateType(),
    updated=T.TimestampType(),
)

# The raw training file, after header normalisation; the date is still text.
SYMBOLS_DAILY = _fields(
    date=T.StringType(), code=T.StringType(), open=T.DoubleType(), high=T.DoubleType(),
    low=T.DoubleType(), close=T.DoubleType(), volume=T.DoubleType(),
)

# Columns the gap fill covers (volume stays as it is).
FILLED_DAY = ["open", "high", "low", "close", "adj_close"]
FILLED_INTRADAY = ["open", "high", "low", "close"]
