"""Declared layer schemas and a ``conform`` projection that enforces them.

Spark does not enforce ``nullable=False`` on DataFrames, so non-null columns are
enforced by the cleaning filters and reported by the expectation operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS = T.TimestampNTZType()

# Raw bar as written to the landing zone (timestamps as strings).
RAW_BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

BRONZE_BARS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timestamp", TS, False),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("ingestion_timestamp", TS, False),
    T.StructField("batch_id", T.StringType()),
])

BRONZE_SYMBOLS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("source", T.StringType()),
    T.StructField("ingestion_timestamp", TS, False),
    T.StructField("is_active", T.IntegerType()),
])

SILVER_BARS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timestamp", TS, False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("processed_timestamp", TS, False),
    T.StructField("is_valid", T.IntegerType()),
    T.StructField("quality_score", T.DoubleType()),
])

GOLD_DAILY_OHLCV_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("trade_date", TS, False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("num_bars", T.IntegerType()),
    T.StructField("daily_return", T.DoubleType()),
    T.StructField("price_range", T.DoubleType()),
    T.StructField("avg_price", T.DoubleType()),
    T.StructField("updated_timestamp", TS, False),
])

GOLD_ANALYTICS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("trade_date", TS, False),
    T.StructField("sma_5", T.DoubleType()),
    T.StructField("sma_20", T.DoubleType()),
    T.StructField("sma_50", T.DoubleType()),
    T.StructField("volatility", T.DoubleType()),
    T.StructField("updated_timestamp", TS, False),
])


def conform(df: DataFrame, schema: T.StructType, extra: dict[str, Column] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: cast every declared column, in declared order.

    ``extra`` supplies expressions for columns that ``df`` lacks (e.g. audit stamps).
    A declared column that is neither in ``df`` nor in ``extra`` raises.
    """
    extra = extra or {}
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in extra:
            src = extra[f.name]
        elif f.name in have:
            src = F.col(f.name)
        else:
            raise ValueError(f"column {f.name!r} missing for schema conform")
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)
