"""Silver/ticks -> gold daily OHLCV (A1 + P9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bars as B
from ..schemas import GOLD_DAILY_OHLCV_SCHEMA, conform
from .clean import ts_lit


def day_of(ts_col: str = "timestamp"):
    """Calendar day of a bar as timestamp_ntz (``date_trunc`` returns LTZ; cast back)."""
    return F.date_trunc("day", F.col(ts_col)).cast("timestamp_ntz")


def _finish(agg: DataFrame, run_ts) -> DataFrame:
    out = agg.select(
        "*",
        B.daily_return().alias("daily_return"),
        B.price_range().alias("price_range"),
        B.avg_price().alias("avg_price"),
        ts_lit(run_ts).alias("updated_timestamp"))
    return conform(out, GOLD_DAILY_OHLCV_SCHEMA)


def daily_ohlcv(silver: DataFrame, run_ts=None) -> DataFrame:
    """Valid bars rolled up per (symbol, day): open of the first bar, close of the last.

    ``min_by``/``max_by`` on the bar timestamp replace the reference's order-dependent
    ``first``/``last``. All six aggregates are partial (map-side), so the shuffle
    carries at most one row per (symbol, day, input partition) — a hot symbol
    costs no more than any other.
    """
    v = silver.filter(F.col("is_valid") == 1)
    agg = v.groupBy("symbol", day_of("timestamp").alias("trade_date")).agg(
        F.min_by("open", "timestamp").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "timestamp").alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("num_bars"))
    return _finish(agg, run_ts)


def daily_from_ticks(ticks: DataFrame, run_ts=None) -> DataFrame:
    """Ticks ``(symbol, trade_date, seq, price, volume)`` -> daily OHLCV; ``seq`` orders a day."""
    agg = ticks.groupBy("symbol", day_of("trade_date").alias("trade_date")).agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("num_bars"))
    return _finish(agg, run_ts)
