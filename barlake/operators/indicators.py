"""Gold analytics: rolling SMAs and volatility."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import GOLD_ANALYTICS_SCHEMA, conform
from .clean import ts_lit

# The reference's indicator windows (rows, current row included).
SMA_WINDOWS = (5, 20, 50)
VOLATILITY_ROWS = 20


def by_symbol():
    """Window base shared by every per-symbol series operator.

    Frames that share this partitioning/ordering are evaluated by one Window
    operator after one sort. Rows per symbol in a daily table are bounded by the
    number of trading days (~252 a year), not by data volume, so even a symbol
    holding a large share of all rows stays a small, bounded task.
    """
    return Window.partitionBy("symbol").orderBy("trade_date")


def with_indicators(daily: DataFrame, min_periods: int = 1) -> DataFrame:
    """Daily rows plus ``sma_5/20/50`` and ``volatility`` (stddev_samp of returns, 20 rows).

    ``min_periods`` > 1 turns SMAs computed on fewer rows into NULL (the reference
    emits partial-window values, which is the default here).
    """
    w = by_symbol()
    cols = {}
    for n in SMA_WINDOWS:
        frame = w.rowsBetween(-(n - 1), 0)
        sma = F.avg("close").over(frame)
        if min_periods > 1:
            sma = F.when(F.count("close").over(frame) >= min(n, min_periods), sma)
        cols[f"sma_{n}"] = sma
    cols["volatility"] = F.stddev_samp("daily_return").over(w.rowsBetween(-(VOLATILITY_ROWS - 1), 0))
    return daily.withColumns(cols)


def indicators(daily: DataFrame, run_ts=None, min_periods: int = 1) -> DataFrame:
    """W2 + W3 conformed to the gold analytics schema."""
    return conform(with_indicators(daily, min_periods), GOLD_ANALYTICS_SCHEMA,
                   extra={"updated_timestamp": ts_lit(run_ts)})


def sma_range(daily: DataFrame, days: int = 20, col: str = "close") -> DataFrame:
    """Time-range SMA over the trailing ``days`` calendar days (RANGE frame)."""
    return daily.withColumn(
        f"sma_{days}d",
        F.expr(f"avg({col}) OVER (PARTITION BY symbol ORDER BY trade_date "
               f"RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)"))
