"""Incremental processing: high-water marks, new/touched symbol-days, suffix refresh.

Fixes two reference defects (SURVEY §7.5): the daily refresh covers symbol-days
*touched* since the last run (late bars re-open a day) as well as missing ones,
and indicators are recomputed from each affected symbol's full series instead of a
50-calendar-day cut that truncates the rolling windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import ts_lit
from .daily import daily_ohlcv, day_of
from .indicators import SMA_WINDOWS, VOLATILITY_ROWS, indicators
from .upsert import upsert

DAY_KEYS = ["symbol", "trade_date"]
# rows of history a recomputed indicator row needs before it (the widest rolling frame)
LOOKBACK_ROWS = max(*SMA_WINDOWS, VOLATILITY_ROWS) - 1


def incremental_bronze(bronze: DataFrame, last_ts=None, batch_ids: Sequence[str] | None = None) -> DataFrame:
    """P10: rows ingested strictly after ``last_ts`` and/or in ``batch_ids`` (each optional)."""
    if last_ts is not None:
        bronze = bronze.filter(F.col("ingestion_timestamp") > ts_lit(last_ts))
    if batch_ids:
        bronze = bronze.filter(F.col("batch_id").isin(list(batch_ids)))
    return bronze


def incremental_silver(silver: DataFrame, last_ts=None) -> DataFrame:
    """Rows processed strictly after ``last_ts``."""
    if last_ts is None:
        return silver
    return silver.filter(F.col("processed_timestamp") > ts_lit(last_ts))


def watermarks(bronze: DataFrame, silver: DataFrame, daily: DataFrame) -> DataFrame:
    """A2: the high-water mark of each layer, one row per layer (evaluate with one action).

    Use the bronze mark of the rows actually *read* as the next run's ``last_ts``
    (the reference compares ingestion time with processing time and can skip rows
    landing mid-run).
    """
    parts = [df.agg(F.max(c).alias("high_water_mark")).select(F.lit(n).alias("layer"), "high_water_mark")
             for n, df, c in (("bronze", bronze, "ingestion_timestamp"),
                              ("silver", silver, "processed_timestamp"),
                              ("gold", daily, "updated_timestamp"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def symbol_days(silver: DataFrame, valid_only: bool = True) -> DataFrame:
    s = silver.filter(F.col("is_valid") == 1) if valid_only else silver
    return s.select("symbol", day_of("timestamp").alias("trade_date")).distinct()


def new_dates(silver: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """Valid silver symbol-days missing from gold (all of them when gold is absent)."""
    days = symbol_days(silver)
    if daily is None:
        return days
    return days.join(daily.select(*DAY_KEYS), DAY_KEYS, "left_anti")


def restrict_to(silver: DataFrame, days: DataFrame) -> DataFrame:
    """Silver rows of the given symbol-days (``left_semi`` on named keys)."""
    keyed = silver.withColumn("trade_date", day_of("timestamp"))
    return keyed.join(days.select(*DAY_KEYS), DAY_KEYS, "left_semi").drop("trade_date")


def touched_days(changed_silver: DataFrame) -> DataFrame:
    """Symbol-days that received new or corrected bars (valid or not: an invalidated
    bar can change a day too)."""
    return symbol_days(changed_silver, valid_only=False)


def refresh_daily(silver_all: DataFrame, daily_target: DataFrame | None, changed_silver: DataFrame,
                  run_ts=None, complete: bool = False) -> tuple[DataFrame, DataFrame]:
    """Recompute the touched and missing symbol-days and upsert them into gold.

    Returns ``(new_daily, recomputed_rows)``. A touched day that lost all valid bars
    is removed from gold (its recomputation is empty). With ``complete``, gold is known to have had every symbol-day of
    silver before the change, so none but the touched ones can be missing and silver isn't compared with gold.
    """
    todo = touched_days(changed_silver)
    if not complete:
        todo = todo.unionByName(new_dates(silver_all, daily_target)).distinct()
    recomputed = daily_ohlcv(restrict_to(silver_all, todo), run_ts)
    if daily_target is None:
        return recomputed, recomputed
    kept = daily_target.join(todo, DAY_KEYS, "left_anti")
    return kept.unionByName(recomputed), recomputed


def lookback_start(daily: DataFrame, touched: DataFrame, part_col: str, days: int = 128) -> date | None:
    """The first day of ``part_col`` that :func:`refresh_indicators` reads for ``touched``; None: all days.

    Steps back from the first touched day over spans that double until no symbol lacks look-back rows and still has
    older ones. A step reads the keys of the days in the span, and symbols alone before it.
    """
    first = touched.groupBy("symbol").agg(F.min("trade_date").alias("_from"))
    lo = first.agg(F.to_date(F.min("_from"))).first()[0]
    while lo is not None and days < 1 << 17:
        start = lo - timedelta(days=days)
        full = (daily.filter(F.col(part_col) >= F.lit(start)).join(first, "symbol")
                .filter(F.col("trade_date") < F.col("_from"))
                .groupBy("symbol").count().filter(F.col("count") >= LOOKBACK_ROWS))
        short = first.join(full, "symbol", "left_anti")
        if daily.filter(F.col(part_col) < F.lit(start)).join(short, "symbol", "left_semi").isEmpty():
            return start
        days *= 2
    return None


def refresh_indicators(daily_all: DataFrame, analytics_target: DataFrame | None, touched: DataFrame,
                       run_ts=None) -> DataFrame:
    """Recompute indicators of every row at or after each symbol's earliest touched day.

    Each affected symbol's series is cut at the ``LOOKBACK_ROWS`` rows preceding its
    first touched day (found by a row_number over the two key columns only), so every
    recomputed row still sees its complete rolling frames while the expensive
    sliding-window pass covers only recent rows instead of the full history. Touched days
    that are gone from daily go from analytics too.
    """
    first = touched.groupBy("symbol").agg(F.min("trade_date").alias("_from"))
    keys = daily_all.select("symbol", "trade_date").join(first, "symbol")
    newest_first = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    cut = (keys.filter(F.col("trade_date") < F.col("_from"))
           .withColumn("_rn", F.row_number().over(newest_first))
           .filter(F.col("_rn") <= LOOKBACK_ROWS)
           .groupBy("symbol").agg(F.min("trade_date").alias("_cut")))
    bounds = first.join(cut, "symbol", "left").select(
        "symbol", "_from", F.coalesce(F.col("_cut"), F.col("_from")).alias("_cut"))
    series = (daily_all.join(bounds, "symbol").filter(F.col("trade_date") >= F.col("_cut"))
              .drop("_from", "_cut"))
    fresh = (indicators(series, run_ts).join(bounds.select("symbol", "_from"), "symbol")
             .filter(F.col("trade_date") >= F.col("_from")).drop("_from"))
    if analytics_target is None:
        return fresh
    return upsert(analytics_target, fresh, DAY_KEYS, deletes=touched)
