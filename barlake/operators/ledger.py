"""J1/J2 on stored layers: a ledger of what each run changed, so that later runs read nothing else.

A run that merges bars into silver notes the symbol-days that it touched, under its run number. The gold refresh takes the
entries after the last run that it has seen: their days are literal partition filters on silver and gold, their
symbol-days are joined to what is left. No run compares whole layers, and none reads a day that nobody touched.

A ledger is a parquet folder ``run=<n>/`` with rows (symbol, part_date); a run that is tried again overwrites its
entry. What gold has seen is noted in ``seen/run=<n>/`` after gold has been written, so a refresh that a crash cut short is done
again, with the same result.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .daily import daily_ohlcv
from .incremental import lookback_start, refresh_indicators, restrict_to
from .upsert import read_table, upsert_path

PART = "part_date"
#: Days that are put into a partition filter one by one; of more, the span from the first to the last.
LISTED_DAYS = 1000


def _latest(spark: SparkSession, path: str) -> int:
    found = read_table(spark, path)
    return -1 if found is None else found.agg(F.coalesce(F.max("run"), F.lit(-1))).first()[0]


def _noted(rows: DataFrame, path: str, run: int) -> None:
    (rows.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(path))


def note(ledger: str, run: int, changed: DataFrame) -> None:
    """Note the symbol-days of ``changed`` (symbol, timestamp) as touched by ``run``."""
    _noted(changed.select("symbol", F.to_date("timestamp").alias(PART)).distinct(), f"{ledger.rstrip('/')}/touched", run)


def pending(spark: SparkSession, ledger: str) -> tuple[DataFrame | None, int]:
    """(symbol, part_date) touched by runs that gold hasn't seen, and the last run; None if there is none."""
    at = ledger.rstrip("/")
    last, seen = _latest(spark, f"{at}/touched"), _latest(spark, f"{at}/seen")
    if last <= seen:
        return None, last
    touched = read_table(spark, f"{at}/touched").filter(F.col("run") > seen)    # a partition filter
    return touched.select("symbol", PART).distinct(), last


def days_of(touched: DataFrame) -> list[date]:
    """The touched days: a row a calendar day, whatever the size of the data."""
    return sorted(r[0] for r in touched.select(PART).filter(F.col(PART).isNotNull()).distinct().collect())


def on_days(table: DataFrame, days: list[date], part_col: str = PART) -> DataFrame:
    """``table`` on the given days, as literal filters on its partition column."""
    if not days:
        return table.filter(F.lit(False))
    if len(days) <= LISTED_DAYS:
        return table.filter(F.col(part_col).isin(days))
    return table.filter(F.col(part_col).between(days[0], days[-1]))


def merge_bars(spark: SparkSession, bars: DataFrame, silver: str, ledger: str, run: int) -> None:
    """S8 with a ledger: upsert cleaned bars into stored silver, and note what they touched.

    The note comes last: a run that dies in between is run again, merges the same rows and notes them then.
    """
    rows = bars.withColumn(PART, F.to_date("timestamp"))
    upsert_path(spark, rows, silver, ["symbol", "timestamp"], PART)
    note(ledger, run, rows)


def touched_silver(spark: SparkSession, silver: str, touched: DataFrame) -> DataFrame:
    """The stored silver rows of the touched symbol-days; only those days' partitions are read."""
    days = on_days(spark.read.parquet(silver), days_of(touched))
    return restrict_to(days, touched.select("symbol", F.col(PART).cast("timestamp_ntz").alias("trade_date")))


def refresh_gold(spark: SparkSession, silver: str, daily: str, analytics: str, ledger: str, run_ts=None) -> int:
    """Bring stored gold up to the ledger: the touched symbol-days of daily, and the indicators from there on.

    Symbol-days that lost their last valid bar go from both layers. Returns the last run that gold has seen.
    """
    touched, last = pending(spark, ledger)
    if touched is None:
        return last
    touched = touched.persist()
    try:
        days = touched.select("symbol", F.col(PART).cast("timestamp_ntz").alias("trade_date"), PART)
        fresh = daily_ohlcv(touched_silver(spark, silver, touched).drop(PART), run_ts).withColumn(PART, F.to_date("trade_date"))
        upsert_path(spark, fresh, daily, ["symbol", "trade_date"], PART, deletes=days)
        stored = read_table(spark, daily)
        if stored is None:      # no symbol has a valid bar yet, or any longer
            stored = fresh.limit(0)
        start = lookback_start(stored, days, PART)
        recent = stored if start is None else stored.filter(F.col(PART) >= F.lit(start))
        suffix = refresh_indicators(recent.drop(PART), None, days.drop(PART), run_ts).withColumn(PART, F.to_date("trade_date"))
        upsert_path(spark, suffix, analytics, ["symbol", "trade_date"], PART, deletes=days)
    finally:
        touched.unpersist()
    _noted(spark.range(1).select(F.current_timestamp().alias("at")), f"{ledger.rstrip('/')}/seen", last)
    return last

