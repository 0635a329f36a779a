"""ST4: continuous silver/gold refresh with ``foreachBatch``.

Each micro-batch of bronze rows is deduplicated and cleaned, merged into silver
(with deletions for keys whose newest row is unusable), then only the touched
symbol-days are recomputed into gold and only the affected symbols' indicator
suffixes into analytics. The final state equals a full batch recompute of all
bronze rows seen so far. Every table write is an ``upsert_path``: staged beside the
table and put in place whole, so a replayed micro-batch gives the same tables.
Malformed records go to the quarantine folder, one partition per micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import add_quality, dedup_latest, drop_null_keys, ts_lit
from ..operators.daily import daily_ohlcv, day_of
from ..operators.incremental import lookback_start, refresh_indicators, restrict_to
from ..operators.quality import observe_expectations
from ..operators.upsert import prune_partitions, read_table, upsert_path
from ..schemas import GOLD_DAILY_OHLCV_SCHEMA, SILVER_BARS_SCHEMA, conform
from .bronze import CORRUPT, EPOCH, RESCUED, bronze_from_stream, read_bars_stream

PART = "part_date"
OHLCV = ["open", "high", "low", "volume"]


@dataclass
class MedallionPaths:
    silver: str
    daily: str
    analytics: str


def _with_part(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn(PART, F.to_date(ts_col))


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, empty when nothing was written yet."""
    found = read_table(spark, path)
    if found is None:
        found = spark.createDataFrame([], schema).withColumn(PART, F.lit(None).cast("date"))
    return found


def recent_daily(spark: SparkSession, paths: MedallionPaths, touched: DataFrame) -> DataFrame:
    """The daily table from the first day on that the indicators of ``touched`` need (a partition filter)."""
    daily = _table(spark, paths.daily, GOLD_DAILY_OHLCV_SCHEMA)
    start = lookback_start(daily, touched, PART)
    return daily if start is None else daily.filter(F.col(PART) >= F.lit(start))


def process_bronze_batch(spark: SparkSession, batch: DataFrame, paths: MedallionPaths, run_ts=None) -> None:
    """Merge one batch of bronze rows into silver, daily and analytics on disk."""
    latest = dedup_latest(drop_null_keys(batch)).persist()
    try:
        if latest.isEmpty():
            return
        usable = latest.filter(" AND ".join(f"{c} IS NOT NULL" for c in OHLCV))
        unusable = latest.filter(" OR ".join(f"{c} IS NULL" for c in OHLCV))
        changes = conform(add_quality(usable.withColumn("processed_timestamp", ts_lit(run_ts))),
                          SILVER_BARS_SCHEMA)
        deletes = _with_part(unusable.select("symbol", "timestamp"), "timestamp")
        upsert_path(spark, _with_part(changes, "timestamp"), paths.silver, ["symbol", "timestamp"], PART,
                    deletes=deletes)

        touched = latest.select("symbol", day_of("timestamp").alias("trade_date")).distinct()
        silver_days = prune_partitions(_table(spark, paths.silver, SILVER_BARS_SCHEMA), PART,
                                       _with_part(touched, "trade_date"))
        recomputed = daily_ohlcv(restrict_to(silver_days.drop(PART), touched), run_ts)
        gone_days = _with_part(touched.join(recomputed.select("symbol", "trade_date"),
                                            ["symbol", "trade_date"], "left_anti"), "trade_date")
        upsert_path(spark, _with_part(recomputed, "trade_date"), paths.daily, ["symbol", "trade_date"], PART,
                    deletes=gone_days)

        # rows of days that vanished from gold vanish from analytics too
        fresh = refresh_indicators(recent_daily(spark, paths, touched).drop(PART), None, touched, run_ts)
        upsert_path(spark, _with_part(fresh, "trade_date"), paths.analytics, ["symbol", "trade_date"], PART,
                    deletes=gone_days)
    finally:
        latest.unpersist()


def start_medallion_stream(spark: SparkSession, landing: str, paths: MedallionPaths, checkpoint: str,
                           trigger: str | None = "availableNow", run_ts=None, ingestion_ts=None,
                           array_files: bool = False, quarantine_path: str | None = None,
                           **limits) -> StreamingQuery:
    """Run the landing stream into silver, daily and analytics.

    Malformed records go to ``quarantine_path`` (default: beside silver); fields that silver has no column for, and values of
    another type, go with their keys to ``<silver>_rescued``. ``limits`` are those of
    ``read_bars_stream`` (``max_files_per_trigger``, ``max_bytes_per_trigger``, ``clean_source``, ``archive_dir``)
    and bound a micro-batch. Expectation counts of each micro-batch are observed as ``bronze_expectations``.
    """
    raw = read_bars_stream(spark, landing, array_files, **limits)
    quarantine = quarantine_path or f"{paths.silver.rstrip('/')}_quarantine"
    rescued = f"{paths.silver.rstrip('/')}_rescued"

    def put(rows: DataFrame, epoch: int, path: str) -> None:
        (rows.withColumn(EPOCH, F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(EPOCH).parquet(path))

    def merge(rows: DataFrame, epoch: int) -> None:
        rows.persist()      # read and observed once
        try:
            bronze, bad = bronze_from_stream(rows, ingestion_ts)
            put(bad, epoch, quarantine)
            put(bronze.filter(F.col(RESCUED).isNotNull()).select("symbol", "timestamp", "batch_id", RESCUED), epoch, rescued)
            process_bronze_batch(spark, bronze.drop(RESCUED), paths, run_ts)
        finally:
            rows.unpersist()

    raw, _ = observe_expectations(raw, "bronze_expectations",
                                  {"well_formed": f"{CORRUPT} IS NULL", "close": "close IS NOT NULL"})
    w = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
