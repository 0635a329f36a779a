"""Pipeline monitoring reports (mon_*) over bronze / silver / gold.

``asof`` replaces ``CURRENT_DATE()`` and ``now`` replaces ``CURRENT_TIMESTAMP()``.
All per-day aggregates are bounded by the trailing window (<= days+1 rows), so the
full outer joins of the cross-layer check join tiny inputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .analytics import _days


def _ts(x) -> Column:
    return x if isinstance(x, Column) else F.lit(str(x)).cast("timestamp_ntz")


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def bronze_daily(bronze: DataFrame, asof, days: int = 7) -> DataFrame:
    """Per ingestion day: rows, symbols, null keys, first/last ingestion."""
    b = bronze.filter(F.col("ingestion_timestamp") >= _ts(asof) - _days(days))
    return (b.groupBy(F.to_date("ingestion_timestamp").alias("ingestion_date"))
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.count_distinct("symbol").alias("unique_symbols"),
                 _cnt(F.col("symbol").isNull()).alias("null_symbols"),
                 _cnt(F.col("timestamp").isNull()).alias("null_timestamps"),
                 _cnt(F.col("close").isNull()).alias("null_closes"),
                 F.min("ingestion_timestamp").alias("first_ingestion"),
                 F.max("ingestion_timestamp").alias("last_ingestion"))
            .orderBy(F.col("ingestion_date").desc()))


def silver_daily(silver: DataFrame, asof, days: int = 7) -> DataFrame:
    """Per processing day: validity counts, score statistics, validity rate."""
    s = silver.filter(F.col("processed_timestamp") >= _ts(asof) - _days(days))
    valid = _cnt(F.col("is_valid") == 1)
    return (s.groupBy(F.to_date("processed_timestamp").alias("process_date"))
            .agg(F.count(F.lit(1)).alias("total_records"), valid.alias("valid_records"),
                 _cnt(F.col("is_valid") == 0).alias("invalid_records"),
                 F.avg("quality_score").alias("avg_quality_score"),
                 F.min("quality_score").alias("min_quality_score"),
                 F.max("quality_score").alias("max_quality_score"),
                 (valid * 100.0 / F.count(F.lit(1))).alias("validity_rate_pct"))
            .orderBy(F.col("process_date").desc()))


def gold_completeness(daily: DataFrame, min_days: int = 20, gap_factor: float = 1.5) -> DataFrame:
    """P20: symbols with fewer than ``min_days`` days, flagged when the span exceeds
    ``gap_factor`` x the day count."""
    g = daily.groupBy("symbol").agg(F.count(F.lit(1)).alias("trading_days"),
                                    F.min("trade_date").alias("first_date"),
                                    F.max("trade_date").alias("last_date"))
    span = F.datediff(F.col("last_date"), F.col("first_date"))
    return (g.withColumn("date_range_days", span)
            .withColumn("completeness_status",
                        F.when(span > F.col("trading_days") * gap_factor, "Missing Days Detected")
                        .otherwise("Complete"))
            .filter(F.col("trading_days") < min_days)
            .orderBy("trading_days", "symbol"))


def cross_layer(bronze: DataFrame, silver: DataFrame, daily: DataFrame, asof, days: int = 7) -> DataFrame:
    """Per-day symbol and row counts of the three layers on one coalesced day key."""
    a = _ts(asof) - _days(days)
    b = (bronze.filter(F.col("timestamp") >= a).groupBy(F.to_date("timestamp").alias("trade_date"))
         .agg(F.count_distinct("symbol").alias("bronze_symbols"), F.count(F.lit(1)).alias("bronze_records")))
    s = (silver.filter(F.col("processed_timestamp") >= a)
         .groupBy(F.to_date("timestamp").alias("trade_date"))
         .agg(F.count_distinct("symbol").alias("silver_symbols"), F.count(F.lit(1)).alias("silver_records")))
    g = (daily.filter(F.col("trade_date") >= a).groupBy(F.to_date("trade_date").alias("trade_date"))
         .agg(F.count_distinct("symbol").alias("gold_symbols"), F.count(F.lit(1)).alias("gold_records")))
    j = b.join(s, "trade_date", "full_outer").join(g, "trade_date", "full_outer")
    status = (F.when(F.col("silver_records") < F.col("bronze_records") * 0.9, "Warning: High Silver Filter Rate")
              .when(F.col("gold_records") < F.col("silver_records") * 0.8, "Warning: High Gold Filter Rate")
              .otherwise("OK"))
    return (j.select("trade_date", "bronze_symbols", "bronze_records", "silver_symbols", "silver_records",
                     "gold_symbols", "gold_records", status.alias("consistency_status"))
            .orderBy(F.col("trade_date").desc()))


def alerts(silver: DataFrame, asof, days: int = 1, min_quality: float = 0.8,
           max_invalid: int = 100) -> DataFrame:
    """Processing days whose average score or invalid count breaches the thresholds."""
    s = silver.filter(F.col("processed_timestamp") >= _ts(asof) - _days(days))
    g = s.groupBy(F.to_date("processed_timestamp").alias("process_date")).agg(
        F.avg("quality_score").alias("avg_quality"), _cnt(F.col("is_valid") == 0).alias("invalid_count"))
    return g.filter((F.col("avg_quality") < min_quality) | (F.col("invalid_count") > max_invalid))


def _summary(df: DataFrame, layer: str, stamp: str, cond: Column | None) -> DataFrame:
    d = df if cond is None else df.filter(cond)
    return d.agg(F.count(F.lit(1)).alias("total_records"), F.count_distinct("symbol").alias("unique_symbols"),
                 F.max(stamp).alias("last_update")).select(F.lit(layer).alias("layer"), "*")


def health(bronze: DataFrame, silver: DataFrame, daily: DataFrame, asof, days: int = 1) -> DataFrame:
    """Layer totals over the last ``days``."""
    a = _ts(asof) - _days(days)
    parts = [_summary(bronze, "Bronze", "ingestion_timestamp", F.col("ingestion_timestamp") >= a),
             _summary(silver, "Silver", "processed_timestamp", F.col("processed_timestamp") >= a),
             _summary(daily, "Gold", "updated_timestamp", F.col("trade_date") >= a)]
    return reduce(DataFrame.unionByName, parts)


def freshness(bronze: DataFrame, silver: DataFrame, daily: DataFrame, now) -> DataFrame:
    """U1 + datediff: whole hours since each layer's last update."""
    n = _ts(now)
    parts = []
    for layer, df, stamp in (("Bronze", bronze, "ingestion_timestamp"), ("Silver", silver, "processed_timestamp"),
                             ("Gold", daily, "updated_timestamp")):
        parts.append(df.agg(F.max(stamp).alias("last_update")).select(
            F.lit(layer).alias("layer"), "last_update",
            F.timestamp_diff("HOUR", F.col("last_update"), n).alias("hours_since_update")))
    return reduce(DataFrame.unionByName, parts)


def symbol_day_consistency(silver: DataFrame, daily: DataFrame) -> DataFrame:
    """Complement to ``cross_layer`` (which compares daily rows with intraday rows):
    per day, the symbols with valid silver bars against the symbols present in gold.
    Both sides are per-day distinct counts, joined on the day (bounded by the calendar)."""
    s = (silver.filter(F.col("is_valid") == 1)
         .groupBy(F.to_date("timestamp").alias("trade_date"))
         .agg(F.count_distinct("symbol").alias("silver_symbol_days")))
    g = (daily.groupBy(F.to_date("trade_date").alias("trade_date"))
         .agg(F.count(F.lit(1)).alias("gold_rows")))
    j = s.join(g, "trade_date", "full_outer")
    ok = F.coalesce(F.col("silver_symbol_days"), F.lit(0)) == F.coalesce(F.col("gold_rows"), F.lit(0))
    return j.withColumn("status", F.when(ok, "OK").otherwise("Mismatch")).orderBy(F.col("trade_date").desc())
