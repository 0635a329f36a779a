"""Registered streaming queries: run the stream to completion (``availableNow``) over
landing files written from the test tables, then return the resulting table.

Scratch tables go under the session's ``spark.checkpoint.dir`` (the cluster's
shared folder); a private folder is created only when that is unset (tests).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from ..operators.upsert import read_table
from ..session import checkpoint_dir
from ..sources import fixtures as FX
from ..sources.landing import write_landing
from ..streaming.bronze import EPOCH, RESCUED, read_bronze, start_bronze_stream
from ..streaming.expectations import ExpectationLog, expectation_history
from ..streaming.medallion import PART, MedallionPaths, start_medallion_stream
from .oracle import RUN_TS, with_ctes
from .registry import bronze, reg


def _root(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/barlake-stream-{uuid.uuid4().hex}"


def _arrivals(spark, sf_dir):
    """Two arrivals of landing data: the first load, then the late corrections."""
    b = bronze(spark, sf_dir)
    base = F.lit(FX.INGEST_BASE).cast("timestamp_ntz")
    return b.filter(F.col("ingestion_timestamp") <= base), b.filter(F.col("ingestion_timestamp") > base)


def _bronze_stream(spark, sf_dir):
    root = _root(spark)
    for i, arrival in enumerate(_arrivals(spark, sf_dir)):
        write_landing(arrival, f"{root}/landing")
        for q in start_bronze_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt",
                                     "availableNow", quarantine_path=f"{root}/quarantine"):
            q.awaitTermination()
    return read_bronze(spark, f"{root}/bronze").drop("ingestion_timestamp", RESCUED, EPOCH)


def _bronze_evolution(spark, sf_dir):
    """Bars as declared, then the late corrections with three more fields and a volume in quotes now and then."""
    root = _root(spark)
    first, late = _arrivals(spark, sf_dir)
    write_landing(first, f"{root}/landing")
    fields = [F.col("symbol"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("close")]
    more = [(F.floor("close") + 0.5).alias("vwap"), (F.col("volume") % 100).alias("trades"),
            F.when(F.col("volume") % 3 == 0, F.lit("X")).alias("venue")]
    plain = F.to_json(F.struct(*fields, F.col("volume"), *more))
    quoted = F.to_json(F.struct(*fields, F.col("volume").cast("string").alias("volume"), *more))

    def run():
        for q in start_bronze_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt", "availableNow"):
            q.awaitTermination()

    run()
    late.select(F.when(F.col("volume") % 5 == 0, quoted).otherwise(plain).alias("value"),
                "batch_id").write.mode("append").partitionBy("batch_id").text(f"{root}/landing")
    run()
    got = read_bronze(spark, f"{root}/bronze")
    return got.select("symbol", "timestamp", "close", "volume", "batch_id", "trades", "venue", "vwap",
                      F.to_json(RESCUED).alias("rescued"))


reg("bronze_evolution", with_ctes("bronze0", "bronze1") + """SELECT symbol, "timestamp", close, volume, batch_id,
        CAST(NULL AS BIGINT) AS trades, NULL::VARCHAR AS venue, NULL::DOUBLE AS vwap, NULL::VARCHAR AS rescued
    FROM bronze0 WHERE symbol IS NOT NULL AND symbol != '' AND "timestamp" IS NOT NULL
    UNION ALL SELECT symbol, "timestamp", close, CASE WHEN volume % 5 != 0 THEN volume END, batch_id, volume % 100,
        CASE WHEN volume % 3 = 0 THEN 'X' END, floor(close) + 0.5,
        CASE WHEN volume % 5 = 0 THEN '{"volume":"' || volume || '"}' END
    FROM bronze1 WHERE symbol IS NOT NULL AND symbol != '' AND "timestamp" IS NOT NULL""")(_bronze_evolution)


def _medallion_stream(spark, sf_dir, table: str):
    root = _root(spark)
    paths = MedallionPaths(f"{root}/silver", f"{root}/daily", f"{root}/analytics")
    for arrival in _arrivals(spark, sf_dir):
        write_landing(arrival, f"{root}/landing")
        start_medallion_stream(spark, f"{root}/landing", paths, f"{root}/ckpt", "availableNow",
                               run_ts=RUN_TS).awaitTermination()
    return read_table(spark, getattr(paths, table)).drop(PART)


def _bad_lines(spark, sf_dir, root: str):
    """A landing folder of all bars, a line each; those whose volume divides by 7 lack the closing brace."""
    stamp = F.coalesce(F.concat(F.lit('"'), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"')), F.lit("null"))
    cents = F.coalesce(F.floor(F.col("close") * 100).cast("string"), F.lit("null"))
    line = F.concat(F.lit('{"symbol":"'), "symbol", F.lit('","timestamp":'), stamp, F.lit(',"close":'), cents, F.lit(',"volume":'),
                    F.col("volume").cast("string"))
    bronze(spark, sf_dir).select(
        F.concat(line, F.when(F.col("volume") % 7 == 0, "").otherwise("}")).alias("value"), "batch_id",
    ).write.partitionBy("batch_id").text(f"{root}/landing")
    queries = start_bronze_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt", "availableNow",
                                  quarantine_path=f"{root}/quarantine", max_files_per_trigger=100)
    for q in queries:
        q.awaitTermination()
    return spark.read.parquet(f"{root}/quarantine").select("raw_record", F.col("source").cast("string").alias("source"))


reg("bronze_quarantine", with_ctes("bronze") + """SELECT '{"symbol":"' || symbol || '","timestamp":'
        || coalesce(strftime("timestamp", '"%Y-%m-%dT%H:%M:%S"'), 'null') || ',"close":'
        || coalesce(CAST(CAST(floor(close * 100) AS BIGINT) AS VARCHAR), 'null') || ',"volume":' || volume AS raw_record,
    batch_id AS source FROM bronze WHERE volume % 7 = 0""")(lambda s, d: _bad_lines(s, d, _root(s)))


def _late_invalidation(spark, sf_dir):
    """Bars first, then for each symbol's first day a newer copy of every bar without an open price."""
    root = _root(spark)
    paths = MedallionPaths(f"{root}/silver", f"{root}/daily", f"{root}/analytics")
    b = bronze(spark, sf_dir).filter("symbol IS NOT NULL AND symbol != '' AND timestamp IS NOT NULL")
    day = F.to_date("timestamp")
    late = b.filter(day == b.select(F.min(day)).scalar()).withColumn("open", F.lit(None).cast("double"))
    for arrival, batch in ((late.limit(0), "20240101"), (late.limit(1), "20240101"), (b, None), (late, "20990101")):
        if batch:
            arrival = arrival.withColumn("batch_id", F.lit(batch))
        write_landing(arrival, f"{root}/landing")
        start_medallion_stream(spark, f"{root}/landing", paths, f"{root}/ckpt", "availableNow",
                               run_ts=RUN_TS, max_files_per_trigger=1000).awaitTermination()
    return read_table(spark, paths.daily).drop(PART)


reg("stream_late_invalidation", with_ctes("bronze", "daily_bars") + """SELECT * FROM daily_bars
    WHERE CAST(trade_date AS DATE) > (SELECT min(CAST("timestamp" AS DATE)) FROM bronze
        WHERE symbol IS NOT NULL AND symbol != '')""")(_late_invalidation)

reg("bronze_stream", with_ctes("bronze") + """SELECT symbol, "timestamp", open, high, low, close, volume, batch_id
    FROM bronze WHERE coalesce(symbol IS NOT NULL AND symbol != '', false) AND "timestamp" IS NOT NULL""")(
    _bronze_stream)

reg("stream_medallion", with_ctes("silver") + "SELECT * FROM silver")(
    lambda s, d: _medallion_stream(s, d, "silver"))

reg("stream_medallion_daily", with_ctes("daily_bars") + "SELECT * FROM daily_bars")(
    lambda s, d: _medallion_stream(s, d, "daily"))

reg("stream_medallion_analytics", with_ctes("analytics_bars") + "SELECT * FROM analytics_bars",
    ("sma_5", "sma_20", "sma_50", "volatility"))(
    lambda s, d: _medallion_stream(s, d, "analytics"))


def _expectation_history(spark, sf_dir):
    """The landing stream in two runs, its expectations kept by the listener."""
    root = _root(spark)
    log = ExpectationLog(spark, f"{root}/expectations", {"landing_expectations": "landing"})
    spark.streams.addListener(log)
    try:
        for i, arrival in enumerate(_arrivals(spark, sf_dir)):
            write_landing(arrival, f"{root}/landing")
            for q in start_bronze_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt", "availableNow"):
                q.awaitTermination()
            while (read_table(spark, f"{root}/expectations/query={q.id}/batch={i}") is None):
                time.sleep(0.1)     # events arrive a little after the batch
    finally:
        spark.streams.removeListener(log)
    return expectation_history(spark, f"{root}/expectations").drop("query", "observed_at")


reg("expectation_history", with_ctes("bronze0", "bronze1") + """SELECT batch, dataset, expectation, passed_records,
        input_records - passed_records AS failed_records, input_records, passed_records * 100.0 / input_records AS pass_rate_pct
    FROM (SELECT batch, 'landing' AS dataset, expectation, count(*) AS input_records,
                 count(*) FILTER (CASE expectation WHEN 'valid_symbol' THEN coalesce(symbol, '') != ''
                                  WHEN 'valid_timestamp' THEN "timestamp" IS NOT NULL ELSE true END) AS passed_records
          FROM (SELECT 0::BIGINT AS batch, * FROM bronze0 UNION ALL SELECT 1, * FROM bronze1) b,
               (SELECT unnest(['well_formed', 'nothing_rescued', 'valid_symbol', 'valid_timestamp']) AS expectation) e
          GROUP BY ALL) counted""", ("pass_rate_pct",))(_expectation_history)
