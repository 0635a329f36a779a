"""Market-data inputs derived from the driver's parquet tables (see FIXTURES.md).

* ``bars``            dirty hourly bars from ``events`` (B1)
* ``bronze_bars``     bars as bronze rows with ingestion stamp and batch id
* ``ticks_orders``    clean ticks from ``orders`` (B2): 5 symbols, 1995-2001
* ``ticks_supplier``  bench-scale ticks from ``lineitem`` (B3): one symbol per supplier

All are lazy projections/aggregations of parquet scans, so column pruning and
filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the B1 derivation (FIXTURES.md): which bars get which defect.
NULL_TS_MOD, NULL_OPEN_MOD, BROKEN_HIGH_MOD = 97, 89, 31
NULL_CLOSE_MOD, NEG_CLOSE_MOD, LATE_FIX_MOD = 53, 37, 20
INGEST_BASE = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(c):
    return c.cast("timestamp_ntz")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars per event type with injected defects and late corrections."""
    ev = table(spark, sf_dir, "events")
    g = (ev.groupBy(F.col("event_type").alias("symbol"),
                    _ntz(F.date_trunc("hour", "ts")).alias("hr"))
         .agg(F.min("event_id").alias("bar_id"),
              F.min_by("value", "event_id").alias("o"),
              F.max("value").alias("h"),
              F.min("value").alias("l"),
              F.max_by("value", "event_id").alias("c"),
              F.sum(F.floor(F.col("value") * 100).cast("bigint")).alias("v")))
    bid = F.col("bar_id")
    dirty = F.struct(
        F.when(bid % NULL_TS_MOD != 0, F.col("hr")).alias("ts"),
        F.when(bid % NULL_OPEN_MOD != 0, F.col("o")).alias("open"),
        F.when(bid % BROKEN_HIGH_MOD == 0, F.col("l") - 1.0).otherwise(F.col("h")).alias("high"),
        F.col("l").alias("low"),
        F.when(bid % NULL_CLOSE_MOD == 0, F.lit(None).cast("double"))
         .when(bid % NEG_CLOSE_MOD == 0, -F.col("c")).otherwise(F.col("c")).alias("close"),
        F.col("v").alias("volume"),
        F.lit(0).alias("ingest_seq"))
    late = F.struct(F.col("hr").alias("ts"), F.col("o").alias("open"), F.col("h").alias("high"),
                    F.col("l").alias("low"), F.col("c").alias("close"), (F.col("v") + 1).alias("volume"),
                    F.lit(1).alias("ingest_seq"))
    # one aggregation of the events; each bar yields its dirty row and, for every
    # LATE_FIX_MOD-th bar, a clean late correction
    versions = F.filter(F.array(dirty, F.when(bid % LATE_FIX_MOD == 0, late)), lambda x: x.isNotNull())
    return (g.select("bar_id", "symbol", "hr", F.explode(versions).alias("b"))
            .select("bar_id", "symbol", "hr", "b.*"))


def bronze_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as bronze rows: ``ingestion_timestamp`` = base + ingest_seq hours, batch = yyyyMMdd."""
    b = bars(spark, sf_dir)
    return b.select(
        "symbol", F.col("ts").alias("timestamp"), "open", "high", "low", "close", "volume",
        (F.lit(INGEST_BASE).cast("timestamp_ntz")
         + F.make_dt_interval(hours=F.col("ingest_seq"))).alias("ingestion_timestamp"),
        F.date_format("hr", "yyyyMMdd").alias("batch_id"))


def ticks_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, trade_date, seq, price, volume) ticks from orders."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("symbol"),
                    _ntz(F.col("o_orderdate")).alias("trade_date"),
                    F.col("o_orderkey").alias("seq"),
                    F.col("o_totalprice").alias("price"),
                    F.lit(1).cast("bigint").alias("volume"))


def ticks_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, trade_date, seq, price, volume) ticks from lineitem, one symbol per supplier."""
    li = table(spark, sf_dir, "lineitem")
    seq = (F.col("l_orderkey") * 100000000 + F.col("l_linenumber").cast("bigint") * 10000000
           + F.col("l_partkey"))
    return li.select(F.col("l_suppkey").cast("string").alias("symbol"),
                     _ntz(F.col("l_shipdate")).alias("trade_date"),
                     seq.alias("seq"),
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                     F.col("l_quantity").cast("bigint").alias("volume"))
