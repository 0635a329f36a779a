"""Registered queries over stored layers: catalog tables, partitioned folders, file and column statistics, batch landing
reads, a table of read requests, and the stream that runs until it is stopped.

Tables live in a database of their own below the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.symbols import normalize_interval
from ..operators.clean import clean_bronze_to_silver
from ..operators.daily import daily_ohlcv
from ..session import checkpoint_dir
from ..sources import fixtures as FX
from ..sources import tables as TB
from ..sources.landing import read_bars_batch, to_bronze, write_landing
from ..sources.requests import request_problem
from ..streaming.bronze import EPOCH, RESCUED, read_bronze, start_bronze_stream
from .oracle import RUN_TS, with_ctes
from .registry import bronze, daily_bars, reg, silver
from .streams import _arrivals, _root

MEASURES = ["open", "high", "low", "close", "volume"]


def _database(spark) -> str:
    name = f"barlake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{checkpoint_dir(spark).rstrip('/')}/{name}'")
    return name


def _bronze_batch(spark, sf_dir):
    """The landing folder of all bars, read as a batch."""
    root = _root(spark)
    write_landing(bronze(spark, sf_dir), f"{root}/landing")
    raw = read_bars_batch(spark, f"{root}/landing")
    return to_bronze(raw, batch_col=F.col("batch_id")).drop("ingestion_timestamp")


reg("bronze_batch", with_ctes("bronze") + """SELECT symbol, "timestamp", open, high, low, close, volume, batch_id
    FROM bronze""")(_bronze_batch)


def _silver_table(spark, sf_dir):
    """The first load creates the table, the late corrections are merged into it."""
    name = f"{_database(spark)}.silver_bars"
    for arrival in _arrivals(spark, sf_dir):
        TB.merge_or_create(clean_bronze_to_silver(arrival, RUN_TS), name, ["symbol", "timestamp"], "timestamp")
    return spark.table(name)


reg("silver_table", with_ctes("silver") + """SELECT *, CAST("timestamp" AS DATE) AS part_date FROM silver""")(_silver_table)


def _gold_replaced(spark, sf_dir):
    """Declared tables; gold written whole, then replaced by a run whose silver has lost the first day."""
    tables = TB.ensure_tables(spark, _database(spark))
    gold = next(t for t in tables if t.endswith(".gold_daily_ohlcv"))
    bars = silver(spark, sf_dir)
    TB.create_or_replace(daily_ohlcv(bars, RUN_TS), gold, "trade_date")
    day = F.to_date("timestamp")
    TB.create_or_replace(daily_ohlcv(bars.filter(day > bars.select(F.min(day)).scalar()), RUN_TS), gold, "trade_date")
    return spark.table(gold)


reg("gold_replaced", with_ctes("silver", "daily_bars") + """SELECT *, CAST(trade_date AS DATE) AS part_date FROM daily_bars
    WHERE trade_date >= (SELECT min(CAST("timestamp" AS DATE)) FROM silver) + INTERVAL 1 DAY""")(_gold_replaced)


def _partition_report(spark, sf_dir):
    """Silver by day: rows of the stored table beside what the file report says of each day."""
    path = f"{_root(spark)}/silver"
    TB.write_partitioned(silver(spark, sf_dir), path, "timestamp")
    rows = spark.read.parquet(path).groupBy(TB.PART).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(TB.partition_files(spark, path), TB.PART, "full").select(
        TB.PART, "n_rows", (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


reg("partition_report", with_ctes("silver") + """SELECT CAST("timestamp" AS DATE) AS part_date, count(*) AS n_rows,
        true AS has_files, true AS has_bytes FROM silver GROUP BY 1""")(_partition_report)


def _table_statistics(spark, sf_dir):
    """Statistics of the bars before silver drops those without prices."""
    name = f"{_database(spark)}.bronze_bars"
    TB.create_or_replace(bronze(spark, sf_dir).select("symbol", "timestamp", *MEASURES), name)
    TB.analyze(spark, name, MEASURES)
    return TB.column_statistics(spark, name, MEASURES)


reg("table_statistics", with_ctes("bronze") + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, min({c})::DOUBLE AS least,
        max({c})::DOUBLE AS greatest FROM bronze""" for c in MEASURES))(_table_statistics)


def _request_check(spark, sf_dir):
    """A read request for each order: some without symbols, with a blank one, or with an empty period."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    symbols = (F.when(key % 11 == 0, F.array().cast("array<string>"))
               .when(key % 13 == 0, F.array("o_orderpriority", F.lit(" "))).otherwise(F.array("o_orderpriority")))
    start = F.col("o_orderdate").cast("timestamp_ntz")
    end = start + F.make_dt_interval((cust % 9 - 2).cast("int"))
    checked = FX.table(spark, sf_dir, "orders").select(
        F.coalesce(request_problem(symbols, start, end), F.lit("none")).alias("problem"),
        normalize_interval(F.concat((cust % 6).cast("string"), F.lit("m"))).alias("bar_interval"))
    return checked.groupBy("problem", "bar_interval").agg(F.count(F.lit(1)).alias("requests"))


reg("request_check", """SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'no symbols given' WHEN o_orderkey % 13 = 0 THEN 'a symbol is blank'
        WHEN o_custkey % 9 <= 2 THEN 'the request ends before it starts' ELSE 'none' END AS problem,
    CASE WHEN o_custkey % 6 IN (1, 2, 5) THEN (o_custkey % 6) || 'm' ELSE '1d' END AS bar_interval, count(*) AS requests
    FROM orders GROUP BY 1, 2""")(_request_check)

reg("daily_preview", with_ctes("daily_bars") + "SELECT * FROM daily_bars ORDER BY trade_date DESC, symbol LIMIT 100")(
    # T4: the exploratory limit is the feature
    lambda s, d: daily_bars(s, d).orderBy(F.desc("trade_date"), "symbol").limit(100))


def _continuous(spark, sf_dir):
    """One stream over both arrivals, started before the second lands and stopped once both are in."""
    root = _root(spark)
    first, late = _arrivals(spark, sf_dir)
    write_landing(first, f"{root}/landing")
    queries = start_bronze_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt", trigger=None)
    try:
        for q in queries:
            q.processAllAvailable()
        write_landing(late.withColumn("batch_id", F.concat("batch_id", F.lit("L"))), f"{root}/landing")
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
    return read_bronze(spark, f"{root}/bronze").drop("ingestion_timestamp", RESCUED, EPOCH)


reg("bronze_stream_continuous", with_ctes("bronze0", "bronze1") + """SELECT symbol, "timestamp", open, high, low, close, volume,
        batch_id FROM (SELECT * FROM bronze0 UNION ALL SELECT * REPLACE (batch_id || 'L' AS batch_id) FROM bronze1) b
    WHERE coalesce(symbol, '') != '' AND "timestamp" IS NOT NULL""")(_continuous)
