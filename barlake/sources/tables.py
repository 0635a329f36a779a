"""Catalog and layout utilities (S7, S11, S12, S15, S16, S17) on plain parquet tables.

Tables are created through Spark's catalog with ``USING parquet`` (no vendor table
format); daily layers are partitioned by a date column so date predicates prune
whole directories.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import upsert_path
from ..schemas import (BRONZE_BARS_SCHEMA, BRONZE_SYMBOLS_SCHEMA, GOLD_ANALYTICS_SCHEMA,
                       GOLD_DAILY_OHLCV_SCHEMA, SILVER_BARS_SCHEMA)

PART = "part_date"

# layer -> (schema, column the partition date derives from)
LAYERS = {
    "bronze_bars": (BRONZE_BARS_SCHEMA, "timestamp"),
    "bronze_symbols": (BRONZE_SYMBOLS_SCHEMA, None),
    "silver_bars": (SILVER_BARS_SCHEMA, "timestamp"),
    "gold_daily_ohlcv": (GOLD_DAILY_OHLCV_SCHEMA, "trade_date"),
    "gold_analytics": (GOLD_ANALYTICS_SCHEMA, "trade_date"),
}


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_tables(spark: SparkSession, database: str = "barlake", location: str | None = None) -> list[str]:
    """Idempotently create the database and the layer tables (``IF NOT EXISTS``)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    made = []
    for name, (schema, src) in LAYERS.items():
        cols = _ddl(schema) + (f", `{PART}` date" if src else "")
        part = f" PARTITIONED BY (`{PART}`)" if src else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet{part}")
        made.append(f"{database}.{name}")
    return made


def table_exists(spark: SparkSession, name: str) -> bool:
    """First-run vs incremental switch."""
    return spark.catalog.tableExists(name)


def with_partition_date(df: DataFrame, src_col: str) -> DataFrame:
    return df.withColumn(PART, F.to_date(F.col(src_col)))


def create_or_replace(df: DataFrame, name: str, partition_src: str | None = None) -> None:
    """First-run full write of a layer table (overwrite, optionally date-partitioned)."""
    w = (with_partition_date(df, partition_src) if partition_src else df).write.mode("overwrite").format("parquet")
    if partition_src:
        w = w.partitionBy(PART)
    w.saveAsTable(name)


def table_location(spark: SparkSession, name: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return found.data_type


def merge_or_create(df: DataFrame, name: str, keys: Sequence[str], partition_src: str) -> str:
    """The first run writes the whole table, later ones merge into it; returns which of the two it was.

    Only partitions that ``df`` touches are read and rewritten. The table's location is that of its catalog entry, whose list
    of partitions follows the merge. ``keys`` must determine the day of ``partition_src``, and ``df`` must be unique on them.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        create_or_replace(df, name, partition_src)
        return "created"
    columns = [f.name for f in spark.table(name).schema.fields]
    upsert_path(spark, with_partition_date(df, partition_src).select(*columns), table_location(spark, name), keys, PART)
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return "merged"


def write_partitioned(df: DataFrame, path: str, date_col: str, mode: str = "overwrite") -> None:
    """Write date-partitioned parquet; ``REBALANCE`` evens out file sizes per date
    (AQE splits skewed dates instead of producing one giant file)."""
    out = with_partition_date(df, date_col)
    out = out.hint("rebalance", PART)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path))


@contextmanager
def _configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def analyze(spark: SparkSession, name: str, columns: Sequence[str] | None = None, histograms: Sequence[str] = (),
            bins: int = 254) -> DataFrame:
    """Column statistics for the cost-based optimizer; returns the table's details.

    ``columns`` are those that filters and joins use (default: all). ``histograms`` names unevenly spread columns that
    filters use; they get equi-height histograms, by another two scans of these columns. Leave join keys out: with
    histograms on both sides Spark's estimate of a join takes a filtered side for unfiltered.
    """
    which = lambda cols: f"FOR COLUMNS {', '.join(f'`{c}`' for c in cols)}"
    with _configured(spark, {"spark.sql.statistics.histogram.enabled": "false"}):
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {which(columns) if columns else 'FOR ALL COLUMNS'}")
    if histograms:
        with _configured(spark, {"spark.sql.statistics.histogram.enabled": "true",
                                 "spark.sql.statistics.histogram.numBins": str(bins)}):
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {which(histograms)}")
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def column_statistics(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    """What :func:`analyze` stored of numeric columns: nulls, least and greatest value (no data is read).

    One catalog lookup and one row a column; a column without statistics has nulls.
    """
    def stored(column: str) -> DataFrame:
        info = spark.sql(f"DESCRIBE TABLE EXTENDED {name} `{column}`")
        value = lambda k: F.max(F.when(F.col("info_name") == k, F.col("info_value")))
        return info.agg(F.lit(column).alias("column_name"), value("num_nulls").try_cast("bigint").alias("nulls"),
                        value("min").try_cast("double").alias("least"), value("max").try_cast("double").alias("greatest"))

    return reduce(DataFrame.unionByName, [stored(c) for c in columns])


@contextmanager
def cost_based(spark: SparkSession) -> Iterator[None]:
    """Plan the queries of a ``with`` block by the statistics of :func:`analyze`, their join order too.

    Queries are planned when they first run or are explained, so that has to happen inside the block.
    """
    with _configured(spark, {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.planStats.enabled": "true",
                             "spark.sql.cbo.joinReorder.enabled": "true"}):
        yield


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> Iterator[DataFrame]:
    """Keep ``df`` for several queries inside a ``with`` block; what doesn't fit in memory goes to disk."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (for plan assertions and reviews)."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def file_size_report(spark: SparkSession, path: str) -> DataFrame:
    """Data files under ``path`` by size and modification time (file metadata only:
    ``binaryFile`` with the content column pruned reads no file bodies)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path)
            .select("path", "length", "modificationTime")
            .orderBy(F.col("length").desc()))


def partition_files(spark: SparkSession, path: str, partition: str = PART) -> DataFrame:
    """Files, bytes and newest file of each partition below ``path``, from file metadata alone."""
    value = F.regexp_extract("path", f"/{partition}=([^/]*)/", 1)
    return (file_size_report(spark, path).groupBy(value.try_cast("date").alias(partition))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest")))


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str = "symbol", sort_col: str = "trade_date") -> None:
    """Store a gold table bucketed by ``key`` and sorted by ``sort_col`` within buckets.

    Two tables bucketed the same way (daily and analytics with equal ``buckets``) join
    on (symbol, trade_date) without any shuffle, and per-symbol windows over either
    need no exchange either: the hash layout is read from the catalog. The join
    reuses a layout on a subset of its keys only with
    ``spark.sql.requireAllClusterKeysForCoPartition=false``.
    """
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, sort_col)
     .saveAsTable(name))
