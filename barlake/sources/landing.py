"""Landing zone (raw JSON bars), symbol registry and provider-frame normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import ts_lit
from ..schemas import BRONZE_BARS_SCHEMA, BRONZE_SYMBOLS_SCHEMA, RAW_BAR_SCHEMA, conform

BATCH_FROM_FILE = r"bars_(\d{8})\.json"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def write_landing(bronze_like: DataFrame, path: str) -> None:
    """Raw bars as JSON lines, one directory per ``batch_id``.

    Dynamic partition overwrite makes re-collecting a day idempotent and leaves
    other days untouched; every executor writes its own part files (nothing is
    funnelled through the driver).
    """
    raw = bronze_like.select(
        "symbol", F.date_format("timestamp", TS_FORMAT).alias("timestamp"),
        "open", "high", "low", "close", "volume", "batch_id")
    (raw.hint("rebalance", "batch_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").json(path))


def read_bars_batch(spark: SparkSession, path: str, array_files: bool = False) -> DataFrame:
    """Batch read of raw bars with an explicit schema.

    ``array_files=True`` reads pretty-printed JSON *array* files (``multiLine``);
    otherwise JSON-lines as written by :func:`write_landing`.
    """
    r = spark.read.schema(RAW_BAR_SCHEMA)
    if array_files:
        r = r.option("multiLine", True).option("pathGlobFilter", "bars_*.json")
    return r.json(path)


def to_bronze(raw: DataFrame, ingestion_ts=None, batch_col: Column | None = None,
              carried: dict[str, Column] | None = None) -> DataFrame:
    """Parse the timestamp, stamp ingestion time, derive ``batch_id``, cast.

    ``batch_id`` comes from ``batch_col`` when given (partition column of the
    landing layout), else from the source file name ``bars_YYYYMMDD.json``. ``carried`` names further columns to keep.
    """
    if batch_col is None:
        batch_col = F.regexp_extract(F.col("_metadata.file_path"), BATCH_FROM_FILE, 1)
    df = raw.withColumns({
        "timestamp": F.coalesce(F.try_to_timestamp(F.col("timestamp"), F.lit(TS_FORMAT)),
                                F.try_to_timestamp(F.col("timestamp"))).cast("timestamp_ntz"),
        "ingestion_timestamp": ts_lit(ingestion_ts),
        "batch_id": batch_col.cast("string"),
        **(carried or {}),
    })
    kept = T.StructType([*BRONZE_BARS_SCHEMA.fields, *[df.schema[c] for c in carried or ()]])
    return conform(df, kept)


def symbols_registry(symbols: DataFrame, source: str, run_ts=None, active: bool = True) -> DataFrame:
    """Distinct symbols as a registry conforming to the bronze symbols schema."""
    s = symbols.select("symbol").filter(F.col("symbol").isNotNull()).distinct()
    return conform(s, BRONZE_SYMBOLS_SCHEMA, extra={
        "source": F.lit(source), "ingestion_timestamp": ts_lit(run_ts),
        "is_active": F.lit(1 if active else 0)})


def write_symbols(registry: DataFrame, path: str) -> None:
    """Store the registry, one partition per day of ingestion and source; a source's day written again is replaced."""
    dated = registry.withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
    keys = ["ingestion_date", "source"]
    (dated.hint("rebalance", *keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """The stored registry, each source as of its own last day of ingestion (a null source counts as one)."""
    # a stated schema: partition values such as source=007 stay strings
    stored = spark.read.schema(T.StructType([*BRONZE_SYMBOLS_SCHEMA.fields, T.StructField("ingestion_date", T.DateType())])
                               ).parquet(path)
    last = stored.groupBy(F.col("source").alias("last_source")).agg(F.max("ingestion_date").alias("last_date"))
    current = stored.join(last, F.col("source").eqNullSafe(F.col("last_source")) & (F.col("ingestion_date") == F.col("last_date")))
    return conform(current, BRONZE_SYMBOLS_SCHEMA)


PROVIDER_COLS = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume"}


def normalize_bars(frame: DataFrame, symbol: str | Column, ts_col: str = "Datetime") -> DataFrame:
    """Provider columns -> canonical bar; missing/NaN prices -> 0.0, volume -> 0."""
    sym = F.lit(symbol) if isinstance(symbol, str) else symbol
    cols = [sym.alias("symbol"), F.col(ts_col).cast("timestamp_ntz").alias("timestamp")]
    for src, dst in PROVIDER_COLS.items():
        c = F.col(src)
        if dst == "volume":
            cols.append(F.coalesce(F.nanvl(c.cast("double"), F.lit(None)).cast("bigint"), F.lit(0))
                        .cast("bigint").alias(dst))
        else:
            cols.append(F.coalesce(F.nanvl(c.cast("double"), F.lit(None)), F.lit(0.0)).alias(dst))
    return frame.select(*cols)


def session_hours(df: DataFrame, open_hm: str = "09:30", close_hm: str = "16:00",
                  ts_col: str = "timestamp", tz: str | None = None) -> DataFrame:
    """P25: bars inside the trading session [open, close) by minutes of day.

    ``tz`` converts UTC wall time to the exchange zone first (``from_utc_timestamp``).
    """
    ts = F.col(ts_col)
    if tz:
        ts = F.from_utc_timestamp(ts.cast("timestamp"), tz)
    mins = F.hour(ts) * 60 + F.minute(ts)
    oh, om = map(int, open_hm.split(":"))
    ch, cm = map(int, close_hm.split(":"))
    return df.filter((mins >= oh * 60 + om) & (mins < ch * 60 + cm))
