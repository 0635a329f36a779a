"""Bronze -> silver: null filters, latest-wins dedup, conform, quality scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bars as B
from ..schemas import SILVER_BARS_SCHEMA, conform

BAR_KEYS = ("symbol", "timestamp")
LATEST_ORDER = ("ingestion_timestamp", "batch_id")


def ts_lit(ts) -> Column:
    """A run/as-of stamp as a timestamp_ntz Column (str, datetime or Column)."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    if ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(str(ts)).cast("timestamp_ntz")


def drop_null_keys(df: DataFrame) -> DataFrame:
    """Keep rows whose symbol, timestamp and close are present."""
    return df.filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull()
                     & F.col("close").isNotNull())


def dedup_latest(df: DataFrame, keys: Sequence[str] = BAR_KEYS,
                 order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """One row per key, the one with the greatest ``order`` (latest ingestion wins).

    Expressed as ``groupBy(keys).agg(max(struct(order..., rest...)))`` rather than a
    ``row_number`` window: the aggregate runs partially on the map side, so a key
    with millions of re-ingested copies collapses to one row per input partition
    before the shuffle instead of landing whole in a single window task. The rest
    of the row is the final tie-break, which makes the choice deterministic.
    """
    keys, order = list(keys), [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_w")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + rest]).select(*df.columns)


def drop_null_ohlcv(df: DataFrame, drop_nan: bool = False) -> DataFrame:
    """Drop rows with a null open/high/low/volume (runs *after* dedup, as in the reference)."""
    cond = (F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull()
            & F.col("volume").isNotNull())
    if drop_nan:
        cond = cond & ~(F.isnan("open") | F.isnan("high") | F.isnan("low") | F.isnan("close"))
    return df.filter(cond)


def add_quality(df: DataFrame) -> DataFrame:
    """P5 + P6: ``quality_score`` and ``is_valid``."""
    return df.withColumn("quality_score", B.quality_score()).withColumn("is_valid", B.is_valid())


def clean_bronze_to_silver(bronze: DataFrame, run_ts=None, drop_nan: bool = False) -> DataFrame:
    """P1 -> W1 -> P2 -> P3 -> P5/P6. ``run_ts`` becomes ``processed_timestamp``."""
    df = drop_null_ohlcv(dedup_latest(drop_null_keys(bronze)), drop_nan=drop_nan)
    df = df.select(*[c for c in df.columns if c in ("symbol", "timestamp", "open", "high",
                                                      "low", "close", "volume")])
    df = add_quality(df.withColumn("processed_timestamp", ts_lit(run_ts)))
    return conform(df, SILVER_BARS_SCHEMA)


def expect_or_drop(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Keep only rows passing every named predicate (NULL counts as failing)."""
    for pred in predicates.values():
        df = df.filter(F.coalesce(pred, F.lit(False)))
    return df


# The reference pipeline's expectation predicates, by layer.
BRONZE_DROP_EXPECTATIONS = {
    "valid_symbol": "symbol IS NOT NULL AND symbol != ''",
    "valid_timestamp": "timestamp IS NOT NULL",
}
SILVER_WARN_EXPECTATIONS = {
    "valid_ohlcv": "open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL "
                   "AND volume IS NOT NULL",
    "valid_prices": "open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume >= 0",
    "price_consistency": "high >= low AND high >= close AND high >= open AND low <= close "
                         "AND low <= open",
}
DAILY_WARN_EXPECTATIONS = {
    "valid_daily_data": "open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume >= 0",
    "daily_price_consistency": "high >= low AND high >= close AND high >= open AND low <= close "
                               "AND low <= open",
}


def expectations(sql: dict[str, str]) -> dict[str, Column]:
    return {k: F.expr(v) for k, v in sql.items()}
