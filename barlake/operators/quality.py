"""Data-quality reports (A3-A11, A16, J9, P8) as DataFrames, each one pass per layer.

The reference runs one ``collect`` per check and prints; here every report is a
lazy DataFrame of conditional aggregates (partial + final, one shuffle of a single
row per partition), unpivoted with ``stack`` into a long (layer, metric, value) form
where a layer-independent shape helps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def _stack(one_row: DataFrame, layer: str, names: list[str], key: str, val: str) -> DataFrame:
    body = ", ".join(f"'{n}', `{n}`" for n in names)
    return one_row.selectExpr(f"'{layer}' AS layer", f"stack({len(names)}, {body}) AS ({key}, {val})")


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


# Which columns each layer's null report covers.
NULL_COLUMNS = {
    "bronze": ["symbol", "timestamp", "close"],
    "silver": ["symbol", "timestamp", "close", "open", "high", "low", "volume"],
    "daily": ["symbol", "trade_date", "close", "daily_return"],
}


def null_report(df: DataFrame, layer: str) -> DataFrame:
    """A3: null counts per column ('' counts as a null symbol)."""
    cols = NULL_COLUMNS[layer]
    one = df.agg(*[_cnt(_blank(c) if c == "symbol" else F.col(c).isNull()).alias(c) for c in cols])
    return _stack(one, layer, cols, "column_name", "null_count")


def range_report(bronze: DataFrame) -> DataFrame:
    """A4: min/max of timestamp, close and volume."""
    return bronze.agg(F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp"),
                      F.min("close").alias("min_close"), F.max("close").alias("max_close"),
                      F.min("volume").alias("min_volume"), F.max("volume").alias("max_volume"))


def _day(c: str) -> Column:
    return F.date_trunc("day", F.col(c)).cast("timestamp_ntz")


def completeness_profile(df: DataFrame, ts_col: str, batch_col: str | None = None, bars_col: str | None = None) -> DataFrame:
    """A5, first level: (day, symbol, batch, bars, counted), a row for each combination that occurs.

    Profiles merge: those of new rows are added to stored ones (:func:`store_profile`), whose rows aren't read again.
    """
    day = _day(ts_col) if ts_col != "trade_date" else F.col(ts_col)
    batch = F.col(batch_col).cast("string") if batch_col else F.lit(None).cast("string")
    bars = F.col(bars_col).cast("bigint") if bars_col else F.lit(None).cast("bigint")
    return df.groupBy(day.alias("day"), "symbol", batch.alias("batch")).agg(
        F.sum(bars).alias("bars"), F.count(bars).alias("counted"))


def store_profile(profile: DataFrame, path: str) -> None:
    """Keep a profile by day; the days that it has are replaced, others stay as they are."""
    (profile.withColumn("part_date", F.to_date("day")).hint("rebalance", "part_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("part_date").parquet(path))


def completeness_of(profile: DataFrame, layer: str, batches: bool = False) -> DataFrame:
    """A5, second level: the exact distinct counts of a layer from its profile (or the profiles of all its days)."""
    kinds = {"s": F.col("symbol"), "d": F.col("day").cast("string")} | ({"b": F.col("batch")} if batches else {})
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("value")) for k, c in kinds.items()]))
    # bars ride on the rows of one kind; a value's rows meet before anything is counted
    mine = lambda c: F.sum(F.when(F.col("x.kind") == "s", F.col(c))).alias(c)
    values = profile.select(each.alias("x"), "bars", "counted").groupBy("x.kind", "x.value").agg(mine("bars"), mine("counted"))
    n = lambda k: F.count_if((F.col("kind") == k) & F.col("value").isNotNull())
    none = F.lit(None)
    return values.agg(n("s").alias("unique_symbols"), n("d").alias("unique_dates"), n("b").alias("unique_batches"),
                      F.try_divide(F.sum("bars").cast("double"), F.sum("counted")).alias("avg_bars_per_day")).select(
        F.lit(layer).alias("layer"), "unique_symbols", "unique_dates",
        (F.col("unique_batches") if batches else none.cast("bigint")).alias("unique_batches"), "avg_bars_per_day")


def completeness(df: DataFrame, layer: str, ts_col: str, batch_col: str | None = None,
                 bars_col: str | None = None, approx: bool = False) -> DataFrame:
    """A5: distinct symbols / batches / days and average bars per day for one layer.

    Exact counts go by a profile, grouped once. ``approx=True`` takes HyperLogLog sketches
    (``approx_count_distinct``) instead, which merge map-side.
    """
    if not approx:
        return completeness_of(completeness_profile(df, ts_col, batch_col, bars_col), layer, batch_col is not None)
    cd = F.approx_count_distinct
    day = _day(ts_col) if ts_col != "trade_date" else F.col(ts_col)
    aggs = [cd("symbol").cast("bigint").alias("unique_symbols"), cd(day).cast("bigint").alias("unique_dates"),
            (cd(batch_col).cast("bigint") if batch_col else F.lit(None).cast("bigint")).alias("unique_batches"),
            (F.avg(bars_col) if bars_col else F.lit(None).cast("double")).alias("avg_bars_per_day")]
    return df.agg(*aggs).select(F.lit(layer).alias("layer"), "*")

def quality_stats(silver: DataFrame) -> DataFrame:
    """Score statistics."""
    return silver.agg(F.min("quality_score").alias("min_quality"), F.max("quality_score").alias("max_quality"),
                      F.avg("quality_score").alias("avg_quality"),
                      F.stddev_samp("quality_score").alias("stddev_quality"))


def batch_metrics(silver: DataFrame) -> DataFrame:
    """A6 (batch form): rows, valid rows, max/avg score of one processed batch."""
    return silver.agg(F.count(F.lit(1)).alias("records"), _cnt(F.col("is_valid") == 1).alias("valid_records"),
                      F.max("quality_score").alias("max_quality"), F.avg("quality_score").alias("avg_quality"))


def validity_distribution(silver: DataFrame) -> DataFrame:
    """Rows per ``is_valid`` with their share of all rows (percent)."""
    g = silver.groupBy("is_valid").agg(F.count(F.lit(1)).alias("records"))
    total = F.sum("records").over(Window.partitionBy())   # over <= 2 grouped rows
    return g.withColumn("pct", F.try_divide(F.col("records") * 100.0, total))


# Consistency rules of the quality notebook, by layer.
SILVER_RULES = {
    "high_lt_low": "high < low", "high_lt_close": "high < close", "high_lt_open": "high < open",
    "low_gt_close": "low > close", "low_gt_open": "low > open", "non_positive_close": "close <= 0",
    "negative_volume": "volume < 0",
}
DAILY_RULES = {
    "high_lt_low": "high < low", "high_lt_close": "high < close", "high_lt_open": "high < open",
    "low_gt_close": "low > close", "invalid_num_bars": "num_bars <= 0",
}


def consistency_violations(df: DataFrame, layer: str, rules: dict[str, str]) -> DataFrame:
    """Rows violating each rule."""
    one = df.agg(*[_cnt(F.expr(r)).alias(n) for n, r in rules.items()])
    return _stack(one, layer, list(rules), "rule", "violations")


INDICATORS = ["sma_5", "sma_20", "sma_50", "volatility"]


def indicator_coverage(analytics: DataFrame) -> DataFrame:
    """Non-null count and percent per indicator."""
    one = analytics.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in INDICATORS])
    body = ", ".join(f"'{c}', `{c}`" for c in INDICATORS)
    return one.selectExpr(f"stack({len(INDICATORS)}, {body}) AS (indicator, non_null)", "_n").select(
        "indicator", "non_null", F.try_divide(F.col("non_null") * 100.0, F.col("_n")).alias("pct"))


def indicator_stats(analytics: DataFrame) -> DataFrame:
    """A10."""
    return analytics.agg(*[F.avg(c).alias(f"avg_{c}") for c in INDICATORS])


def layer_date_ranges(bronze: DataFrame, silver: DataFrame, daily: DataFrame) -> DataFrame:
    """min/max day per layer, unioned."""
    parts = [bronze.agg(F.min(_day("timestamp")).alias("min_date"), F.max(_day("timestamp")).alias("max_date")),
             silver.agg(F.min(_day("timestamp")).alias("min_date"), F.max(_day("timestamp")).alias("max_date")),
             daily.agg(F.min("trade_date").alias("min_date"), F.max("trade_date").alias("max_date"))]
    named = [p.select(F.lit(n).alias("layer"), "*") for n, p in zip(("bronze", "silver", "gold"), parts)]
    return reduce(DataFrame.unionByName, named)


def symbol_lineage_gaps(bronze: DataFrame, silver: DataFrame, daily: DataFrame) -> DataFrame:
    """J9 + U2: symbols present in one layer but missing from the next (anti joins on
    distinct symbol sets; nothing is collected to the driver)."""
    b, s, g = (x.select("symbol").distinct() for x in (bronze, silver, daily))
    return (b.join(s, "symbol", "left_anti").select(F.lit("bronze_not_silver").alias("gap"), "symbol")
            .unionByName(s.join(g, "symbol", "left_anti")
                         .select(F.lit("silver_not_gold").alias("gap"), "symbol")))


def expectation_counts(df: DataFrame, dataset: str, preds: dict[str, str]) -> DataFrame:
    """passed/failed/input rows and pass rate per named expectation, one pass.

    A NULL predicate counts as failed (as a dropping expectation treats it).
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [_cnt(F.coalesce(F.expr(p), F.lit(False))).alias(n) for n, p in preds.items()]
    one = df.agg(*aggs)
    body = ", ".join(f"'{n}', `{n}`" for n in preds)
    return (one.selectExpr(f"'{dataset}' AS dataset", f"stack({len(preds)}, {body}) AS (expectation, passed_records)",
                           "_n AS input_records")
            .select("expectation", "dataset", "passed_records",
                    (F.col("input_records") - F.col("passed_records")).alias("failed_records"),
                    "input_records",
                    F.try_divide(F.col("passed_records") * 100.0, F.col("input_records"))
                    .alias("pass_rate_pct")))


def observe_expectations(df: DataFrame, name: str, preds: dict[str, str]):
    """ST5: attach expectation failure counts as observed metrics (works on streams).

    Returns ``(df_with_observation, Observation)``; for a stream the second is None and each batch's metrics are
    in ``query.lastProgress.observedMetrics[name]`` and with the query listeners.
    """
    from pyspark.sql import Observation
    metrics = [_cnt(~F.coalesce(F.expr(p), F.lit(False))).alias(f"failed_{n}") for n, p in preds.items()]
    if df.isStreaming:
        return df.observe(name, F.count(F.lit(1)).alias("input_records"), *metrics), None
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("input_records"), *metrics), obs
