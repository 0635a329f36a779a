"""Named analytic queries over the gold layer (dashboards, signals, risk, correlation).

Inputs are a gold *daily* frame and, where indicators are needed, a *gold* frame
carrying the daily columns plus ``sma_5/20/50`` and ``volatility`` — either
``with_indicators(daily)`` (no join) or ``join_gold(daily, analytics)`` when both
are stored tables. ``asof`` stands in for the reference's ``CURRENT_DATE()``; by
default it is ``max(trade_date)`` as a scalar subquery (evaluated once, on the
cluster, and pushed into the scan as a runtime filter).

Scale notes
-----------
* Per-symbol windows on the daily table hold at most one row per trading day per
  symbol, so their partitions are bounded by the calendar, not the data volume.
* Top-k queries end in ``orderBy(...).limit(k)`` which plans as
  ``TakeOrderedAndProject`` (per-partition top-k, no global sort).
* The correlation matrix (``correlation.py``) reduces per-partition Gram matrices
  instead of self-joining dates; no pair rows are materialised per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bars import safe_div
from .correlation import correlation  # noqa: F401  (J5/A14, re-exported)
from .indicators import by_symbol

KEYS = ["symbol", "trade_date"]


# ---------------------------------------------------------------- helpers
def latest_date(daily: DataFrame) -> Column:
    """``max(trade_date)`` as a scalar subquery Column."""
    return daily.select(F.max("trade_date")).scalar()


def _asof(daily: DataFrame, asof) -> Column:
    if asof is None:
        return latest_date(daily)
    if isinstance(asof, Column):
        return asof
    return F.lit(str(asof)).cast("timestamp_ntz")


def _days(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} DAYS")


def trailing(df: DataFrame, asof: Column, days: int | None) -> DataFrame:
    """``trade_date >= asof - days`` (``None`` keeps the whole history)."""
    if days is None:
        return df
    return df.filter(F.col("trade_date") >= asof - _days(days))


def on_day(df: DataFrame, asof: Column, days_back: int = 1) -> DataFrame:
    """P12, single-day form: ``trade_date = asof - days_back``."""
    return df.filter(F.col("trade_date") == asof - _days(days_back))


def in_universe(df: DataFrame, universe: Sequence[str] | DataFrame | None) -> DataFrame:
    """A literal list becomes an ``IN`` set; a DataFrame universe a ``left_semi`` join."""
    if universe is None:
        return df
    if isinstance(universe, DataFrame):
        return df.join(universe.select("symbol").distinct(), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(list(universe)))


def join_gold(daily: DataFrame, analytics: DataFrame) -> DataFrame:
    """Daily ⋈ analytics on (symbol, trade_date); both sides keep their own columns."""
    a = analytics.select(*KEYS, "sma_5", "sma_20", "sma_50", "volatility")
    return daily.join(a, KEYS, "inner")


def _top(df: DataFrame, col: str, n: int, descending: bool = True, digits: int | None = None) -> DataFrame:
    """Top ``n`` by ``col`` with (symbol, trade_date) as tie-break.

    ``digits`` ranks a *computed* float on its value rounded to that many decimals, so
    values that are equal in exact arithmetic but differ in the last bit (summation
    order) tie and fall to the deterministic tie-break.
    """
    c = F.col(col) if digits is None else F.round(F.col(col), digits)
    key = c.desc_nulls_last() if descending else c.asc_nulls_first()
    return df.orderBy(key, F.col("symbol").asc(), F.col("trade_date").asc()).limit(n)


def _cnt_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


# ---------------------------------------------------------------- dashboard queries
def market_summary(daily: DataFrame) -> DataFrame:
    d = daily.filter(F.col("trade_date") == latest_date(daily))
    r = F.col("daily_return")
    return d.agg(F.count_distinct("symbol").alias("total_symbols"),
                 F.avg("close").alias("avg_closing_price"),
                 F.sum("volume").alias("total_volume"),
                 F.avg("daily_return").alias("avg_daily_return"),
                 F.avg("price_range").alias("avg_price_range"),
                 _cnt_if(r > 0).alias("gainers"), _cnt_if(r < 0).alias("losers"),
                 _cnt_if(r == 0).alias("unchanged"))


def move_category(r: Column) -> Column:
    """P15."""
    return F.when(r > 0, "Gainer").when(r < 0, "Loser").otherwise("Unchanged")


def top_movers(daily: DataFrame, asof=None, days: int = 7, n: int = 20) -> DataFrame:
    """Latest row per symbol within ``days`` (W4 as a partial ``max_by`` aggregate), top ``n``."""
    a = _asof(daily, asof)
    rec = F.struct("trade_date", "close", "daily_return", "volume")
    latest = (trailing(daily, a, days).groupBy("symbol")
              .agg(F.max_by(rec, "trade_date").alias("r"))
              .select("symbol", "r.*"))
    out = latest.withColumn("category", move_category(F.col("daily_return")))
    return _top(out, "daily_return", n)


def trend_position(close="close") -> Column:
    """P16."""
    c = F.col(close)
    s5, s20, s50 = F.col("sma_5"), F.col("sma_20"), F.col("sma_50")
    return (F.when((c > s5) & (c > s20) & (c > s50), "Above All MAs")
            .when((c < s5) & (c < s20) & (c < s50), "Below All MAs").otherwise("Mixed"))


def ma_trends(gold: DataFrame, asof=None, universe=None, days: int = 30) -> DataFrame:
    a = _asof(gold, asof)
    g = in_universe(trailing(gold, a, days), universe)
    return (g.select("symbol", "trade_date", "close", "sma_5", "sma_20", "sma_50",
                     trend_position().alias("trend_position"), "volatility")
            .orderBy("symbol", "trade_date"))


def volatility_category(v="volatility") -> Column:
    """P17."""
    v = F.col(v)
    return F.when(v < 0.01, "Low").when(v < 0.03, "Medium").otherwise("High")


def vol_heatmap(gold: DataFrame, asof=None, days: int = 30) -> DataFrame:
    a = _asof(gold, asof)
    g = trailing(gold, a, days).filter(F.col("volatility").isNotNull())
    return (g.select("symbol", "trade_date", "volatility", "daily_return",
                     volatility_category().alias("volatility_category"))
            .orderBy("symbol", "trade_date"))


def volume_trends(daily: DataFrame, asof=None, days: int = 30, window_rows: int = 20) -> DataFrame:
    """Rolling average volume over the rows inside the trailing range, and the ratio."""
    a = _asof(daily, asof)
    avg_v = F.avg("volume").over(by_symbol().rowsBetween(-(window_rows - 1), 0))
    d = trailing(daily, a, days).withColumn("avg_volume_20d", avg_v)
    return (d.select("symbol", "trade_date", "volume", "close", "daily_return", "avg_volume_20d",
                     safe_div(F.col("volume"), F.col("avg_volume_20d")).alias("volume_ratio"))
            .orderBy("symbol", "trade_date"))


def volume_category(v: Column, avg: Column) -> Column:
    """P18."""
    return (F.when(v > avg * 2, "High Volume Spike")
            .when(v > avg * 1.5, "Moderate Volume Spike").otherwise("Normal Volume"))


def volume_spikes(daily: DataFrame, asof=None, stats_days: int = 30, days: int = 7,
                  factor: float = 1.5) -> DataFrame:
    """Rows of the last ``days`` above ``factor`` x the symbol's ``stats_days`` average.

    A13 + J4 as one per-symbol window over the trailing rows (at most one row per
    day per symbol): identical to joining a per-symbol stats aggregate, minus the
    second shuffle.
    """
    a = _asof(daily, asof)
    per_sym = Window.partitionBy("symbol")
    d = (trailing(daily, a, stats_days)
         .withColumn("avg_volume_30d", F.avg("volume").over(per_sym)))
    d = trailing(d, a, days).filter(F.col("volume") > F.col("avg_volume_30d") * factor)
    return (d.select("symbol", "trade_date", "volume", "close", "daily_return", "avg_volume_30d",
                     safe_div(F.col("volume"), F.col("avg_volume_30d")).alias("volume_multiple"),
                     volume_category(F.col("volume"), F.col("avg_volume_30d")).alias("volume_category"))
            .orderBy(F.col("volume_multiple").desc(), "symbol", "trade_date"))


def performance(daily: DataFrame, asof=None, days: int = 30) -> DataFrame:
    """start/end price and risk per symbol; one partial aggregate instead of windows + DISTINCT."""
    a = _asof(daily, asof)
    p = trailing(daily, a, days).groupBy("symbol").agg(
        F.min_by("close", "trade_date").alias("start_price"),
        F.max_by("close", "trade_date").alias("end_price"),
        F.avg("daily_return").alias("avg_daily_return"),
        F.stddev_samp("daily_return").alias("return_volatility"),
        F.sum("volume").alias("total_volume"))
    p = p.withColumn("total_return_pct",
                     safe_div(F.col("end_price") - F.col("start_price"), F.col("start_price")))
    return (p.select("symbol", "start_price", "end_price", "total_return_pct", "avg_daily_return",
                     "return_volatility", "total_volume")
            .orderBy(F.col("total_return_pct").desc_nulls_last(), "symbol"))


def sector(daily: DataFrame, universe, asof=None, days: int = 30) -> DataFrame:
    """Universe rows against the universe's average return on the same day.

    The per-date window holds at most one row per universe symbol.
    """
    a = _asof(daily, asof)
    d = in_universe(trailing(daily, a, days), universe)
    w = Window.partitionBy(F.to_date("trade_date"))
    return (d.select("symbol", "trade_date", "close", "daily_return", "volume",
                     F.avg("daily_return").over(w).alias("sector_avg_return"))
            .orderBy(F.col("trade_date").desc(), "symbol"))


def timeseries(daily: DataFrame, universe, asof=None, days: int = 90) -> DataFrame:
    a = _asof(daily, asof)
    d = in_universe(trailing(daily, a, days), universe)
    return (d.select("symbol", "trade_date", "open", "high", "low", "close", "volume",
                     "daily_return", "price_range", "avg_price")
            .orderBy("symbol", "trade_date"))


def _cross(prev_fast, prev_slow, fast, slow, up: bool) -> Column:
    if up:
        return (prev_fast < prev_slow) & (fast > slow)
    return (prev_fast > prev_slow) & (fast < slow)


def crossovers(gold: DataFrame, asof=None, days: int = 60) -> DataFrame:
    """W8 + P19: 5/20 and 50/20 crosses (first matching rule wins)."""
    a = _asof(gold, asof)
    w = by_symbol()
    g = trailing(gold, a, days).select(
        "symbol", "trade_date", "close", "sma_5", "sma_20", "sma_50",
        *[F.lag(f"sma_{n}").over(w).alias(f"prev_sma_{n}") for n in (5, 20, 50)])
    p5, p20, p50 = F.col("prev_sma_5"), F.col("prev_sma_20"), F.col("prev_sma_50")
    s5, s20, s50 = F.col("sma_5"), F.col("sma_20"), F.col("sma_50")
    rules = [(_cross(p5, p20, s5, s20, True), "Bullish Crossover (5/20)"),
             (_cross(p5, p20, s5, s20, False), "Bearish Crossover (5/20)"),
             (_cross(p50, p20, s50, s20, True), "Golden Cross (50/20)"),
             (_cross(p50, p20, s50, s20, False), "Death Cross (50/20)")]
    sig = F.when(rules[0][0], rules[0][1])
    for cond, name in rules[1:]:
        sig = sig.when(cond, name)
    sig = sig.otherwise("No Signal")
    any_rule = rules[0][0]
    for cond, _ in rules[1:]:
        any_rule = any_rule | cond
    return (g.filter(any_rule)
            .select("symbol", "trade_date", "close", "sma_5", "sma_20", "sma_50",
                    sig.alias("signal_type"))
            .orderBy(F.col("trade_date").desc(), "symbol"))


def risk(daily: DataFrame, asof=None, days: int = 30, min_days: int = 20) -> DataFrame:
    a = _asof(daily, asof)
    r = trailing(daily, a, days).groupBy("symbol").agg(
        F.avg("daily_return").alias("avg_return"),
        F.stddev_samp("daily_return").alias("volatility"),
        F.min("daily_return").alias("worst_day"),
        F.max("daily_return").alias("best_day"),
        F.count(F.lit(1)).alias("trading_days"),
        F.avg(safe_div(F.col("price_range"), F.col("close"))).alias("avg_intraday_volatility_pct"))
    return (r.filter(F.col("trading_days") >= min_days)
            .orderBy(F.col("volatility").desc_nulls_last(), "symbol"))


def drawdown(daily: DataFrame, asof=None, days: int = 90) -> DataFrame:
    """Running peak close and drawdown from it."""
    a = _asof(daily, asof)
    peak = F.max("close").over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))
    d = trailing(daily, a, days).select("symbol", "trade_date", "close", peak.alias("peak_price"))
    return (d.withColumn("drawdown_pct",
                         safe_div(F.col("close") - F.col("peak_price"), F.col("peak_price")))
            .orderBy("symbol", "trade_date"))


# ---------------------------------------------------------------- example queries
_DAY_COLS = ["symbol", "trade_date", "close", "daily_return", "volume", "price_range"]


def top_day(daily: DataFrame, asof=None, n: int = 10, best: bool = True) -> DataFrame:
    """Best (or worst) ``n`` symbols on ``asof - 1 day``."""
    a = _asof(daily, asof)
    return _top(on_day(daily, a).select(*_DAY_COLS), "daily_return", n, descending=best)


def return_stats(daily: DataFrame, asof=None, days: int = 30, min_days: int = 20) -> DataFrame:
    """A12."""
    a = _asof(daily, asof)
    r = trailing(daily, a, days).groupBy("symbol").agg(
        F.avg("daily_return").alias("avg_daily_return"),
        F.stddev_samp("daily_return").alias("return_volatility"),
        F.count(F.lit(1)).alias("trading_days"))
    return (r.filter(F.col("trading_days") >= min_days)
            .orderBy(F.col("avg_daily_return").desc_nulls_last(), "symbol"))


def sma_cross(gold: DataFrame, golden: bool = True, asof=None, days: int = 60,
              fast: int = 50, slow: int = 20) -> DataFrame:
    """Golden / death cross of ``sma_fast`` over ``sma_slow`` (the reference: 50 over 20)."""
    a = _asof(gold, asof)
    w = by_symbol()
    f, s = f"sma_{fast}", f"sma_{slow}"
    g = trailing(gold, a, days).select(
        "symbol", "trade_date", "close", "sma_20", "sma_50",
        F.col(f).alias("_f"), F.col(s).alias("_s"),
        F.lag(f).over(w).alias("_pf"), F.lag(s).over(w).alias("_ps"))
    cond = _cross(F.col("_pf"), F.col("_ps"), F.col("_f"), F.col("_s"), golden)
    name = "Golden Cross" if golden else "Death Cross"
    return (g.filter(cond)
            .select("symbol", "trade_date", "close", "sma_20", "sma_50", F.lit(name).alias("signal_type"))
            .orderBy(F.col("trade_date").desc(), "symbol"))


def _above_all(gold: DataFrame) -> DataFrame:
    c = F.col("close")
    return gold.filter((c > F.col("sma_5")) & (c > F.col("sma_20")) & (c > F.col("sma_50")))


def uptrend(gold: DataFrame, asof=None) -> DataFrame:
    a = _asof(gold, asof)
    g = _above_all(on_day(gold, a))
    return (g.select("symbol", "trade_date", "close", "sma_5", "sma_20", "sma_50",
                     F.lit("Strong Uptrend").alias("trend_status"))
            .orderBy(F.col("close").desc(), "symbol"))


def most_volatile(gold: DataFrame, asof=None, days: int = 30, n: int = 20) -> DataFrame:
    a = _asof(gold, asof)
    g = trailing(gold, a, days).filter(F.col("volatility").isNotNull())
    g = g.select("symbol", "trade_date", "close", "volatility", "daily_return", "price_range")
    return _top(g, "volatility", n, digits=9)


def avg_volatility(analytics: DataFrame, asof=None, days: int = 30, min_days: int = 20) -> DataFrame:
    a = _asof(analytics, asof)
    g = trailing(analytics, a, days).filter(F.col("volatility").isNotNull())
    r = g.groupBy("symbol").agg(F.avg("volatility").alias("avg_volatility"),
                                F.max("volatility").alias("max_volatility"),
                                F.min("volatility").alias("min_volatility"),
                                F.count(F.lit(1)).alias("days_with_data"))
    return (r.filter(F.col("days_with_data") >= min_days)
            .orderBy(F.col("avg_volatility").desc_nulls_last(), "symbol"))


def highest_volume(daily: DataFrame, asof=None, n: int = 20) -> DataFrame:
    a = _asof(daily, asof)
    d = on_day(daily, a).select("symbol", "trade_date", "close", "volume", "daily_return", "num_bars")
    return _top(d, "volume", n)


def volume_spike_2x(daily: DataFrame, asof=None, stats_days: int = 30, factor: float = 2.0) -> DataFrame:
    """A13 + J4 in join form: per-symbol stats joined to the day's rows.

    No broadcast hint: the stats side has one row per symbol, which grows with the
    universe, so the planner/AQE decides from measured size (auto-broadcast
    threshold) and falls back to a shuffle join beyond it.
    """
    a = _asof(daily, asof)
    stats = trailing(daily, a, stats_days).groupBy("symbol").agg(
        F.avg("volume").alias("avg_volume"), F.stddev_samp("volume").alias("stddev_volume"))
    d = on_day(daily, a).join(stats, "symbol", "inner")
    d = d.filter(F.col("volume") > F.col("avg_volume") * factor)
    return (d.select("symbol", "trade_date", "close", "volume", "avg_volume",
                     safe_div(F.col("volume"), F.col("avg_volume")).alias("volume_ratio"),
                     "daily_return")
            .orderBy(F.col("volume_ratio").desc(), "symbol"))


def price_range_top(daily: DataFrame, asof=None, days: int = 7, n: int = 20) -> DataFrame:
    """P21 + T2."""
    a = _asof(daily, asof)
    d = trailing(daily, a, days).select(
        "symbol", "trade_date", "open", "high", "low", "close", "price_range",
        safe_div(F.col("price_range"), F.col("close")).alias("range_pct"), "daily_return")
    return _top(d, "price_range", n)


def avg_range(daily: DataFrame, asof=None, days: int = 30, min_days: int = 20) -> DataFrame:
    a = _asof(daily, asof)
    r = trailing(daily, a, days).groupBy("symbol").agg(
        F.avg("price_range").alias("avg_price_range"),
        F.avg(safe_div(F.col("price_range"), F.col("close"))).alias("avg_range_pct"),
        F.max("price_range").alias("max_price_range"),
        F.count(F.lit(1)).alias("trading_days"))
    return (r.filter(F.col("trading_days") >= min_days)
            .orderBy(F.col("avg_range_pct").desc_nulls_last(), "symbol"))


def bullish_setup(gold: DataFrame, asof=None, max_volatility: float = 0.05) -> DataFrame:
    a = _asof(gold, asof)
    g = _above_all(on_day(gold, a)).filter(
        (F.col("sma_5") > F.col("sma_20")) & (F.col("volatility") < max_volatility))
    return (g.select("symbol", "trade_date", "close", "sma_5", "sma_20", "sma_50", "volatility",
                     "daily_return")
            .orderBy(F.col("daily_return").desc_nulls_last(), "symbol"))


def compare_grouped(daily: DataFrame, universe, asof=None, days: int = 30) -> DataFrame:
    """The reference's window-over-GROUP-BY comparison, kept literally.

    Grouping by (symbol, close, daily_return, trade_date) makes every row its own
    group; the windows then run over the grouped rows per symbol.
    """
    a = _asof(daily, asof)
    d = in_universe(trailing(daily, a, days), universe)
    g = d.groupBy("symbol", "close", "daily_return", "trade_date").agg(
        F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"),
        F.sum("daily_return").alias("total_return"), F.avg("daily_return").alias("avg_daily_return"),
        F.stddev_samp("daily_return").alias("return_volatility"),
        F.count(F.lit(1)).alias("trading_days"))
    w = Window.partitionBy("symbol").orderBy("trade_date")
    return (g.select("symbol", "start_date", "end_date",
                     F.first("close").over(w).alias("start_price"),
                     F.last("close").over(w.rowsBetween(Window.unboundedPreceding,
                                                        Window.unboundedFollowing)).alias("end_price"),
                     "total_return", "avg_daily_return", "return_volatility", "trading_days",
                     "trade_date")
            .orderBy("symbol", "trade_date").drop("trade_date"))


def market_stats(daily: DataFrame) -> DataFrame:
    d = daily.filter(F.col("trade_date") == latest_date(daily))
    return d.agg(F.count_distinct("symbol").alias("num_symbols"),
                 F.avg("close").alias("avg_close_price"),
                 F.avg("daily_return").alias("avg_daily_return"),
                 F.avg("volume").alias("avg_volume"),
                 F.avg("price_range").alias("avg_price_range"),
                 F.sum("volume").alias("total_volume"),
                 F.count(F.lit(1)).alias("total_trades"))
