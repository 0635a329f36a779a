"""Calendar operators over DataFrames (C4-C6) and the missing-trading-day report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as C


def _date(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    return F.lit(str(x)).cast("date")


def calendar_frame(spark, start, end, observe_saturday_new_year: bool = False) -> DataFrame:
    """One row per day in [start, end] with weekday/holiday/trading flags.

    Its size is the number of days in the span (≈ 365 per year), a bound fixed by
    the arguments, so it is safe to broadcast into joins with fact tables.
    """
    days = spark.range(1).select(F.explode(F.sequence(_date(start), _date(end))).alias("date"))
    days = days.repartition("date")     # the rules below run in all tasks
    return days.select(
        "date",
        F.weekday("date").alias("weekday"),
        C.is_holiday("date", observe_saturday_new_year).alias("is_holiday"),
        C.is_trading_day("date", observe_saturday_new_year).alias("is_trading_day"))


def trading_calendar(spark, start, end, observe_saturday_new_year: bool = False) -> DataFrame:
    """Calendar over [start, end] with ``last_trading_day`` and ``target_day`` per date.

    Holiday rules are evaluated once per day. Each trading day then serves the 14 days after it, and a day's last
    trading day is the greatest that serves it (15 days back where none does); the target day looks that up.
    """
    s = _date(start)
    # the first target day looks up at most 18 days back, and that day's trading days 14 more
    cal = calendar_frame(spark, F.date_sub(s, 40), end, observe_saturday_new_year)
    served = cal.filter("is_trading_day").select(
        F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", C.MAX_DAYS_BACK))).alias("_for"), "date")
    served = served.groupBy("_for").agg(F.max("date").alias("_ltd"))
    cal = cal.join(served, F.col("date") == F.col("_for"), "left").withColumn(
        "last_trading_day", F.coalesce("_ltd", F.date_sub("date", C.MAX_DAYS_BACK + 1))).drop("_for", "_ltd")
    prev = served.select(F.col("_for").alias("_d"), F.col("_ltd").alias("_ltd2"))
    cal = (cal.join(prev, F.date_sub(F.col("last_trading_day"), 3) == F.col("_d"), "left")
           .withColumn("target_day", F.when(F.col("last_trading_day") >= F.date_sub("date", 2),
                                            F.col("_ltd2"))
                       .otherwise(F.col("last_trading_day")))
           .drop("_d", "_ltd2"))
    return cal.filter(F.col("date") >= s)


def with_calendar_flags(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """Holiday / trading-day / last-trading-day / target-day columns for every row.

    The calendar over [start, end] — by default the data's own date span (scalar
    subqueries, no driver round-trip) — is joined on the date; the planner picks the join
    from the calendar's measured size.
    """
    d = F.to_date(F.col(date_col))
    if start is None or end is None:
        span = df.select(d.alias("_d"))
        start = span.select(F.min("_d")).scalar() if start is None else start
        end = span.select(F.max("_d")).scalar() if end is None else end
    cal = trading_calendar(df.sparkSession, start, end)
    cal = cal.withColumnRenamed("date", "_cal_date")
    return (df.join(cal, d == F.col("_cal_date"), "left")
            .drop("_cal_date", "weekday"))


def missing_days(daily: DataFrame, start=None, end=None, weekdays_only: bool = True,
                 trading_days_only: bool = False) -> DataFrame:
    """C6 + J6: expected days in [start, end] (default: the data's first to last day) per symbol without a row.

    Instead of materialising the symbol x calendar grid and anti-joining it, each
    symbol's present days are sorted once and only the *gaps* between consecutive
    days (plus the leading/trailing gap, via two sentinel days) are expanded with
    ``sequence``. Work and output are proportional to rows + missing days; the
    per-symbol window holds at most one row per calendar day.
    """
    span = daily.select(F.to_date("trade_date").alias("d"))
    s = span.select(F.min("d")).scalar() if start is None else _date(start)
    e = span.select(F.max("d")).scalar() if end is None else _date(end)
    present = (daily.select("symbol", F.to_date("trade_date").alias("d"))
               .filter((F.col("d") >= s) & (F.col("d") <= e)))
    sentinels = (daily.select("symbol").distinct()
                 .select("symbol", F.explode(F.array(F.date_sub(s, 1), F.date_add(e, 1))).alias("d")))
    pts = present.unionByName(sentinels).distinct()
    w = Window.partitionBy("symbol").orderBy("d")
    gaps = (pts.withColumn("prev", F.lag("d").over(w))
            .filter(F.datediff("d", "prev") > 1))
    out = gaps.select("symbol", F.explode(F.sequence(F.date_add("prev", 1), F.date_sub("d", 1)))
                      .alias("expected_date"))
    if weekdays_only:
        out = out.filter(F.weekday("expected_date") < 5)
    if trading_days_only:
        # holiday-aware: keep exchange trading days only (calendar evaluated once per day)
        out = (with_calendar_flags(out, "expected_date", start=s, end=e)
               .filter("is_trading_day").select("symbol", "expected_date"))
    return (out.withColumn("status", F.lit("Missing"))
            .orderBy("symbol", "expected_date"))
