"""J5 + A14: pairwise return correlation of a named universe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlation(daily: DataFrame, universe: Sequence[str] | DataFrame, asof=None, days: int | None = 60,
                count_name: str = "observation_count") -> DataFrame:
    """J5 + A14: correlation of daily returns for each pair ``symbol1 < symbol2`` of the universe.

    ``universe`` is a list of symbols or a frame with a ``symbol`` column; the rows are restricted to it and
    to the trailing ``days`` first, then joined with themselves on the date. A pair's sums are
    partial aggregates, so what is shuffled for the result is a row per pair and task.
    ``count_name`` is the number of shared dates; the correlation is NULL where it is undefined (under
    two dates with both returns, or a constant series).
    """
    from .analytics import _asof, trailing
    d = trailing(daily, _asof(daily, asof), days)
    if isinstance(universe, DataFrame):
        d = d.join(universe.select("symbol").distinct(), "symbol", "left_semi")
    else:
        d = d.filter(F.col("symbol").isin(sorted(set(universe))))
    left = d.select("trade_date", F.col("symbol").alias("symbol1"), F.col("daily_return").alias("r1"))
    right = d.select("trade_date", F.col("symbol").alias("symbol2"), F.col("daily_return").alias("r2"))
    both = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    pairs = left.join(right, "trade_date").filter("symbol1 < symbol2").groupBy("symbol1", "symbol2").agg(
        F.covar_pop("r1", "r2").alias("_c"), F.stddev_pop(F.when(both, F.col("r1"))).alias("_s1"),
        F.stddev_pop(F.when(both, F.col("r2"))).alias("_s2"), F.count(F.lit(1)).alias(count_name))
    # corr() itself divides by zero for a constant series under ANSI rules
    c = F.when(F.col("_s1") * F.col("_s2") > 0, F.col("_c") / (F.col("_s1") * F.col("_s2")))
    return pairs.select("symbol1", "symbol2", c.alias("correlation"), count_name).orderBy(F.col("correlation").desc_nulls_last(), "symbol1", "symbol2")
