"""Join helpers: dimension joins with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def planned_bytes(df: DataFrame) -> int:
    """The planner's own estimate of a frame's size; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_bounded(dim: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """Hint a broadcast where the planner's size estimate is within ``max_bytes``.

    Beyond it the plain frame is returned and the planner and AQE choose from measured sizes. No job runs
    while the query is built.
    """
    return F.broadcast(dim) if planned_bytes(dim) <= max_bytes else dim


def enrich_suppliers(daily: DataFrame, supplier: DataFrame, nation: DataFrame,
                     max_dim_bytes: int = 8 << 20) -> DataFrame:
    """Daily rows with supplier and nation names.

    ``supplier`` grows with the data, so it is joined without a hint; ``nation`` is
    a fixed 25-row dimension and is broadcast behind the size check.
    """
    sup = supplier.select(F.col("s_suppkey").cast("string").alias("symbol"), "s_name", "s_nationkey")
    nat = broadcast_if_bounded(nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), max_dim_bytes)
    return (daily.join(sup, "symbol", "inner").join(nat, "s_nationkey", "inner")
            .select("symbol", "trade_date", "close", "s_name", "n_name"))
