"""ST5: expectation results over time, from the metrics that streams observe.

A listener appends what each micro-batch observed under a name to a parquet table: a row for each expectation and batch, in
a folder of the query and batch, so a progress event that is told twice is stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("query string, batch long, dataset string, expectation string, passed_records long, failed_records long, "
          "input_records long, observed_at string")


class ExpectationLog(StreamingQueryListener):
    """Stores the observed expectations of every stream of ``spark`` under ``path``, for metrics named in ``datasets``.

    ``datasets`` maps names given to ``observe_expectations`` to the datasets they are about.
    """

    def __init__(self, spark: SparkSession, path: str, datasets: dict[str, str]):
        self.spark, self.path, self.datasets = spark, path, datasets

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        rows = []
        for name, seen in p.observedMetrics.items():
            if name in self.datasets and seen["input_records"]:
                rows += [(str(p.id), p.batchId, self.datasets[name], k.removeprefix("failed_"), seen["input_records"] - n, n,
                          seen["input_records"], p.timestamp)
                         for k, n in seen.asDict().items() if k.startswith("failed_")]
        if rows:
            (self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("query", "batch").parquet(self.path))


def expectation_history(spark: SparkSession, path: str) -> DataFrame:
    """All stored results, a row for each batch and expectation, with the pass rate."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows.withColumn("pass_rate_pct", F.try_divide(F.col("passed_records") * 100.0, F.col("input_records")))
