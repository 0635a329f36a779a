"""Bronze -> silver cleaning: null filters, latest-wins dedup, scoring (reference unit cases)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.clean import clean_bronze_to_silver, dedup_latest, drop_null_keys
from barlake.schemas import BRONZE_BARS_SCHEMA

T0 = datetime(2024, 1, 2, 10, 0)
T1 = datetime(2024, 1, 2, 10, 5)
ING = datetime(2024, 1, 2, 12, 0)
LATER = datetime(2024, 1, 2, 13, 0)
RUN = "2024-01-03 00:00:00"


NULLABLE_BRONZE = T.StructType([T.StructField(f.name, f.dataType, True) for f in BRONZE_BARS_SCHEMA])


def bronze(spark, rows):
    return spark.createDataFrame(rows, NULLABLE_BRONZE)


@pytest.fixture()
def six_rows(spark):
    rows = [
        ("AAPL", T0, 150.0, 152.0, 149.0, 151.0, 1000, ING, "20240102"),
        ("AAPL", T1, 151.0, 153.0, 150.0, 152.0, 1100, ING, "20240102"),
        ("MSFT", T0, 370.0, 372.0, 369.0, 371.0, 900, ING, "20240102"),
        ("AAPL", T0, 150.0, 152.0, 149.0, 151.5, 1000, LATER, "20240102"),   # later duplicate wins
        ("GOOG", T0, 140.0, 141.0, 139.0, None, 500, ING, "20240102"),       # null close
        ("AMZN", T0, None, None, None, 180.0, 700, ING, "20240102"),         # null open/high/low
    ]
    return bronze(spark, rows)


def test_clean_keeps_three_rows_and_latest_wins(six_rows):
    out = clean_bronze_to_silver(six_rows, RUN)
    rows = {(r.symbol, r.timestamp): r for r in out.collect()}
    assert len(rows) == 3
    assert rows[("AAPL", T0)].close == 151.5
    assert all(r.quality_score == 1.0 and r.is_valid == 1 for r in rows.values())
    assert str(out.schema["processed_timestamp"].dataType) == "TimestampNTZType()"


def test_nullable_rows(spark):
    rows = [("AAPL", T0, 1.0, 2.0, 0.5, 1.5, 10, ING, "b"),
            ("AAPL", None, 1.0, 2.0, 0.5, 1.5, 10, ING, "b"),
            ("AAPL", T1, 1.0, 2.0, 0.5, None, 10, ING, "b"),
            (None, T0, 1.0, 2.0, 0.5, 1.5, 10, ING, "b")]
    assert clean_bronze_to_silver(bronze(spark, rows), RUN).count() == 1
    assert drop_null_keys(bronze(spark, rows)).count() == 1


def test_bad_prices_scores(spark):
    rows = [("OK", T0, 10.0, 12.0, 9.0, 11.0, 100, ING, "b"),
            ("HL", T0, 10.0, 8.0, 9.0, 11.0, 100, ING, "b"),     # high < low: 3 relations broken
            ("NEG", T0, -1.0, 12.0, 9.0, 11.0, 100, ING, "b")]   # negative open
    out = {r.symbol: r for r in clean_bronze_to_silver(bronze(spark, rows), RUN).collect()}
    assert out["OK"].quality_score == 1.0 and out["OK"].is_valid == 1
    assert out["HL"].quality_score == pytest.approx(0.76) and out["HL"].is_valid == 0
    assert out["NEG"].quality_score == pytest.approx(0.88) and out["NEG"].is_valid == 1


def test_score_boundary_is_valid(spark):
    # 4 consistent / 2 reasonable relations -> exactly 0.8 in IEEE doubles -> valid
    rows = [("B", T0, -1.0, -0.5, -2.0, -1.5, 100, ING, "b")]
    r = clean_bronze_to_silver(bronze(spark, rows), RUN).collect()[0]
    assert r.is_valid == (1 if r.quality_score >= 0.8 else 0)


def test_newest_null_open_removes_key(spark):
    """Dedup runs before the OHLCV null filter, as in the reference."""
    rows = [("AAPL", T0, 1.0, 2.0, 0.5, 1.5, 10, ING, "b"),
            ("AAPL", T0, None, 2.0, 0.5, 1.5, 10, LATER, "b")]
    assert clean_bronze_to_silver(bronze(spark, rows), RUN).count() == 0


def test_dedup_is_partial_aggregate(spark, six_rows):
    plan = dedup_latest(six_rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_dedup_matches_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(2000).select(
        (F.col("id") % 37).cast("string").alias("symbol"),
        F.timestamp_seconds(F.col("id") % 11).cast("timestamp_ntz").alias("timestamp"),
        F.rand(1).alias("close"),
        F.timestamp_seconds(F.col("id") * 7 % 1000).cast("timestamp_ntz").alias("ingestion_timestamp"),
        (F.col("id") % 3).cast("string").alias("batch_id"))
    w = Window.partitionBy("symbol", "timestamp").orderBy(F.col("ingestion_timestamp").desc(),
                                                          F.col("batch_id").desc(), F.col("close").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    got = dedup_latest(df)
    assert sorted(got.collect()) == sorted(ref.collect())
