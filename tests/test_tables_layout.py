"""Catalog/layout utilities, request validation, landing round trip, observed expectations."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barlake.sources import tables as TB
from barlake.sources.requests import bar_request


def test_bar_request_validation():
    r = bar_request(["AAPL"], datetime(2024, 1, 2), datetime(2024, 1, 3), "7m")
    assert r.interval == "1d"
    with pytest.raises(ValueError):
        bar_request([], datetime(2024, 1, 2), datetime(2024, 1, 3))
    with pytest.raises(ValueError):
        bar_request("", datetime(2024, 1, 2), datetime(2024, 1, 3))
    with pytest.raises(ValueError):
        bar_request("AAPL", datetime(2024, 1, 3), datetime(2024, 1, 3))


def test_ensure_tables_idempotent_and_exists(spark, tmp_dir):
    db = "barlake_t"
    made = TB.ensure_tables(spark, db, location=f"{tmp_dir}/wh")
    assert TB.ensure_tables(spark, db, location=f"{tmp_dir}/wh") == made
    assert all(TB.table_exists(spark, t) for t in made)
    assert not TB.table_exists(spark, f"{db}.nope")


def test_create_or_replace_partitioned_and_pruned(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS barlake_c LOCATION '{tmp_dir}/wc'")
    df = spark.createDataFrame([("A", datetime(2024, 1, d), float(d)) for d in range(1, 6)],
                               "symbol string, trade_date timestamp_ntz, close double")
    TB.create_or_replace(df, "barlake_c.daily", partition_src="trade_date")
    TB.create_or_replace(df, "barlake_c.daily", partition_src="trade_date")   # replace, not append
    t = spark.table("barlake_c.daily")
    assert t.count() == 5
    q = t.filter(F.col(TB.PART) == F.lit("2024-01-03").cast("date"))
    assert "PartitionFilters: [isnotnull(part_date" in TB.explain_text(q) or "PartitionFilters" in TB.explain_text(q)
    details = TB.analyze(spark, "barlake_c.daily").collect()
    assert any(r.col_name == "Statistics" for r in details)


def test_write_partitioned_and_file_report(spark, tmp_dir):
    df = spark.createDataFrame([("A", datetime(2024, 1, d), float(d)) for d in range(1, 4)],
                               "symbol string, trade_date timestamp_ntz, close double")
    TB.write_partitioned(df, f"{tmp_dir}/p", "trade_date")
    parts = spark.read.parquet(f"{tmp_dir}/p")
    assert parts.select(TB.PART).distinct().count() == 3
    rep = TB.file_size_report(spark, f"{tmp_dir}/p").collect()
    assert len(rep) >= 3 and all(r.length > 0 for r in rep)


def test_landing_roundtrip_idempotent(spark, tmp_dir):
    from barlake.sources.landing import read_bars_batch, to_bronze, write_landing
    rows = [("AAPL", datetime(2024, 1, 2, 10), 1.0, 2.0, 0.5, 1.5, 10, "20240102"),
            ("MSFT", datetime(2024, 1, 3, 10), 3.0, 4.0, 2.5, 3.5, 20, "20240103")]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, high double, "
                                     "low double, close double, volume long, batch_id string")
    write_landing(df, f"{tmp_dir}/land")
    write_landing(df.filter("batch_id = '20240102'"), f"{tmp_dir}/land")   # re-collect one day
    raw = read_bars_batch(spark, f"{tmp_dir}/land")
    b = to_bronze(raw, "2024-01-04 00:00:00", batch_col=F.col("batch_id")).collect()
    assert sorted((r.symbol, r.batch_id, r.timestamp) for r in b) == [
        ("AAPL", "20240102", datetime(2024, 1, 2, 10)), ("MSFT", "20240103", datetime(2024, 1, 3, 10))]


def test_observe_expectations(spark):
    from barlake.operators.clean import SILVER_WARN_EXPECTATIONS
    from barlake.operators.quality import observe_expectations
    df = spark.createDataFrame([(1.0, 2.0, 0.5, 1.5, 10), (1.0, 0.4, 0.5, 1.5, 10)],
                               "open double, high double, low double, close double, volume long")
    observed, obs = observe_expectations(df, "silver", SILVER_WARN_EXPECTATIONS)
    observed.collect()
    m = obs.get
    assert m["input_records"] == 2 and m["failed_price_consistency"] == 1 and m["failed_valid_ohlcv"] == 0


def test_processing_time_trigger(spark, tmp_dir):
    """ST2: a service-style trigger keeps running until stopped."""
    import os
    import time
    from barlake.streaming.bronze import start_bronze_stream
    os.makedirs(f"{tmp_dir}/l/batch_id=20240102")
    with open(f"{tmp_dir}/l/batch_id=20240102/a.json", "w") as f:
        f.write('{"symbol":"AAPL","timestamp":"2024-01-02T10:00:00","open":1.0,"high":2.0,"low":0.5,'
                '"close":1.5,"volume":10}\n')
    (q,) = start_bronze_stream(spark, f"{tmp_dir}/l", f"{tmp_dir}/b", f"{tmp_dir}/c", "1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    time.sleep(0.1)
    assert spark.read.parquet(f"{tmp_dir}/b").count() == 1


def test_reports_on_empty_layers(spark):
    """Percentages of empty inputs are NULL, not an ANSI divide-by-zero error."""
    from barlake.operators.clean import SILVER_WARN_EXPECTATIONS
    from barlake.operators.quality import expectation_counts, indicator_coverage
    from barlake.schemas import GOLD_ANALYTICS_SCHEMA, SILVER_BARS_SCHEMA
    empty_s = spark.createDataFrame([], SILVER_BARS_SCHEMA)
    rows = expectation_counts(empty_s, "silver", SILVER_WARN_EXPECTATIONS).collect()
    assert all(r.input_records == 0 for r in rows)
    cov = indicator_coverage(spark.createDataFrame([], GOLD_ANALYTICS_SCHEMA)).collect()
    assert all(r.pct is None for r in cov)


def test_bucketed_gold_join_is_shuffle_free(spark, tmp_dir):
    from barlake.operators.analytics import join_gold
    from barlake.operators.indicators import indicators
    spark.sql(f"CREATE DATABASE IF NOT EXISTS barlake_b LOCATION '{tmp_dir}/wb'")
    daily = spark.createDataFrame(
        [(f"S{i % 7}", datetime(2024, 1, 1 + i // 7), 1.0, 2.0, 0.5, 1.0 + i, 10, 1, 0.1, 1.5, 1.25,
          datetime(2024, 3, 1)) for i in range(140)],
        "symbol string, trade_date timestamp_ntz, open double, high double, low double, close double, "
        "volume bigint, num_bars int, daily_return double, price_range double, avg_price double, "
        "updated_timestamp timestamp_ntz")
    TB.save_bucketed(daily, "barlake_b.daily", 4)
    TB.save_bucketed(indicators(spark.table("barlake_b.daily"), "2024-03-01 00:00:00"), "barlake_b.analytics", 4)
    j = join_gold(spark.table("barlake_b.daily"), spark.table("barlake_b.analytics"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 140
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_symbol_registry_round_trip(spark, tmp_dir):
    from barlake.sources import landing as L

    one = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "symbol string")
    L.write_symbols(L.symbols_registry(one, "page", "2024-01-02 06:00:00"), f"{tmp_dir}/symbols")
    L.write_symbols(L.symbols_registry(one.limit(1), "page", "2024-01-03 06:00:00"), f"{tmp_dir}/symbols")
    assert [r.symbol for r in L.read_symbols(spark, f"{tmp_dir}/symbols").collect()] == ["A"]
    two = spark.createDataFrame([("C",), ("D",)], "symbol string")
    L.write_symbols(L.symbols_registry(two, "page", "2024-01-03 09:00:00"), f"{tmp_dir}/symbols")     # replaces the day
    got = L.read_symbols(spark, f"{tmp_dir}/symbols")
    assert sorted(r.symbol for r in got.collect()) == ["C", "D"]
    assert got.columns == [f.name for f in L.BRONZE_SYMBOLS_SCHEMA.fields]
    assert spark.read.parquet(f"{tmp_dir}/symbols").count() == 4


def test_symbol_registry_keeps_each_source(spark, tmp_dir):
    from barlake.sources import landing as L

    def write(symbols, source, stamp):
        frame = spark.createDataFrame([(x,) for x in symbols], "symbol string")
        L.write_symbols(L.symbols_registry(frame, source, stamp), f"{tmp_dir}/sources")

    def stored():
        return sorted((r.source or "", r.symbol) for r in L.read_symbols(spark, f"{tmp_dir}/sources").collect())

    write(["A", "B"], "007", "2024-01-02 06:00:00")
    write(["A", "C"], "page", "2024-01-02 07:00:00")          # the same day: both stay
    assert stored() == [("007", "A"), ("007", "B"), ("page", "A"), ("page", "C")]
    write(["D"], "page", "2024-01-03 07:00:00")               # one source is newer, the other keeps its last day
    write(["N"], None, "2024-01-01 07:00:00")
    assert stored() == [("", "N"), ("007", "A"), ("007", "B"), ("page", "D")]
    write(["E"], "007", "2024-01-02 09:00:00")                # replaces that source's day alone
    assert stored() == [("", "N"), ("007", "E"), ("page", "D")]


def test_statistics_choose_the_join_order(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS barlake_s LOCATION '{tmp_dir}/ws'")
    n = 2_000
    # grade: 0..9 for 99 of 100 venues, the others up to 100,000; region: even over 0..9
    tables = {
        "bars": spark.range(20 * n).selectExpr("id % 2000 AS symbol_id", "id % 1999 AS venue_id", "id AS volume"),
        "symbols": spark.range(n).selectExpr("id AS symbol_id", "id % 10 AS region"),
        "venues": spark.range(n).selectExpr("id AS venue_id", "CASE WHEN id % 100 = 0 THEN id * 50 ELSE id % 10 END AS grade"),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"barlake_s.{name}")
    query = """SELECT sum(volume) AS volume, count(*) AS n
               FROM barlake_s.bars JOIN barlake_s.symbols USING (symbol_id) JOIN barlake_s.venues USING (venue_id)
               WHERE region < 3 AND grade < 10"""

    def first_joined():
        """The dimension that meets the bars first, i.e. in the deepest join."""
        plan = TB.explain_text(spark.sql(query), "extended").split("== Optimized Logical Plan ==")[1].split("== Physical")[0]
        deepest = max((x for x in plan.splitlines() if "Join Inner" in x), key=lambda x: x.index("Join"))
        return "symbols" if "symbol_id" in deepest else "venues"

    want = spark.sql(query).collect()
    for name in tables:
        TB.analyze(spark, f"barlake_s.{name}")
    with TB.cost_based(spark):
        by_range = first_joined()
    TB.analyze(spark, "barlake_s.venues", histograms=["grade"], bins=100)
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"
    with TB.cost_based(spark):
        by_histogram = first_joined()
        assert spark.sql(query).collect() == want
    assert (by_range, by_histogram) == ("venues", "symbols")
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"


def test_cached_is_released(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    with TB.cached(df) as kept:
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk and kept.count() == 10
    assert not df.storageLevel.useMemory
