"""Incremental filters, new-date detection, upsert invariants (idempotence, on-disk merge)."""

from datetime import datetime

from pyspark.sql import functions as F

from barlake.operators.incremental import incremental_bronze, new_dates
from barlake.operators.upsert import read_table, snapshot_asof, upsert, upsert_path
from barlake.schemas import GOLD_DAILY_OHLCV_SCHEMA, SILVER_BARS_SCHEMA

P = datetime(2024, 1, 4)


def test_incremental_bronze_strict_and_batch(spark):
    rows = [("AAPL", datetime(2024, 1, 2, 10), datetime(2024, 1, 2, 10), "20240102"),
            ("AAPL", datetime(2024, 1, 3, 10), datetime(2024, 1, 3, 10), "20240103")]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, "
                                     "batch_id string")
    assert incremental_bronze(df, last_ts="2024-01-02 10:00:00").count() == 1
    assert incremental_bronze(df, batch_ids=["20240103"]).count() == 1
    assert incremental_bronze(df).count() == 2


def test_new_dates(spark):
    s = spark.createDataFrame([("AAPL", datetime(2024, 1, 2, 10), 1.0, 2.0, 0.5, 1.5, 10, P, 1, 1.0),
                               ("AAPL", datetime(2024, 1, 3, 10), 1.0, 2.0, 0.5, 1.5, 10, P, 1, 1.0)],
                              SILVER_BARS_SCHEMA)
    g = spark.createDataFrame([("AAPL", datetime(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 10, 1, 0.5, 1.5, 1.25, P)],
                              GOLD_DAILY_OHLCV_SCHEMA)
    got = [(r.symbol, r.trade_date) for r in new_dates(s, g).collect()]
    assert got == [("AAPL", datetime(2024, 1, 3))]
    assert new_dates(s, None).count() == 2


def _t(spark):
    return spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02")],
                                 "k int, v string, d string")


def test_upsert_replace_insert_idempotent(spark):
    src = spark.createDataFrame([(2, "B", "2024-01-01"), (4, "d", "2024-01-03")], "k int, v string, d string")
    once = upsert(_t(spark), src, ["k"])
    twice = upsert(once, src, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_upsert_with_deletes(spark):
    src = spark.createDataFrame([(4, "d", "2024-01-03")], "k int, v string, d string")
    dels = spark.createDataFrame([(1,)], "k int")
    got = sorted(r.k for r in upsert(_t(spark), src, ["k"], deletes=dels).collect())
    assert got == [2, 3, 4]


def test_upsert_path_rewrites_only_touched_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    upsert_path(spark, _t(spark), path, ["k"], "d")
    src = spark.createDataFrame([(2, "B", "2024-01-01")], "k int, v string, d string")
    upsert_path(spark, src, path, ["k"], "d")
    upsert_path(spark, src, path, ["k"], "d")   # idempotent replay
    got = sorted((r.k, r.v, str(r.d)) for r in read_table(spark, path).collect())
    assert got == [(1, "a", "2024-01-01"), (2, "B", "2024-01-01"), (3, "c", "2024-01-02")]


def test_snapshot_asof(spark):
    rows = [("A", datetime(2024, 1, 2, 10), 1.0, datetime(2024, 1, 2, 12), "b"),
            ("A", datetime(2024, 1, 2, 10), 2.0, datetime(2024, 1, 2, 14), "b")]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, "
                                     "ingestion_timestamp timestamp_ntz, batch_id string")
    assert snapshot_asof(df, "2024-01-02 13:00:00").collect()[0].close == 1.0
    assert snapshot_asof(df, "2024-01-02 15:00:00").collect()[0].close == 2.0
    assert F  # noqa


def test_append_with_schema_evolution_on_disk(spark, tmp_dir):
    old = spark.createDataFrame([("A", 1.0)], "symbol string, close double")
    new = spark.createDataFrame([("B", 2.0, "20240102")], "symbol string, close double, batch_id string")
    old.write.mode("append").parquet(f"{tmp_dir}/ev")
    new.write.mode("append").parquet(f"{tmp_dir}/ev")
    got = sorted(tuple(r) for r in read_table(spark, f"{tmp_dir}/ev", merge_schema=True)
                 .select("symbol", "close", "batch_id").collect())
    assert got == [("A", 1.0, None), ("B", 2.0, "20240102")]


def test_refresh_indicators_bounded_lookback_equals_full(spark):
    from datetime import timedelta
    from barlake.operators.incremental import refresh_indicators
    from barlake.operators.indicators import indicators
    rows = []
    for s, n in (("A", 120), ("B", 30), ("C", 80)):
        for i in range(n):
            c = 100.0 + ((i * 37 + len(s) * 11) % 17) - 0.3 * i
            rows.append((s, datetime(2024, 1, 1) + timedelta(days=i), c, c + 1, c - 1, c, 10, 1,
                         ((i * 13) % 7 - 3) / 100.0, 2.0, c, P))
    daily = spark.createDataFrame(rows, GOLD_DAILY_OHLCV_SCHEMA)
    touched = spark.createDataFrame([("A", datetime(2024, 1, 1) + timedelta(days=100)),
                                     ("B", datetime(2024, 1, 1) + timedelta(days=3))],
                                    "symbol string, trade_date timestamp_ntz")
    got = refresh_indicators(daily, None, touched, "2024-03-01 00:00:00")
    full = indicators(daily, "2024-03-01 00:00:00")
    exp = full.filter(((F.col("symbol") == "A") & (F.col("trade_date") >= datetime(2024, 4, 10)))
                      | ((F.col("symbol") == "B") & (F.col("trade_date") >= datetime(2024, 1, 4))))
    assert got.count() == 20 + 27
    assert sorted(got.collect()) == sorted(exp.collect())


def test_upsert_dedups_source_by_order(spark):
    src = spark.createDataFrame([(2, "old", "2024-01-01", 1), (2, "new", "2024-01-01", 2)],
                                "k int, v string, d string, seq int")
    tgt = _t(spark).withColumn("seq", F.lit(0))
    got = sorted((r.k, r.v) for r in upsert(tgt, src, ["k"], dedup_order=["seq"]).collect())
    assert got == [(1, "a"), (2, "new"), (3, "c")]


def test_upsert_fails_on_repeated_source_keys(spark):
    import pytest
    from barlake.operators.upsert import upsert
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="repeat a key"):
        upsert(t, spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string"), ["k"]).collect()
    nulls = spark.createDataFrame([(None, "b"), (None, "c"), (1, "d")], "k int, v string")
    assert sorted(r.v for r in upsert(t, nulls, ["k"]).collect()) == ["b", "c", "d"]


def test_upsert_path_empties_a_partition_and_finishes_after_a_crash(spark, tmp_path):
    import datetime as dt
    import shutil
    import pytest
    from barlake.operators import upsert as U
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    schema = "k int, v string, p date"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    path = str(tmp_path / "t")
    U.upsert_path(spark, frame([(1, "a", d[0]), (2, "b", d[1]), (3, "c", d[2])]), path, ["k"], "p")
    U.upsert_path(spark, frame([(3, "x", d[2])]), path, ["k"], "p", deletes=frame([(1, "", d[0])]).select("k", "p"))
    read = lambda: sorted((r.k, r.v) for r in U.read_table(spark, path).collect())
    assert read() == [(2, "b"), (3, "x")]
    with pytest.raises(Exception, match="repeat a key"):
        U.upsert_path(spark, frame([(2, "m", d[1]), (2, "n", d[1])]), path, ["k"], "p")
    assert read() == [(2, "b"), (3, "x")]
    # a merge that was written whole but never put in place, and the table's day already gone
    frame([(2, "late", d[1])]).write.partitionBy("p").parquet(f"{path}/_pending/one/rows")
    spark.createDataFrame([], "value string").write.parquet(f"{path}/_pending/one/emptied")
    shutil.rmtree(f"{path}/p=2024-01-02")
    U.recover(spark, path, "p")
    assert read() == [(2, "late"), (3, "x")]


def test_upsert_path_keeps_null_partition_values(spark, tmp_dir):
    path, d = f"{tmp_dir}/t", datetime(2024, 1, 1).date()
    frame = lambda *rows: spark.createDataFrame(rows, "k int, v string, p date")
    rows = lambda: sorted((r.k, r.v, str(r.p)) for r in read_table(spark, path).collect())
    upsert_path(spark, frame((1, "a", None), (2, "b", d), (5, "e", None)), path, ["k"], "p")
    assert rows() == [(1, "a", "None"), (2, "b", "2024-01-01"), (5, "e", "None")]
    for _ in range(2):      # and again as a replay
        upsert_path(spark, frame((1, "A", None), (3, "c", d)), path, ["k"], "p")
        assert rows() == [(1, "A", "None"), (2, "b", "2024-01-01"), (3, "c", "2024-01-01"), (5, "e", "None")]
    upsert_path(spark, frame((2, "B", d)), path, ["k"], "p",
                deletes=frame((1, "", None), (5, "", None)).select("k", "p"))
    assert rows() == [(2, "B", "2024-01-01"), (3, "c", "2024-01-01")]
