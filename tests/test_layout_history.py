"""Clustering by footers, compaction by file names, profiles by day, states by stamp, expectations by batch."""

import datetime
import glob
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barlake.operators import layout as LAY
from barlake.operators import quality as DQ
from barlake.operators.upsert import snapshot_asof, snapshot_asof_series
from barlake.sources.tables import explain_text


def boxes(path, col):
    """Least and greatest value of a column in each file, from the footers."""
    out = []
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == col)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_clustering_lets_a_filter_on_either_column_skip_files(spark, tmp_dir):
    n = 20_000
    df = spark.range(n).select(F.format_string("S%03d", F.pmod(F.xxhash64("id"), F.lit(300))).alias("symbol"),
                               F.expr("date_add(date'2020-01-01', cast(pmod(xxhash64(id, 7), 1000) as int))").alias("day"), "id")
    df = df.withColumn("symbol", F.when(F.col("id") % 500 != 0, F.col("symbol"))).cache()
    path = f"{tmp_dir}/z"
    LAY.cluster_rewrite(df, ["symbol", "day"], 32).write.parquet(path)
    got = spark.read.parquet(path)
    assert got.columns == df.columns and got.exceptAll(df).isEmpty() and got.count() == n
    files = len(glob.glob(f"{path}/*.parquet"))
    assert files == 32
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=d) for d in (20, 500, 980)]
    for col, values in (("symbol", ["S010", "S150", "S290"]), ("day", days)):
        for v in values:
            read = sum(lo <= v <= hi for lo, hi in boxes(path, col))
            assert 0 < read <= files / 2, (col, v, read)


def test_compaction_leaves_large_files_alone(spark, tmp_dir):
    path = f"{tmp_dir}/c"
    rows = spark.range(30_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 2).alias("p"))
    rows.filter("id < 20000").repartition(1).write.partitionBy("p").parquet(path)
    rows.filter("id >= 20000 and id < 29000").repartition(12).write.mode("append").partitionBy("p").parquet(path)
    rows.filter("id >= 29000").filter("p = 1").repartition(1).write.mode("append").partitionBy("p").parquet(path)
    size = {f: os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}
    limit = 300_000
    large = {f for f, n in size.items() if n >= limit}
    assert len(large) == 2 and len(size) > 20
    assert LAY.compact(spark, path, target=400_000, small_below=limit) == len(size) - 2
    now = set(glob.glob(f"{path}/**/*.parquet", recursive=True))
    assert large <= now and len(now) <= 6 and not (now & (set(size) - large)) and not os.path.exists(f"{path}/_compact")
    got = spark.read.parquet(path).select(*rows.columns)
    want = rows.filter("id < 29000 or p = 1")
    assert got.count() == want.count() and sorted(r.id for r in got.select("id").collect()) == sorted(r.id for r in want.select("id").collect())
    assert LAY.compact(spark, path, target=400_000, small_below=1000) == 0


def test_compaction_cut_short_is_finished(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/cut"
    spark.range(900).repartition(9).write.parquet(path)
    real, calls = LAY._finish, []
    monkeypatch.setattr(LAY, "_finish", lambda *a: real(*a) if not calls.append(1) and len(calls) == 1 else (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        LAY.compact(spark, path)
    assert spark.read.parquet(path).count() == 900
    os.remove(sorted(glob.glob(f"{path}/*.parquet"))[0])        # the first old file was deleted already
    monkeypatch.setattr(LAY, "_finish", real)
    assert LAY.compact(spark, path) == 0
    assert len(glob.glob(f"{path}/*.parquet")) == 1 and spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(900))


def bronze_like(spark, rows):
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, batch string, bars int")


def test_profiles_merge_day_by_day(spark, tmp_dir):
    import datetime as dt
    t = lambda d, h: dt.datetime(2024, 1, d, h)
    first = [("A", t(1, 9), "b1", 3), ("A", t(1, 10), "b1", None), ("B", t(1, 9), None, 5), (None, None, "b2", 7), (None, t(1, 3), "b1", 1)]
    second = [("A", t(2, 9), "b3", 4), ("C", t(2, 10), "b1", 2)]
    path = f"{tmp_dir}/profile"
    for rows in (first, second, second):       # a day stored again doesn't count twice
        DQ.store_profile(DQ.completeness_profile(bronze_like(spark, rows), "timestamp", "batch", "bars"), path)
    whole = bronze_like(spark, first + second)
    merged = DQ.completeness_of(spark.read.parquet(path), "x", batches=True)
    direct = DQ.completeness(whole, "x", "timestamp", "batch", "bars")
    want = whole.agg(F.lit("x"), F.count_distinct("symbol"), F.count_distinct(F.to_date("timestamp")), F.count_distinct("batch"), F.avg("bars"))
    assert tuple(merged.first()) == tuple(direct.first()) == tuple(want.first())
    assert "Expand" not in explain_text(direct)
    assert tuple(DQ.completeness(whole.limit(0), "x", "timestamp").first()) == ("x", 0, 0, None, None)


def test_series_of_states_equals_one_by_one(spark):
    import datetime as dt
    import random
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["A", "B", None]), t0 + dt.timedelta(hours=rng.randrange(3)), float(i), t0 + dt.timedelta(days=rng.randrange(9)), f"b{i % 4}")
            for i in range(300)] + [("H", t0, float(i), t0 + dt.timedelta(days=i % 9), "b") for i in range(300)]
    b = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, ingestion_timestamp timestamp_ntz, batch_id string")
    stamps = [f"2024-01-0{d} 00:00:00" for d in (5, 1, 3, 3, 9)] + ["2023-12-31 00:00:00", "2024-01-03 12:00:00"]
    got = snapshot_asof_series(b, stamps)
    assert got.columns == ["as_of", *b.columns]
    want = [(str(s), *r) for s in sorted(set(stamps)) for r in snapshot_asof(b, s).collect()]
    assert sorted(str((str(r[0]), *r[1:])) for r in got.collect()) == sorted(map(str, want))


def test_expectations_are_kept_by_batch(spark, tmp_dir):
    from barlake.streaming.bronze import start_bronze_stream
    from barlake.streaming.expectations import ExpectationLog, expectation_history
    root = f"{tmp_dir}/hist"
    log = ExpectationLog(spark, f"{root}/log", {"landing_expectations": "landing"})
    spark.streams.addListener(log)
    try:
        for day, lines in (("20240102", '{"symbol":"A","timestamp":"2024-01-02T10:00:00"}\n{"symbol":""}\n{\n'), ("20240103", '{"symbol":"B","x":1}\n')):
            os.makedirs(f"{root}/landing/batch_id={day}")
            with open(f"{root}/landing/batch_id={day}/p.json", "w") as f:
                f.write(lines)
            for q in start_bronze_stream(spark, f"{root}/landing", f"{root}/b", f"{root}/ck"):
                q.awaitTermination()
        for _ in range(100):
            if len(glob.glob(f"{root}/log/query=*/batch=*")) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    got = {(r.batch, r.expectation): (r.passed_records, r.failed_records) for r in expectation_history(spark, f"{root}/log").collect()}
    assert got == {(0, "well_formed"): (2, 1), (0, "nothing_rescued"): (3, 0), (0, "valid_symbol"): (1, 2), (0, "valid_timestamp"): (1, 2),
                   (1, "well_formed"): (1, 0), (1, "nothing_rescued"): (0, 1), (1, "valid_symbol"): (1, 0), (1, "valid_timestamp"): (0, 1)}
