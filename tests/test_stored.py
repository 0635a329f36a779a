"""Stored layers: first run or merge, statistics and files by partition, requests in a table."""

from datetime import datetime

from pyspark.sql import functions as F

from barlake.sources import tables as TB
from barlake.sources.requests import request_problem

BARS = "symbol string, timestamp timestamp_ntz, close double"


def _bars(spark, rows):
    return spark.createDataFrame([(s, datetime(2024, 1, d, h), c) for s, d, h, c in rows], BARS)


def test_merge_or_create(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS barlake_m LOCATION '{tmp_dir}/m'")
    name, keys = "barlake_m.silver", ["symbol", "timestamp"]
    first = _bars(spark, [("A", 1, 9, 1.0), ("A", 2, 9, 2.0), ("B", 2, 9, 3.0)])
    assert TB.merge_or_create(first, name, keys, "timestamp") == "created"
    untouched = {r.path for r in TB.file_size_report(spark, TB.table_location(spark, name)).collect() if "2024-01-01" in r.path}
    late = _bars(spark, [("A", 2, 9, 2.5), ("C", 3, 9, 4.0)]).select("close", "timestamp", "symbol")   # by name, not place
    assert TB.merge_or_create(late, name, keys, "timestamp") == "merged"
    got = {(r.symbol, str(r.part_date), r.close) for r in spark.table(name).collect()}
    assert got == {("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.5), ("B", "2024-01-02", 3.0), ("C", "2024-01-03", 4.0)}
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3
    now = {r.path for r in TB.file_size_report(spark, TB.table_location(spark, name)).collect()}
    assert untouched and untouched <= now                   # a day that nothing touched keeps its files
    assert TB.merge_or_create(late.limit(0), name, keys, "timestamp") == "merged"
    assert spark.table(name).count() == 4


def test_statistics_of_columns(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS barlake_st LOCATION '{tmp_dir}/st'")
    rows = spark.createDataFrame([(1, 0.5), (None, -2.0), (7, None)], "volume long, close double")
    TB.create_or_replace(rows, "barlake_st.bars")
    TB.analyze(spark, "barlake_st.bars", ["volume"])
    got = {r.column_name: tuple(r)[1:] for r in TB.column_statistics(spark, "barlake_st.bars", ["volume", "close"]).collect()}
    assert got == {"volume": (1, 1.0, 7.0), "close": (None, None, None)}


def test_files_by_partition(spark, tmp_dir):
    rows = _bars(spark, [("A", 1, 9, 1.0), ("B", 1, 10, 1.0), ("A", 2, 9, 2.0)])
    TB.write_partitioned(rows, f"{tmp_dir}/p", "timestamp")
    TB.write_partitioned(rows.filter("symbol = 'B'"), f"{tmp_dir}/p", "timestamp", mode="append")
    got = {str(r.part_date): r for r in TB.partition_files(spark, f"{tmp_dir}/p").collect()}
    assert {d: r.files for d, r in got.items()} == {"2024-01-01": 2, "2024-01-02": 1}
    assert all(r.bytes > 0 and r.newest is not None for r in got.values())


def test_requests_in_a_table(spark):
    day = lambda d: datetime(2024, 1, d) if d else None
    cases = [(["A"], 1, 2, None), (None, 1, 2, "no symbols given"), ([], 2, 1, "no symbols given"),
             (["A", "\t"], 1, 2, "a symbol is blank"), (["A", None], 1, 2, "a symbol is blank"),
             (["A"], 2, 2, "the request ends before it starts"), (["A"], None, 2, "the request ends before it starts"),
             ([" A "], 1, 2, None)]
    df = spark.createDataFrame([(i, s, day(a), day(b)) for i, (s, a, b, _) in enumerate(cases)],
                               "i int, s array<string>, a timestamp_ntz, b timestamp_ntz")
    got = df.select("i", request_problem(F.col("s"), F.col("a"), F.col("b")).alias("p")).orderBy("i").collect()
    assert [r.p for r in got] == [c[3] for c in cases]


def test_batch_ids_of_another_look(spark, tmp_dir):
    from barlake.streaming.bronze import read_bronze, start_bronze_stream
    line = '{"symbol":"A","timestamp":"2024-01-02T09:00:00","close":1.0}'
    for batch in ("20240102", "0042", "20240103-b"):        # a number, leading noughts, a suffix
        spark.createDataFrame([(line,)], "value string").write.text(f"{tmp_dir}/l/batch_id={batch}")
        for q in start_bronze_stream(spark, f"{tmp_dir}/l", f"{tmp_dir}/b", f"{tmp_dir}/c"):
            q.awaitTermination()
    assert sorted(r.batch_id for r in read_bronze(spark, f"{tmp_dir}/b").collect()) == ["0042", "20240102", "20240103-b"]
