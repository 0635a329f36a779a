"""One reader, two sinks, nothing lost: new fields, changed types, replayed micro-batches."""

import os

from pyspark.sql import functions as F

from barlake.streaming import bronze as B
from barlake.streaming.medallion import MedallionPaths, start_medallion_stream

BAR = '{"symbol":"AAPL","timestamp":"2024-01-02T1%d:00:00","open":1.0,"high":2.0,"low":0.5,"close":1.5,"volume":%s%s}\n'


def land(folder, day, lines, name="part-0.json"):
    os.makedirs(f"{folder}/batch_id={day}", exist_ok=True)
    with open(f"{folder}/batch_id={day}/{name}", "w") as f:
        f.write(lines)


def run(spark, root, **how):
    for q in B.start_bronze_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ck", "availableNow",
                                   quarantine_path=f"{root}/q", **how):
        q.awaitTermination()
    return B.read_bronze(spark, f"{root}/bronze")


def test_new_fields_and_changed_types_are_kept(spark, tmp_dir):
    root = f"{tmp_dir}/evolve"
    land(f"{root}/landing", "20240102", BAR % (0, 10, ""))
    first = run(spark, root)
    assert first.columns == [*B.BRONZE_BARS_SCHEMA.names, "_rescued", "epoch"] and first.count() == 1
    land(f"{root}/landing", "20240103", BAR % (1, 11, ',"vwap":1.25,"halted":true,"note":"x","deep":{"a":[1]},"mixed":1')
         + BAR % (2, '"12k"', ',"vwap":2,"mixed":"one","SYMBOL":"up"') + BAR % (3, 13.5, ',"vwap":null')
         + '{"symbol":5,"timestamp":"2024-01-02T14:00:00","close":1}\n'        # a changed type that bronze would drop
         + '{"symbol":"MSFT","timestamp":\n' + "7\n" + "\n")
    got = {r.timestamp.hour: r for r in run(spark, root).withColumn("rescued", F.to_json("_rescued")).collect()}
    assert [got[h].volume for h in (10, 11, 12, 13)] == [10, 11, None, None]
    assert [got[h].vwap for h in (10, 11, 12, 13)] == [None, 1.25, 2.0, None]
    assert (got[11].halted, got[11].note, got[12].note) == (True, "x", None)
    assert got[11].rescued == '{"deep":{"a":[1]},"mixed":1}' and got[10].rescued is None
    assert got[12].rescued == '{"SYMBOL":"up","mixed":"one","volume":"12k"}' and got[13].rescued == '{"volume":13.5}'
    bad = sorted(r.raw_record for r in spark.read.parquet(f"{root}/q").collect())
    assert bad == ["7", '{"symbol":"MSFT","timestamp":', '{"symbol":5,"timestamp":"2024-01-02T14:00:00","close":1}']
    land(f"{root}/landing", "20240104", BAR % (4, 14, ',"vwap":"n/a","VWAP":3,"late":true'))
    third = run(spark, root)
    assert third.schema["vwap"].dataType.simpleString() == "double" and "late" in third.columns    # types never change
    row = third.filter("hour(timestamp) = 14").withColumn("rescued", F.to_json("_rescued")).first()
    assert row.vwap is None and row.rescued == '{"VWAP":3,"vwap":"n/a"}' and row.late is True
    assert third.count() == 5 and B.stored_schema(spark, f"{root}/bronze") == {
        "halted": "boolean", "note": "string", "vwap": "double", "late": "boolean"}


def test_a_replayed_micro_batch_writes_the_same(spark, tmp_dir):
    root = f"{tmp_dir}/replay"
    text = spark.createDataFrame([(BAR % (1, 11, ',"vwap":1.25'),), (BAR % (2, '"x"', ""),), ("{",)], "value string")
    rows = B.parsed(text.withColumn("_metadata", F.struct(F.lit("/l/batch_id=20240102/p.json").alias("file_path"))))
    for epoch in (0, 1, 1, 0):
        B.write_epoch(*B.bronze_from_stream(rows, "2024-01-05 00:00:00"), f"{root}/bronze", f"{root}/q", epoch)
    got = B.read_bronze(spark, f"{root}/bronze")
    assert sorted(r["count"] for r in got.groupBy("epoch").count().collect()) == [2, 2]
    assert spark.read.parquet(f"{root}/q").count() == 2
    assert got.filter("vwap = 1.25").count() == 2 and B.stored_schema(spark, f"{root}/bronze") == {"vwap": "double"}


def test_cleaned_landing_folder_feeds_both_sinks(spark, tmp_dir):
    root = f"{tmp_dir}/clean"
    for i in range(6):
        land(f"{root}/landing", "20240102", BAR % (i, i, "") + '{"broken":\n', f"p{i}.json")
    for _ in range(2):
        got = run(spark, root, max_files_per_trigger=1, clean_source="delete")
    assert got.count() == 6 and spark.read.parquet(f"{root}/q").count() == 6
    assert got.select("epoch").distinct().count() == 6


def test_array_files_keep_their_fields(spark, tmp_dir):
    root = f"{tmp_dir}/arrays"
    os.makedirs(f"{root}/landing")
    with open(f"{root}/landing/bars_20240105.json", "w") as f:
        f.write('[{"symbol": "ZQ", "timestamp": "2024-01-05T10:00:00", "close": 1.5, "volume": "many"},\n'
                ' {"symbol": "ZR", "timestamp": "2024-01-05T11:00:00", "close": 2.5, "lots": 3}, 8]')
    got = run(spark, root, array_files=True).withColumn("rescued", F.to_json("_rescued")).orderBy("symbol").collect()
    assert [(r.symbol, r.batch_id, r.lots, r.rescued) for r in got] == [
        ("ZQ", "20240105", None, '{"volume":"many"}'), ("ZR", "20240105", 3, None)]
    assert [r.raw_record for r in spark.read.parquet(f"{root}/q").collect()] == ["8"]


def test_medallion_stream_keeps_unknown_fields(spark, tmp_dir):
    root = f"{tmp_dir}/med"
    paths = MedallionPaths(*[f"{root}/{x}" for x in ("silver", "daily", "analytics")])
    land(f"{root}/landing", "20240102", BAR % (1, 11, ',"vwap":1.25') + BAR % (2, 12, ""))
    start_medallion_stream(spark, f"{root}/landing", paths, f"{root}/ck", run_ts="2024-02-02 00:00:00").awaitTermination()
    assert spark.read.parquet(paths.silver).count() == 2
    kept = spark.read.parquet(f"{paths.silver}_rescued").select("symbol", F.hour("timestamp"), F.to_json("_rescued")).collect()
    assert list(map(tuple, kept)) == [("AAPL", 11, '{"vwap":1.25}')]
