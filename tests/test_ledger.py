"""The ledger reads what runs touched and nothing else; merges evaluate their source once; vanished days vanish everywhere."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barlake.operators import incremental as INC
from barlake.operators import ledger as LED
from barlake.operators.daily import daily_ohlcv
from barlake.operators.indicators import indicators
from barlake.operators.upsert import assert_unique, upsert_path
from barlake.schemas import SILVER_BARS_SCHEMA
from barlake.sources.tables import explain_text

RUN = "2024-02-02 00:00:00"
T0 = datetime(2024, 1, 1, 10)


def bars(spark, rows):
    """(symbol, day, hour, close, is_valid)"""
    return spark.createDataFrame([(s, T0 + timedelta(days=d, hours=h), c, c + 1, c - 1, c, 10, T0, v, 1.0)
                                  for s, d, h, c, v in rows], SILVER_BARS_SCHEMA)


def layers(root):
    return {x: f"{root}/{x}" for x in ("silver", "daily", "analytics", "ledger")}


def test_ledger_refresh_equals_recompute_and_reads_touched_days_only(spark, tmp_dir):
    at = layers(f"{tmp_dir}/led")
    first = [(s, d, h, 50.0 + d + h, 1) for s in "AB" for d in range(60) for h in range(2)]
    runs = [first, [("A", 30, 0, 99.0, 1), ("B", 31, 5, 70.0, 1)], [("A", 40, h, 1.0, 0) for h in range(2)], [("C", 58, 1, 5.0, 1)]]
    merged = {}
    for run, rows in enumerate(runs):
        LED.merge_bars(spark, bars(spark, rows), at["silver"], at["ledger"], run)
        touched, last = LED.pending(spark, at["ledger"])
        if run:
            silver = LED.touched_silver(spark, at["silver"], touched)
            assert LED.PART in explain_text(silver).split("PartitionFilters:")[1].split("\n")[0]
            assert silver.select("symbol", LED.PART).distinct().count() == len({(r[0], r[1]) for r in rows})
            assert last == run and LED.days_of(touched) == sorted({(T0 + timedelta(days=r[1])).date() for r in rows})
        untouched = sorted(f for f in os.listdir(at["daily"]) if f.endswith("05")) if run else []
        before = {f: os.listdir(f"{at['daily']}/{f}") for f in untouched}
        assert LED.refresh_gold(spark, at["silver"], at["daily"], at["analytics"], at["ledger"], RUN) == run
        assert all(os.listdir(f"{at['daily']}/{f}") == before[f] for f in before)      # days nobody touched keep their files
        merged |= {(r[0], r[1], r[2]): r for r in rows}
        daily = daily_ohlcv(bars(spark, merged.values()), RUN)
        for name, want in (("daily", daily), ("analytics", indicators(daily, RUN))):
            got = spark.read.parquet(at[name]).drop(LED.PART).select(*want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert LED.pending(spark, at["ledger"])[0] is None
    assert LED.refresh_gold(spark, at["silver"], at["daily"], at["analytics"], at["ledger"], RUN) == 3
    assert spark.read.parquet(at["daily"]).filter("symbol = 'A'").count() == 59        # day 40 lost its last valid bar


def test_a_refresh_cut_short_is_done_again(spark, tmp_dir, monkeypatch):
    at = layers(f"{tmp_dir}/cut")
    LED.merge_bars(spark, bars(spark, [("A", d, 0, 5.0 + d, 1) for d in range(8)]), at["silver"], at["ledger"], 0)
    real = LED.refresh_indicators
    monkeypatch.setattr(LED, "refresh_indicators", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        LED.refresh_gold(spark, at["silver"], at["daily"], at["analytics"], at["ledger"], RUN)
    monkeypatch.setattr(LED, "refresh_indicators", real)
    LED.refresh_gold(spark, at["silver"], at["daily"], at["analytics"], at["ledger"], RUN)
    assert spark.read.parquet(at["analytics"]).count() == spark.read.parquet(at["daily"]).count() == 8


def test_batch_refresh_drops_vanished_days(spark):
    rows = [("A", d, h, 50.0 + d, 1) for d in range(6) for h in range(2)]
    silver0, changed = bars(spark, rows), bars(spark, [("A", 3, h, 1.0, 0) for h in range(2)])
    daily0 = daily_ohlcv(silver0, RUN)
    analytics0 = indicators(daily0, RUN)
    silver = bars(spark, [r for r in rows if r[1] != 3]).unionByName(changed)
    for complete in (False, True):
        daily, _ = INC.refresh_daily(silver, daily0, changed, RUN, complete=complete)
        got = INC.refresh_indicators(daily, analytics0, INC.touched_days(changed), RUN)
        want = indicators(daily_ohlcv(silver, RUN), RUN)
        assert daily.count() == got.count() == 5
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_merge_evaluates_its_source_once(spark, tmp_dir):
    path = f"{tmp_dir}/once"
    rows = spark.createDataFrame([(i, i % 5, "old") for i in range(50)], "k int, part int, v string")
    upsert_path(spark, rows, path, ["k"], "part")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.createDataFrame([(i, i % 5, "new") for i in range(0, 20, 2)], "k int, part int, v string")
    upsert_path(spark, source.mapInArrow(count, source.schema), path, ["k"], "part",
                deletes=spark.createDataFrame([(4, 4), (49, 4)], "k int, part int"))
    assert seen.value == 10
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 49 and got[4] == "new" and sum(v == "new" for v in got.values()) == 10
    assert not os.path.exists(f"{path}/_pending")


def test_a_merge_whose_moves_were_cut_short_is_finished(spark, tmp_dir, monkeypatch):
    from barlake.operators import upsert as U
    path = f"{tmp_dir}/moves"
    upsert_path(spark, spark.createDataFrame([(i, i % 3, "old") for i in range(9)], "k int, part int, v string"), path, ["k"], "part")
    real = U.recover
    calls = []
    monkeypatch.setattr(U, "recover", lambda *a: real(*a) if not calls.append(1) and len(calls) == 1 else None)
    upsert_path(spark, spark.createDataFrame([(0, 0, "new"), (1, 1, "new")], "k int, part int, v string"), path, ["k"], "part")
    assert spark.read.parquet(path).filter("v = 'new'").count() == 0
    merge = f"{path}/_pending/{os.listdir(f'{path}/_pending')[0]}"
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part=0"), True)      # lost between the two steps of a move
    assert os.path.exists(f"{merge}/rows/part=0")
    real(spark, path, "part")
    got = spark.read.parquet(path).collect()
    assert len(got) == 9 and sorted(r.k for r in got if r.v == "new") == [0, 1] and not os.path.exists(f"{path}/_pending")


def test_null_keys_may_repeat_and_spread(spark):
    rows = spark.range(4000).select(F.when(F.col("id") < 5, F.col("id")).alias("k"), F.lit("x").alias("p"))
    assert assert_unique(rows, ["k", "p"]).count() == 4000
    with pytest.raises(Exception, match="repeat a key"):
        assert_unique(rows.union(rows.filter("k = 3")), ["k", "p"]).count()
