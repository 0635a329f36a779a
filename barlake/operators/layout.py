"""Clustering on several columns along a space-filling curve, and compaction of small files.

Clustering ranks each column by quantiles, interleaves the bits of the ranks and sorts by the result over ranges, so that
every file holds a small box of values: a filter on any of the columns skips most files by their footers.
Compaction packs small files of a partition into bins of about the wanted size and rewrites those alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .upsert import read_table

RANK_BITS = 8       # a column is cut into 2^RANK_BITS quantiles
FILES_A_ROUND = 10_000      # small files that are rewritten together


def quantile_bounds(df: DataFrame, col: str, bits: int = RANK_BITS) -> list:
    """The lower bounds of up to 2^bits equal shares of a column of any type that Spark sorts.

    One slim column is dealt by range (Spark samples the bounds); the driver gets a value a range.
    """
    n = 1 << bits
    ranged = df.select(F.col(col).alias("v")).filter("v is not null").repartitionByRange(n, "v")
    low = ranged.groupBy(F.spark_partition_id()).agg(F.min("v").alias("v")).select("v").distinct().orderBy("v")
    return [r.v for r in low.collect()]


def rank_of(col: Column, bounds: list, like: str, bits: int = RANK_BITS) -> Column:
    """The number of the share that holds ``col`` (0 for null), by binary search in a literal array."""
    if not bounds:
        return F.lit(0).cast("long")
    held = F.array(*[F.lit(b) for b in bounds]).cast(f"array<{like}>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits + 1))])
    found = F.aggregate(steps, F.lit(0), lambda at, s: at + F.when(F.get(held, at + s - 1) <= col, s).otherwise(0))
    return F.greatest(F.coalesce(F.when(col.isNotNull(), found - 1), F.lit(0)), F.lit(0)).cast("long")


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """The bits of the ranks in turn, from the highest on: a place on the Z-order curve."""
    n = len(ranks)
    parts = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)), b * n + (n - 1 - i))
             for i, r in enumerate(ranks) for b in range(bits)]
    return reduce(Column.__add__, parts)


def cluster_rewrite(df: DataFrame, cols: Sequence[str], num_partitions: int | None = None, bits: int | None = None) -> DataFrame:
    """The rows of ``df`` in ``num_partitions`` files' worth of boxes over ``cols``. Write it with any file sink.

    A hash of the whole row is the last sort key, so that rows of one hot place on the curve span several files.
    """
    cols = list(cols)
    spark = df.sparkSession
    bits = bits or min(RANK_BITS, 62 // len(cols))
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ranks = [rank_of(F.col(c), quantile_bounds(df, c, bits), kind[c], bits) for c in cols]
    place, tie = "_place", F.xxhash64(*[F.col(c) for c in df.columns])
    while place in df.columns:
        place = f"_{place}"
    placed = df.withColumn(place, interleaved(ranks, bits))
    return placed.repartitionByRange(n, place, tie).sortWithinPartitions(place, *cols).drop(place)


# ---------------------------------------------------------------- compaction
def small_file_bins(spark: SparkSession, path: str, small_below: int, target: int) -> DataFrame:
    """(path, folder, bin) of the data files under ``small_below`` bytes that share a bin with another one.

    Files of a folder fill bins of about ``target`` bytes in the order of their names.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length"))
    files = files.filter(~F.col("path").contains("/_")).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    order = Window.partitionBy("folder").orderBy("path")
    before = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    binned = files.filter(F.col("length") < small_below).withColumn("bin", F.floor(before / target))
    alone = F.count("*").over(Window.partitionBy("folder", "bin"))
    return binned.withColumn("n", alone).filter("n > 1").select("path", "folder", "bin")


def compact(spark: SparkSession, path: str, target: int = 256 << 20, small_below: int | None = None) -> int:
    """Rewrite the small files of a parquet table as files of about ``target`` bytes; large ones aren't touched.

    New files are written whole beside the table, then the old ones are deleted and the new ones moved in; a
    crash in between is finished by the next call. A table has one writer at a time. Returns the number of files replaced.
    """
    base = path.rstrip("/")
    _finish(spark, base)
    done = 0
    while True:
        bins = small_file_bins(spark, base, small_below or target // 2, target)     # lists the table anew
        some = bins.orderBy("folder", "bin", "path").limit(FILES_A_ROUND + 1).collect()     # names of small files
        if len(some) > FILES_A_ROUND:       # whole bins only
            last = some[-1]
            some = [r for r in some if (r.folder, r.bin) != (last.folder, last.bin)] or some
        if not some:
            return done
        pending = f"{base}/_compact/{uuid.uuid4().hex}"
        names = spark.createDataFrame([(r.path, f"{r.folder}#{r.bin}") for r in some], "_path string, _bin string")
        rows = spark.read.option("basePath", base).parquet(*[r.path for r in some])
        file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
        rows = rows.withColumn("_path", file).join(
            names.withColumn("_path", F.regexp_replace("_path", "^file:/+", "file:/")), "_path").drop("_path")
        parts = [x.split("=")[0] for x in some[0].folder.removeprefix(some[0].folder.split(base)[0] + base).split("/") if "=" in x]
        writer = rows.repartition("_bin").drop("_bin").write
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{pending}/rows")
        names.select("_path").coalesce(1).write.parquet(f"{pending}/replaced")
        _finish(spark, base)
        done += len(some)


def _finish(spark: SparkSession, base: str) -> None:
    """Put compactions that were written whole into place; drop others."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda *names: jvm.org.apache.hadoop.fs.Path("/".join(names))
    fs = at(base).getFileSystem(conf)
    if not fs.exists(at(base, "_compact")):
        return
    for status in fs.listStatus(at(base, "_compact")):
        work = status.getPath().toString()
        if fs.exists(at(work, "replaced/_SUCCESS")):
            for r in read_table(spark, f"{work}/replaced").collect():
                fs.delete(at(r[0]), False)
            top = f"{work}/rows"
            files = fs.listFiles(at(top), True)
            while files.hasNext():
                new = files.next().getPath()
                if new.getName().endswith(".parquet"):
                    inside = new.getParent().toString().split("/rows", 1)[1].strip("/")
                    fs.rename(new, at(base, *([inside] if inside else []), new.getName()))
        fs.delete(at(work), True)
    fs.delete(at(base, "_compact"), True)
