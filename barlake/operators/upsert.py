"""Upsert, time travel, schema-evolving append and layout rewrites without a table format.

``upsert`` is MERGE's user-visible outcome (matched -> replace whole row, not
matched -> insert) as ``left_anti`` + ``unionByName``. On disk, ``upsert_path``
first writes the merged partitions beside the table, then moves their folders into place: a
crash before that leaves the table as it was, a crash after it is finished by the
next call. It is not atomic for concurrent readers, and a table has one writer at a time: a
second one would take the first one's unfinished merge for a crashed one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clean import dedup_latest, ts_lit


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           dedup_order: Sequence[str] | None = None, deletes: DataFrame | None = None) -> DataFrame:
    """Replace target rows whose ``keys`` appear in ``source``; insert the others.

    ``source`` must be unique on ``keys``: like MERGE, the query fails on a repeated key
    (checked inside the plan; keys with a null never match and may repeat). Pass
    ``dedup_order`` to keep the greatest row per key instead. ``deletes`` (key rows)
    removes keys outright (MERGE's ``WHEN MATCHED THEN DELETE``). The anti join
    lets AQE pick broadcast when the change set is small and a shuffle join when not.
    """
    keys = list(keys)
    source = dedup_latest(source, keys, dedup_order) if dedup_order else assert_unique(source, keys)
    source = source.select(*target.columns)
    gone = source.select(*keys)
    if deletes is not None:
        gone = gone.unionByName(deletes.select(*keys))
    return target.join(gone, keys, "left_anti").unionByName(source)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, failing when it is evaluated if two rows have the same (fully non-null) key.

    Rows with a null in their key may repeat; each is a group of its own, so they don't meet in one task.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    own = df.withColumn("_own", F.when(~known, F.monotonically_increasing_id()))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_own"))
    checked = F.assert_true(F.col("_n") == 1, F.lit(f"source rows repeat a key ({', '.join(keys)})"))
    return own.withColumn("_n", n).filter(checked.isNull()).drop("_n", "_own")


def upsert_path(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                partition_col: str, fmt: str = "parquet", deletes: DataFrame | None = None) -> None:
    """S8 on disk: merge ``source`` into the partitioned table at ``path``.

    Only partitions whose ``partition_col`` value occurs in ``source`` or ``deletes`` are read and rewritten;
    one that ``deletes`` empties is removed. The source is evaluated once, into ``path/_pending/<id>`` (hidden from
    readers); the merged partitions are written there once and their folders moved into place. Keys must determine the
    partition value, so a row cannot move between partitions and leave a stale copy behind.
    """
    keys = list(keys)
    if partition_col not in keys and partition_col not in source.columns:
        raise ValueError("partition column must be part of the source rows")
    recover(spark, path, partition_col, fmt)
    current = read_table(spark, path, fmt)
    pending = f"{path.rstrip('/')}/_pending/{uuid.uuid4().hex}"
    source = _kept(source, f"{pending}/source")
    parts = source.select(partition_col)
    if deletes is not None:
        deletes = _kept(deletes.select(*dict.fromkeys([*keys, partition_col])), f"{pending}/deletes")
        parts = parts.unionByName(deletes.select(partition_col))
    parts = parts.distinct()
    if current is None:
        merged = upsert(source.limit(0), source, keys)
    else:
        merged = upsert(prune_partitions(current, partition_col, parts), source.select(*current.columns), keys,
                        deletes=deletes)
    # REBALANCE (not repartition): AQE splits a hot day into several write tasks
    merged.hint("rebalance", partition_col).write.partitionBy(partition_col).format(fmt).save(f"{pending}/rows")
    left = read_table(spark, f"{pending}/rows", fmt)
    emptied = parts if left is None else _having(parts, left, partition_col, "left_anti")
    emptied.select(F.col(partition_col).cast("string").alias("value")).write.parquet(f"{pending}/emptied")
    recover(spark, path, partition_col, fmt)


def _kept(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` computed once, stored at ``path``."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def recover(spark: SparkSession, path: str, partition_col: str, fmt: str = "parquet") -> None:
    """Put merges that were written completely into place, in order of their ends; drop incomplete ones.

    A partition's folder is moved once what it replaces is gone; if that is cut short, the folder is still there and the next
    call moves it.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda *names: jvm.org.apache.hadoop.fs.Path("/".join(names))
    base = path.rstrip("/")
    fs = at(base).getFileSystem(conf)
    if not fs.exists(at(base, "_pending")):
        return
    whole = [(fs.getFileStatus(done).getModificationTime(), s.getPath().toString()) for s in fs.listStatus(at(base, "_pending"))
             for done in [at(s.getPath().toString(), "emptied/_SUCCESS")] if fs.exists(done)]
    for _, merge in sorted(whole):
        if fs.exists(at(merge, "rows")):
            for folder in fs.listStatus(at(merge, "rows")):      # one for each touched partition value
                name = folder.getPath().getName()
                if name.startswith(f"{partition_col}="):
                    fs.delete(at(base, name), True)
                    if not fs.rename(folder.getPath(), at(base, name)):
                        raise OSError(f"{folder.getPath().toString()} can't be moved into {base}")
        # the values of partitions that lost their last row: days, one directory each
        for r in spark.read.schema("value string").parquet(f"{merge}/emptied").toLocalIterator():
            name = "__HIVE_DEFAULT_PARTITION__" if r.value is None else r.value
            fs.delete(at(base, f"{partition_col}={name}"), True)
        fs.delete(at(merge), True)
    fs.delete(at(base, "_pending"), True)


def prune_partitions(table: DataFrame, partition_col: str, values: DataFrame) -> DataFrame:
    """Restrict a partitioned ``table`` to the partition values occurring in ``values``.

    The least and greatest value become literal ``PartitionFilters``, so partitions outside are never listed
    or read; a semi join keeps those that occur.
    """
    part = F.col(partition_col)
    lo, hi, null = values.agg(F.min(part), F.max(part), F.max(part.isNull())).first()
    if lo is None:
        return table.filter(part.isNull()) if null else table.filter(F.lit(False))
    span = part.between(F.lit(lo), F.lit(hi))
    return _having(table.filter(span | part.isNull() if null else span), values, partition_col, "left_semi")


def _having(df: DataFrame, values: DataFrame, col: str, how: str) -> DataFrame:
    """Semi or anti join of ``df`` with the values of ``col`` in ``values``; null is a value like any other."""
    v = values.select(F.col(col).alias(f"_{col}_value")).distinct()
    return df.join(v, F.col(col).eqNullSafe(F.col(f"_{col}_value")), how)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               merge_schema: bool = False) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written there yet.

    ``merge_schema=True`` reconciles parquet files written with evolving schemas
    (S9: columns missing from older files read as NULL).
    """
    try:
        r = spark.read.format(fmt)
        if merge_schema:
            r = r.option("mergeSchema", "true")
        return r.load(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def snapshot_asof(bronze: DataFrame, ts, keys: Sequence[str] = ("symbol", "timestamp")) -> DataFrame:
    """The deduplicated state as of ``ts`` from the append-only bronze history."""
    b = bronze.filter(F.col("ingestion_timestamp") <= ts_lit(ts))
    b = b.filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())
    return dedup_latest(b, keys)


def snapshot_asof_series(bronze: DataFrame, stamps: Sequence, keys: Sequence[str] = ("symbol", "timestamp")) -> DataFrame:
    """The deduplicated states as of several stamps, as rows of ``snapshot_asof`` with an ``as_of`` column.

    A key's rows are reduced to the newest one between two stamps (map-side, however often it arrived); each of these is
    valid from its stamp up to the next one that has a newer row, so bronze is read and shuffled once for all stamps.
    """
    stamps = sorted({str(s) for s in stamps})
    at = F.array(*[ts_lit(s) for s in stamps])
    b = bronze.filter(F.col("ingestion_timestamp") <= ts_lit(stamps[-1]))
    b = b.filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())
    since = F.size(F.filter(at, lambda s: s < F.col("ingestion_timestamp")))
    newest = dedup_latest(b.withColumn("_since", since), [*keys, "_since"])
    until = F.coalesce(F.lead("_since").over(Window.partitionBy(*keys).orderBy("_since")), F.lit(len(stamps)))
    valid = newest.withColumn("_until", until)      # at most a row a stamp for each key
    asof = F.explode(F.slice(at, F.col("_since") + 1, F.col("_until") - F.col("_since")))
    return valid.withColumn("as_of", asof).select("as_of", *bronze.columns)


def append_evolve(target: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Append with schema evolution (missing columns become NULL on either side)."""
    return target.unionByName(new_rows, allowMissingColumns=True)
