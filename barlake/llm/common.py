"""Helpers that the operators share: shared storage, code for the workers, distributed prefix sums, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session (tests) may leave it unset."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="barlake-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, into the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bits of a bitmap of places, and of each of its rows (Spark's bitmaps have 4,096 bytes).
PLACE_BITS, GROUP_BITS = 26, 1 << 15


def place_of(*columns: str) -> Column:
    """A row's place in the bitmaps of :func:`place_maps`: a hash of its key."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << PLACE_BITS))


def place_maps(places: DataFrame) -> DataFrame:
    """Bitmaps of the flags of ``places`` (``place``, once each, and boolean columns).

    They let a scan of wide rows use a decision taken on slim ones without a shuffle of the wide rows: only rows at
    places whose flags leave the decision open need an exact join. Their size is bounded whatever the corpus: 2,048 rows, 8 MB a
    flag; on corpora that fill them more wide rows have to be joined, with the same result.
    """
    flags = [c for c in places.columns if c != "place"]
    slim = places.select(F.floor(F.col("place") / GROUP_BITS).alias("_group"), (F.col("place") % GROUP_BITS).alias("_bit"), *flags)
    return stored(slim.repartition("_group").groupBy("_group").agg(
        *[F.bitmap_construct_agg(F.when(F.col(c), F.col("_bit"))).alias(c) for c in flags]))


def with_flags(df: DataFrame, place: str, maps: DataFrame, names: dict[str, str]) -> DataFrame:
    """``df`` with the flags of its rows' places; ``names`` gives each flag's new column."""
    taken = {f"{v}_map": k for k, v in names.items()}
    group = next(iter(taken)) + "_group"
    bitmaps = F.broadcast(maps.select(F.col("_group").alias(group), *[F.col(k).alias(m) for m, k in taken.items()]))
    out = df.join(bitmaps, F.floor(F.col(place) / GROUP_BITS) == F.col(group), "left")
    at = f"cast(shiftright({place}, 3) % {GROUP_BITS // 8} + 1 AS int)"
    bit = "coalesce(shiftright(cast(conv(hex(substring({m}, {at}, 1)), 16, 10) AS bigint), cast({p} % 8 AS int)) % 2 = 1, false)"
    return out.withColumns({v: F.expr(bit.format(m=f"{v}_map", at=at, p=place)) for v in names.values()}).drop(group, *taken)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, wherever their working directory is (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}_llm.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder in (root, os.path.join(root, "llm")):
            for f in sorted(os.listdir(folder)):
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.join(name, os.path.relpath(os.path.join(folder, f), root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it, as ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def free_stem(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it, as no column of ``df`` begins like it (in any case)."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], totals: dict[str, Column],
                   xor: Sequence[str] = (), keep: str | None = None, by: str | None = None) -> DataFrame:
    """Add inclusive running totals along ``order`` within ``group``, with no task that holds a whole group.

    ``totals`` names the new columns (free names) and gives the aggregate over the rows up to each row: a sum or count of
    integers, or a ``F.bit_xor`` for those named in ``xor``. The rows are sorted by range into partitions, each partition
    is totalled, the partitions' totals (one row per partition and group) are accumulated, and a window within each
    partition does the rest. Only a partition's first group can have rows before it, so what comes before is at most one row a
    partition and is broadcast. Rows that agree in ``order`` follow each other in any order and are split over
    partitions too. ``group`` and ``order`` columns may be null; other columns are carried along, whatever their names.
    ``keep`` names a column for a row's partition; ``by`` names such a column of an earlier call with the same groups and
    an order that agrees with ``order``, whose partitions serve again (``df`` has to be stored then).
    """
    spark = df.sparkSession
    group, order = list(group), list(order)
    stem = free_stem(df, "_rt_")
    tie, part, total_of = f"{stem}tie", f"{stem}part", f"{stem}of"
    same_group = [f"{stem}g{i}" for i in range(len(group))]
    before_of = {k: f"{stem}b{i}" for i, k in enumerate(totals)}
    ranged = df.withColumn(tie, F.monotonically_increasing_id())
    if by:
        ranged = ranged.withColumn(part, F.col(f"`{by}`"))
    else:
        ranged = ranged.repartitionByRange(partitions(spark), *group, *order, tie)
        ranged = stored(ranged.withColumn(part, F.spark_partition_id()))
    parts = ranged.groupBy(*group, part).agg(*[c.alias(k) for k, c in totals.items()])
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    later = F.count(F.lit(1)).over(earlier) > 0
    before = parts.select(*[F.col(g).alias(s) for g, s in zip(group, same_group)], F.col(part).alias(total_of), later.alias(tie), *[
        (F.bit_xor if k in xor else F.sum)(k).over(earlier).alias(before_of[k]) for k in totals]).filter(F.col(tie)).drop(tie)
    within = Window.partitionBy(*group, part).orderBy(*order, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.col(part) == F.col(total_of)
    for g, s in zip(group, same_group):
        same = same & F.col(g).eqNullSafe(F.col(s))
    out = ranged.withColumns({k: c.over(within) for k, c in totals.items()}).join(F.broadcast(before), same, "left")
    more = {k: F.coalesce(F.col(b), F.lit(0)) for k, b in before_of.items()}
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[
        (F.col(k).bitwiseXOR(more[k]) if k in xor else F.col(k) + more[k]).alias(k) for k in totals],
        *([F.col(part).alias(keep)] if keep else []))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list of longs: rows (node, component = its smallest node).

    Large-star and small-star steps in turn until nothing changes. Neighbourhood minima are partial
    aggregates joined back to the edges, so a node with very many edges is split by the
    skew join and is never gathered; every round is cut off by a checkpoint.
    """
    e = stored(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter("v != u").distinct())
    while True:
        both = e.union(e.select(F.col("u").alias("v"), F.col("v").alias("u")))   # v sees u
        low = both.groupBy(F.col("v").alias("n")).agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.join(low, F.col("v") == F.col("n")).filter("u > v").select(
            F.col("u").alias("v"), F.col("m").alias("u")).filter("v != u").distinct()
        low = large.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        small = large.join(low, F.col("v") == F.col("n"))
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).union(
            low.select(F.col("n").alias("v"), F.col("m").alias("u"))).filter("v != u").distinct()
        small = stored(small)
        if _digest(small) == _digest(e):
            return small.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
                small.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
        e = small


def _digest(e: DataFrame) -> tuple:
    h = F.xxhash64("v", "u")
    return tuple(e.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())
