"""Reversible, incremental line dedup: sharded cuckoo filters backed by exact reference counts.

An index is a folder: ``counts`` has for every key of a line the number of documents that hold it (exactly), ``filters`` a
cuckoo filter a shard over the keys found in at least ``at_least`` documents. Inserting documents adds to the
counts and puts the keys that reach the threshold into their shards' filters; deleting documents takes both back,
which a cuckoo filter allows as it holds fingerprints and not bits. Each change writes a new folder and leaves the old one
as it was. To drop lines, every line's key meets its shard's filter (a shard's lines are split over
many groups, so a line that is everywhere doesn't meet in one task); the few keys that a filter holds are looked
up in the exact counts, which takes out its false positives; filters have no false negatives.

A key is the first 16 bytes of the SHA-256 of the line, stripped of ASCII white space and in ASCII lower case. A row of
the table is a document; a key counts once for it, however often it occurs.

Defined results: a null or empty text is one empty line; lines whose key has fewer than ``min_chars`` code points stay and
aren't counted; rows that repeat are documents of their own; ids aren't read and may be null; deleting a row that
wasn't inserted raises an error if it would take a count below zero; an empty table gives an empty index
or no rows; extra columns are carried along, and new columns whose names clash get underscores before them.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import free_name, free_stem, partitions, ship

SPACE = b" \t\n\x0b\x0c\r"
SLOTS = 4               # fingerprints a bucket
FULL = 0.9              # load at which a shard's filter is built anew
KICKS = 500
SHARD_KEYS = 50_000     # keys a shard should have; the index is cut into more shards as it grows past that
FLUSH = 100_000         # counted keys that a task holds before it hands them on

_STATE = "shard int, buckets int, size long, slots binary, stash binary"


def line_key(line: bytes) -> bytes:
    """The line stripped of ASCII white space, in ASCII lower case."""
    return line.strip(SPACE).lower()


def digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:16]


def _points(key: bytes, least: int) -> bool:
    """Whether ``key`` has at least ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def keys_of(text: bytes, min_chars: int) -> set[bytes]:
    """The digests of the distinct keys of a whole text."""
    return {digest(k) for k in {line_key(x) for x in text.split(b"\n")} if _points(k, min_chars)}


class CuckooFilter:
    """A set of 16-byte digests kept as 16-bit fingerprints, each in one of two buckets of four.

    Digests put in are always found; others are, about once in 8,000 times. Only digests that were put in may be taken
    out. What finds no place goes to a stash of (fingerprint, bucket), so nothing is ever lost.
    """

    def __init__(self, buckets: int, slots: bytes = b"", stash: bytes = b"", size: int = 0):
        self.buckets, self.size = buckets, size
        self.slots = (np.frombuffer(slots, "<u2").reshape(buckets, SLOTS).copy() if slots
                      else np.zeros((buckets, SLOTS), "<u2"))
        self.stash = [tuple(x) for x in np.frombuffer(stash, "<i8").reshape(-1, 2).tolist()]

    @staticmethod
    def buckets_for(n: int) -> int:
        """A power of two that holds n digests and half as many again."""
        return 1 << max(0, int(np.ceil(np.log2(max(1, n) * 1.5 / SLOTS / FULL))))

    def _jump(self, print_: np.ndarray) -> np.ndarray:
        z = print_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (z >> np.uint64(20)) & np.uint64(self.buckets - 1)

    def _places(self, digests: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (not 0) and both buckets of each digest."""
        d = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        print_ = np.maximum(d[:, 1] & np.uint64(0xFFFF), np.uint64(1))
        first = d[:, 0] & np.uint64(self.buckets - 1)
        return print_.astype(np.int64), first.astype(np.int64), (first ^ self._jump(print_)).astype(np.int64)

    def holds(self, digests: list[bytes]) -> np.ndarray:
        if not digests:
            return np.zeros(0, bool)
        print_, a, b = self._places(digests)
        found = ((self.slots[a] == print_[:, None]) | (self.slots[b] == print_[:, None])).any(1)
        for p, at in self.stash:
            found |= (print_ == p) & ((a == at) | (b == at))
        return found

    def add(self, digests: list[bytes]) -> None:
        turn = 0
        for p, a, b in zip(*(x.tolist() for x in self._places(digests))) if digests else ():
            self.size += 1
            at = a
            for here in (a, b):
                empty = np.flatnonzero(self.slots[here] == 0)
                if len(empty):
                    self.slots[here, empty[0]] = p
                    break
            else:
                for _ in range(KICKS):
                    turn += 1
                    spot = (turn * 7 + turn // SLOTS) % SLOTS
                    p, self.slots[at, spot] = int(self.slots[at, spot]), p
                    at = int(at ^ int(self._jump(np.array([p]))[0]))
                    empty = np.flatnonzero(self.slots[at] == 0)
                    if len(empty):
                        self.slots[at, empty[0]] = p
                        break
                else:
                    self.stash.append((p, at))

    def remove(self, digests: list[bytes]) -> None:
        for p, a, b in zip(*(x.tolist() for x in self._places(digests))) if digests else ():
            self.size -= 1
            for here in (a, b):
                found = np.flatnonzero(self.slots[here] == p)
                if len(found):
                    self.slots[here, found[0]] = 0
                    break
            else:
                self.stash.remove((p, a) if (p, a) in self.stash else (p, b))

    def row(self, shard: int) -> list:
        return [shard, self.buckets, self.size, self.slots.tobytes(), np.array(self.stash, "<i8").tobytes()]


def shard_of(key: Column | str, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def key_counts(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """(key, docs): the documents that hold each key. Tasks count what they read before anything is shuffled."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())],
                                             ["key", "docs"])
            held.clear()
            return out

        for batch in batches:
            for t in batch.column(0):
                held.update(keys_of(t.as_py() or b"", min_chars))
                if len(held) >= FLUSH:
                    yield rows()
        yield rows()

    found = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "key binary, docs long")
    return found.groupBy("key").agg(F.sum("docs").alias("docs"))


@dataclass(frozen=True)
class LineIndex:
    """A stored index; see the module. ``at`` is its folder, on storage that all executors share."""

    spark: SparkSession
    at: str

    @classmethod
    def create(cls, docs: DataFrame, at: str, text: str = "text", at_least: int = 10, min_chars: int = 1) -> LineIndex:
        """A new index over ``docs`` in the folder ``at``."""
        spark = docs.sparkSession
        spark.createDataFrame([(at_least, min_chars)], "at_least int, min_chars int").coalesce(1).write.parquet(f"{at}/settings")
        delta = key_counts(docs, text, min_chars).select("key", F.lit(0).cast("long").alias("before"), "docs")
        return _written(spark, delta, None, at, at_least)

    @property
    def settings(self) -> tuple[int, int]:
        """(at_least, min_chars)"""
        return tuple(self.spark.read.parquet(f"{self.at}/settings").first())

    @property
    def counts(self) -> DataFrame:
        """(key, docs): exact, every key of the indexed documents."""
        return self.spark.read.parquet(f"{self.at}/counts").filter("docs > 0").select("key", "docs")

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.at}/filters")

    def insert(self, docs: DataFrame, at: str, text: str = "text") -> LineIndex:
        """This index with more documents, written to the folder ``at``."""
        return self._changed(docs, at, text, 1)

    def delete(self, docs: DataFrame, at: str, text: str = "text") -> LineIndex:
        """This index without documents that were inserted, written to the folder ``at``."""
        return self._changed(docs, at, text, -1)

    def _changed(self, docs: DataFrame, at: str, text: str, sign: int) -> LineIndex:
        at_least, min_chars = self.settings
        none = F.lit(0).cast("long")
        both = self.counts.select("key", F.col("docs").alias("before"), none.alias("change")).unionByName(
            key_counts(docs, text, min_chars).select("key", none.alias("before"), (sign * F.col("docs")).alias("change")))
        after = F.sum("before") + F.sum("change")
        delta = both.groupBy("key").agg(F.sum("before").alias("before"), after.alias("docs"))
        checked = F.assert_true(F.col("docs") >= 0, F.lit("a deleted document wasn't in the index"))
        self.spark.read.parquet(f"{self.at}/settings").coalesce(1).write.parquet(f"{at}/settings")
        return _written(self.spark, delta.filter(checked.isNull()), self, at, at_least)

    def droppable(self) -> DataFrame:
        """The keys found in enough documents, by the exact counts."""
        return self.counts.filter(F.col("docs") >= self.settings[0]).select("key")

    def drop_lines(self, docs: DataFrame, text: str = "text", groups: int | None = None) -> DataFrame:
        """``docs`` with kept_text, n_lines and n_dropped: the text without its droppable lines.

        ``groups`` is the number of groups over which the lines of all documents are dealt (default: four for each
        shuffle partition); each holds a share of a shard's lines beside that shard's filter.
        """
        spark, (_, min_chars) = self.spark, self.settings
        ship(spark)
        n, kept, dropped = (free_name(docs, x) for x in ("n_lines", "kept_text", "n_dropped"))
        named, gone = free_stem(docs, "_text_id"), free_stem(docs, "_gone")
        whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        text_id = F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)

        def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, keys = [], []
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = keys_of(t.as_py(), min_chars)
                    keys += found
                    ids += [i] * len(found)
                    if len(keys) >= FLUSH:
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(keys, pa.binary())], ["text_id", "key"])
                        ids, keys = [], []
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(keys, pa.binary())], ["text_id", "key"])

        def probe(at: tuple, asked: pa.Table, state: pa.Table) -> pa.Table:
            if not state.num_rows:
                return asked.select(["text_id", "key"]).slice(0, 0)
            s = state.to_pylist()[0]
            held = CuckooFilter(s["buckets"], s["slots"], s["stash"], s["size"]).holds(asked["key"].to_pylist())
            return asked.select(["text_id", "key"]).filter(pa.array(held))

        filters = self.filters
        shards = filters.count()
        if not shards:
            found = spark.createDataFrame([], "text_id binary, gone array<binary>")
        else:
            salts = max(1, -(-(groups or 4 * partitions(spark)) // shards))
            salt = F.pmod(F.xxhash64("text_id", F.spark_partition_id()), F.lit(salts)).cast("int")
            asked = docs.select(text_id.alias("text_id"), whole.cast("binary").alias("text")).mapInArrow(
                lines, "text_id binary, key binary").select("text_id", "key", shard_of("key", shards).alias("shard"), salt.alias("salt"))
            states = filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            maybe = asked.groupBy("shard", "salt").cogroup(states.groupBy("shard", "salt")).applyInArrow(
                probe, "text_id binary, key binary").distinct()
            sure = maybe.join(self.droppable(), "key", "left_semi")
            found = sure.groupBy("text_id").agg(F.collect_set("key").alias("gone"))
        # a computed key: the groups are dealt once more, so that Spark can split a text with very many copies in the join
        found = found.select(F.substring("text_id", 1, 16).alias(f"{named}_r"), F.col("gone").alias(gone))
        out = docs.withColumn(named, text_id).join(found, F.col(named) == F.col(f"{named}_r"), "left")
        cut = _without(F.when(F.col(gone).isNotNull(), whole.cast("binary")), F.col(gone))
        out = out.withColumn(named, cut)
        return out.select(*[F.col(f"`{c}`") for c in docs.columns],
                          F.when(F.col(gone).isNull(), whole).otherwise(F.col(named)["kept"]).alias(kept),
                          F.size(F.split(whole, "\n", -1)).cast("long").alias(n),
                          F.coalesce(F.col(named)["dropped"], F.lit(0)).cast("long").alias(dropped))


@F.pandas_udf(T.StructType([T.StructField("kept", T.StringType()), T.StructField("dropped", T.LongType())]))
def _without(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
    """Texts without the lines whose keys are gone; a null text gives nulls."""
    kept, dropped = [], []
    for t, keys in zip(text, gone):
        if t is None:
            kept.append(None)
            dropped.append(None)
            continue
        keys = set(map(bytes, keys))
        lines = bytes(t).split(b"\n")
        stay = [x for x in lines if digest(line_key(x)) not in keys]
        kept.append(b"\n".join(stay).decode())
        dropped.append(len(lines) - len(stay))
    return pd.DataFrame({"kept": kept, "dropped": pd.array(dropped, "Int64")})


def _written(spark: SparkSession, delta: DataFrame, old: LineIndex | None, at: str, at_least: int) -> LineIndex:
    """Write ``delta`` (key, before, docs) and the filters that follow from it and the old index's filters."""
    ship(spark)
    # keys that a deletion left without documents stay in this version with count 0: their filters must forget them
    delta.filter("docs > 0 or before > 0").write.parquet(f"{at}/counts")
    counts = spark.read.parquet(f"{at}/counts")
    there = F.col("docs") >= at_least
    before = old.filters.select("shard", F.col("buckets").alias("old_buckets")) if old else None
    total, had = counts.filter(there).count(), old.filters.count() if old else 0
    shards = had if had and total <= 2 * had * SHARD_KEYS else max(1, -(-total // SHARD_KEYS))
    keyed = counts.withColumn("shard", shard_of("key", shards))
    sizes = spark.range(shards).select(F.col("id").cast("int").alias("shard")).join(
        keyed.filter(there).groupBy("shard").agg(F.count("*").alias("total")), "shard", "left").fillna(0, ["total"])
    if had == shards:
        sizes = sizes.join(before, "shard", "left")
    else:
        sizes = sizes.withColumn("old_buckets", F.lit(None).cast("int"))
    anew = F.col("old_buckets").isNull() | (F.col("total") > F.lit(FULL * SLOTS) * F.col("old_buckets"))
    sizes = sizes.select("shard", "total", anew.alias("anew"))
    moved = (F.col("before") >= at_least) != there
    changes = keyed.join(sizes.select("shard", "anew"), "shard").filter(F.when(F.col("anew"), there).otherwise(moved)).select(
        "shard", "key", there.alias("enters"))
    states = sizes
    if had == shards:
        states = states.join(old.filters, "shard", "left")
    else:
        states = states.withColumns({"buckets": F.lit(0), "size": F.lit(0).cast("long"), "slots": F.lit(None).cast("binary"),
                                     "stash": F.lit(None).cast("binary")})

    def change(shard: tuple, moves: pa.Table, state: pa.Table) -> pa.Table:
        s = state.to_pylist()[0]
        held = (CuckooFilter(CuckooFilter.buckets_for(s["total"])) if s["anew"]
                else CuckooFilter(s["buckets"], s["slots"], s["stash"], s["size"]))
        enters = moves["enters"].to_pylist()
        keys = moves["key"].to_pylist()
        held.remove(sorted(k for k, e in zip(keys, enters) if not e))
        held.add(sorted(k for k, e in zip(keys, enters) if e))
        row = held.row(s["shard"])
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], [c.split()[0] for c in _STATE.split(", ")])

    changes.groupBy("shard").cogroup(states.groupBy("shard")).applyInArrow(change, _STATE).write.parquet(f"{at}/filters")
    return LineIndex(spark, at)
