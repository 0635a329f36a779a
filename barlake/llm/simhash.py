"""SimHash near-duplicates by a binary trie self-join.

The fingerprint takes each bit that is set in over half of the XXH64 hashes of a document's shingles.
Two fingerprints within ``distance`` bits of each other agree in one of ``distance + 1`` blocks of bits, so
each distinct fingerprint goes once per block, keyed by that block's bits, to the task that joins its trie:
there the trie below the key is joined with itself, node pair by node pair, adding up the bits in which
the two paths differ, dropping a pair as soon as the sum exceeds ``distance``, and dropping pairs whose
leaves are already all linked. What a task emits is a spanning forest of its links, never all
pairs. A key with too many fingerprints is split in the same way by blocks of the bits that it doesn't fix, again and again
until its parts are small: links within it agree in one of those blocks too, so none is lost, and each level places a
fingerprint ``distance + 1`` times. Components of the forests' union give the classes.

Defined results: a null text counts as empty; a text without words has fingerprint 0, linked like any other; a null
doc_id belongs to its class but never names it unless the whole class has none; repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import components, free_name, partitions, ship, stored

GROUP = 30_000      # fingerprints of one key that a task takes together; above, the key is split by further bits
TASK = 120_000      # fingerprints that a task should get
FRONTIER = 1 << 20  # node pairs expanded at once
LEAVES = 128        # pairs of rows up to which a node pair is settled at once

_FP = (1 << 64) - 1


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of the words of a text (ASCII lower case, shingles with repeats)."""
    words = text.lower().split() if text else []    # bytes split at the ASCII white space alone
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        line, h = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-shingle] + 1))
        hashes = [h(line[s:e], 42) for s, e in zip(starts.tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        h = np.array(hashes[at:at + (1 << 14)], np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(text: Column | str, shingle: int = 4) -> Column:
    """The fingerprint of each whole text as a (signed) long."""

    @F.pandas_udf(T.LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.Series(fps.view(np.int64))

    return of(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def finer(fixed: int, n: int) -> list[int]:
    """The bits ``fixed`` (a mask of 64) with each of n blocks of the other bits, neighbours in a block."""
    free = [i for i in range(63, -1, -1) if not fixed >> i & 1]
    size, more = divmod(len(free), n)
    ends = [0]
    for i in range(n):
        ends.append(ends[-1] + size + (i < more))
    return [fixed | sum(1 << i for i in free[s:e]) for s, e in zip(ends, ends[1:])]


def without(fp: np.ndarray, fixed: int) -> np.ndarray:
    """The bits of the fingerprints that ``fixed`` leaves out, moved to the left."""
    rest, at, width = np.zeros(len(fp), np.uint64), 63, 0
    while at >= 0:
        low = at
        while low >= 0 and not fixed >> low & 1:
            low -= 1
        n = at - low
        if n:
            part = (fp >> np.uint64(low + 1)) & np.uint64((1 << n) - 1)
            rest = (rest << np.uint64(n) if n < 64 else rest) | part
            width += n
        at = low - 1
    return rest << np.uint64(64 - width) if 0 < width < 64 else rest


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of a[i] and b[i]; root[x] is the smallest row of x's class."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _common_bits(r: np.ndarray, same: np.ndarray) -> np.ndarray:
    """The leading bits that each row shares with the one before it; -1 where ``same`` is false."""
    x = r[1:] ^ r[:-1]
    zeros = np.zeros(len(x), np.int16)
    equal = x == 0
    for s in (32, 16, 8, 4, 2, 1):
        empty = (x >> np.uint64(64 - s)) == 0
        zeros[empty] += s
        x = np.where(empty, x << np.uint64(s), x)
    zeros[equal] = 64
    return np.concatenate((np.full(1, -1, np.int16), np.where(same, zeros, -1).astype(np.int16)))


def _leaf_pairs(s: np.ndarray, e: np.ndarray, u: np.ndarray, v: np.ndarray) -> Iterator[tuple]:
    """The pairs of rows of pairs of small runs, FRONTIER runs' worth at a time."""
    step = max(1, 4 * FRONTIER // LEAVES)
    for at in range(0, len(s), step):
        c = slice(at, at + step)
        wide = v[c] - u[c]
        n = (e[c] - s[c]) * wide
        of = np.repeat(np.arange(len(n)), n)
        i = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        yield s[c][of] + i // wide[of], u[c][of] + i % wide[of]


def trie_classes(key: np.ndarray, rest: np.ndarray, distance: int) -> np.ndarray:
    """Join the tries of equal keys with themselves; for each row the smallest row of its class.

    A trie node at depth d is a run [s, e) of the sorted rows with equal key and equal first d bits. It splits where
    a row shares exactly d bits with the row before; there is at most one such row in a run. Pairs of runs go down
    together, self pairs from the roots on; the last few leaves of a pair are settled by popcount.
    """
    order = np.lexsort((rest, key))
    k, r = key[order], rest[order]
    n = len(r)
    root = np.arange(n)
    if n < 2:
        return root
    same = k[1:] == k[:-1]
    common = _common_bits(r, same)
    for turn in (0, 13, 26, 39):     # link neighbours in a few sorted orders first: dense classes then prune early
        t = np.uint64(turn)
        turned = r if not turn else (r << t) | (r >> np.uint64(64 - turn))
        at = np.arange(n) if not turn else np.lexsort((turned, k))
        near = (np.bitwise_count(r[at[1:]] ^ r[at[:-1]]) <= distance) & (k[at[1:]] == k[at[:-1]])
        root = _merge(root, at[1:][near], at[:-1][near])
    by_depth = np.argsort(common, kind="stable")
    bounds = np.searchsorted(common[by_depth], np.arange(66))

    def middle(s: np.ndarray, e: np.ndarray, depth: int) -> np.ndarray:
        """Where the runs' rows with bit ``depth`` set begin."""
        splits = by_depth[bounds[depth]:bounds[depth + 1]]
        m = np.where((r[s] >> np.uint64(63 - depth)) & np.uint64(1) == 0, e, s)
        if len(splits):
            p = np.searchsorted(splits, s + 1)
            t = splits[np.minimum(p, len(splits) - 1)]
            inside = (p < len(splits)) & (t > s) & (t < e)
            m = np.where(inside, t, m)
        return m

    first = np.flatnonzero(common == -1)
    last = np.append(first[1:], n)
    stack = [(0, first, last, first, last, np.zeros(len(first), np.int8))]
    change = None
    while stack:
        depth, s, e, u, v, bits = stack.pop()
        if change is None:       # runs of one class: as many changes before their last row as before their first
            change = np.concatenate(([0], np.cumsum(root[1:] != root[:-1])))
        linked = (change[s] == change[e - 1]) & (change[u] == change[v - 1]) & (root[s] == root[u])
        few = (e - s) * (v - u) <= LEAVES
        for a, b in _leaf_pairs(*(c[few & ~linked] for c in (s, e, u, v))):
            near = (np.bitwise_count(r[a] ^ r[b]) <= distance) & (a < b)
            if near.any():
                root, change = _merge(root, a[near], b[near]), None
        go = ~(linked | few)
        if not go.any() or depth == 64:
            continue
        s, e, u, v, bits = s[go], e[go], u[go], v[go], bits[go]
        if len(s) > FRONTIER:
            for at in range(0, len(s), FRONTIER):
                c = slice(at, at + FRONTIER)
                stack.append((depth, s[c], e[c], u[c], v[c], bits[c]))
            continue
        m, w, own = middle(s, e, depth), middle(u, v, depth), s == u
        found = []
        for cs, ce, cu, cv, differ, rule in ((s, m, u, w, 0, None), (m, e, w, v, 0, None),
                                             (s, m, w, v, 1, None), (m, e, u, w, 1, ~own)):
            ok = (cs < ce) & (cu < cv) & (bits + differ <= distance)
            if rule is not None:
                ok &= rule
            found.append((cs[ok], ce[ok], cu[ok], cv[ok], bits[ok] + np.int8(differ)))
        stack.append((depth + 1, *[np.concatenate(c) for c in zip(*found)]))
    out = np.empty(n, np.int64)
    out[order] = order[root]
    return out


def _placed(fps: DataFrame, distance: int) -> tuple[DataFrame, int]:
    """Each distinct fingerprint once for each of its keys, as (fp, fixed), and how many rows that are at most.

    A key is the fingerprint's bits under the mask ``fixed``. The masks, of which there are ``distance + 1`` for each one
    that had a large key, are all that the driver sees; a key of over GROUP fingerprints leaves more than 14 bits
    free, so there are at most seven levels.
    """
    spark, n = fps.sparkSession, distance + 1
    rows = fps.count() * n
    at = fps.select("fp", F.explode(F.array(*[F.lit(signed(m)).cast("long") for m in finer(0, n)])).alias("fixed"))
    done = []
    while True:
        at = at.withColumn("key", F.col("fp").bitwiseAND(F.col("fixed")))
        open_ = F.bit_count("fixed") <= 64 - 2 * n      # with fewer bits free a key has at most 4^n fingerprints
        large = stored(at.groupBy("fixed", "key").count().filter((F.col("count") > GROUP) & open_))
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, at.select("fp", "fixed")]), rows
        done.append(at.join(large, ["fixed", "key"], "left_anti").select("fp", "fixed"))
        split = stored(at.join(large, ["fixed", "key"], "left_semi").select("fp", "fixed"))
        masks = [r.fixed for r in large.select("fixed").distinct().collect()]
        below = spark.createDataFrame([(m, signed(x)) for m in masks for x in finer(m & _FP, n)], "was long, fixed long")
        at = split.withColumnRenamed("fixed", "was").join(F.broadcast(below), "was").select("fp", "fixed")
        rows += n * large.agg(F.sum("count")).first()[0]


def classes(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(node, component) for every distinct long in ``fps.fp`` that is linked to another one."""
    spark = fps.sparkSession
    ship(spark)
    placed, n = _placed(fps, distance)
    tasks = max(partitions(spark), -(-n // TASK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        fp, fixed = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in parts]).view(np.uint64) for c in (0, 1))
        rest = np.zeros(len(fp), np.uint64)
        for mask in np.unique(fixed):
            own = fixed == mask
            rest[own] = without(fp[own], int(mask))
        key = fp & fixed
        order = np.lexsort((key, fixed))
        new = np.zeros(len(fp), bool)
        for c in (fixed, key):
            new[1:] |= c[order][1:] != c[order][:-1]
        group = np.empty(len(fp), np.int64)
        group[order] = np.cumsum(new)
        top = trie_classes(group, rest, distance)
        linked = np.flatnonzero(top != np.arange(len(fp)))
        a, b = (x.view(np.int64) for x in (fp[linked], fp[top[linked]]))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = placed.repartition(tasks, "fixed", F.col("fp").bitwiseAND(F.col("fixed")))
    return components(dealt.select("fp", "fixed").mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                    distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for each row: the smallest doc_id of its class. Only slim rows are shuffled."""
    ship(docs.sparkSession)
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(text, shingle).alias("fp")))
    first = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = stored(classes(first.select("fp"), distance))
    named = first.join(linked, F.col("fp") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = named.groupBy(F.col("component").alias("c")).agg(F.min("first").alias("component_id"))
    named = named.join(least, F.col("component") == F.col("c")).select(F.col("fp").alias("f"), "component_id")
    return rows.join(named, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                distance: int = 4) -> DataFrame:
    """One row of each class: that with the smallest doc_id (null last), of those the least by hash of all columns."""
    key, pick = free_name(docs, "_key"), free_name(docs, "_pick")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    ship(docs.sparkSession)
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), whole.alias("row"), fingerprints(text, shingle).alias("fp")))
    first = stored(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
                                          .alias("first")))
    linked = stored(classes(first.select("fp"), distance))
    kept = first.join(linked, F.col("fp") == F.col("node"), "left")
    kept = kept.groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias(pick)).select(
        F.col(f"{pick}.row").alias(pick), F.col(f"{pick}.doc_id").alias(f"{pick}_id"))
    out = docs.withColumn(key, whole).join(
        kept, (F.col(key) == F.col(pick)) & F.col(f"`{doc_id}`").eqNullSafe(F.col(f"{pick}_id")))
    # rows equal in every column have one key and stay one row; the join has dealt them by it already
    return out.dropDuplicates([key, f"{pick}_id"]).select(*[F.col(f"`{c}`") for c in docs.columns])
