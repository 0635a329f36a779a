"""Reproducible sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered in the order of given columns, the numbers are permuted, and row p of the permuted order goes
to shard p mod n, slot p div n: counts differ by one at most and slots have no gaps. Where a numbered row goes,
and which row a slot holds, is computed without looking at the data.

Defined results: rows that agree in the ordering columns are numbered in any order (they are alike in them); nulls are
numbered first; an empty table gives no rows; extra columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import free_name, running_totals, ship

ROUNDS = 6


def _mixed(x: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """64 well-mixed bits of each value (splitmix64 finalizer)."""
    z = x + np.uint64((0x9E3779B97F4A7C15 * (seed * ROUNDS + turn + 1)) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _halves(n: int) -> tuple[np.uint64, np.uint64]:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return np.uint64(a), np.uint64(max(1, -(-n // a)))


def permute(numbers: np.ndarray, n: int, seed: int = 0, inverse: bool = False) -> np.ndarray:
    """The place of each of the numbers 0..n-1, or with ``inverse`` the number at each place.

    A number is (left, right) in an a x b grid just above n cells; rounds add a mix of one half to the other in
    turn, and a result beyond n goes through again until it isn't (the cycle leads back below n).
    """
    a, b = _halves(n)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    turns = range(ROUNDS)[::-1] if inverse else range(ROUNDS)
    while len(todo):
        left, right = out[todo] // b, out[todo] % b
        for t in turns:
            if t % 2:
                f = _mixed(left, seed, t) % b
                right = (right + (b - f if inverse else f)) % b
            else:
                f = _mixed(right, seed, t) % a
                left = (left + (a - f if inverse else f)) % a
        out[todo] = left * b + right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def locate(number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of a row number."""
    p = int(permute(np.array([number]), n, seed)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number that a slot holds."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    @F.pandas_udf(T.LongType())
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    return place(number)


def assign(df: DataFrame, order: Sequence[str], shards: int = 8, seed: int = 0) -> DataFrame:
    """Add row_number (from 0), shard and slot; names that clash get underscores before them."""
    ship(df.sparkSession)
    number, shard, slot = (free_name(df, x) for x in ("row_number", "shard", "slot"))
    n = df.count()
    numbered = running_totals(df, [], order, {number: F.count(F.lit(1))}).withColumn(number, F.col(number) - 1)
    placed = numbered.withColumn(slot, permuted(F.col(number), n, seed))
    return placed.withColumns({shard: (F.col(slot) % shards).cast("int"), slot: F.expr(f"`{slot}` div {shards}")})


def write(assigned: DataFrame, path: str, shards: int = 8, slots_per_file: int = 1_000_000) -> None:
    """Parquet by shard, in order of slots, a file for each run of ``slots_per_file`` slots."""
    run = F.floor(F.col("slot") / slots_per_file)
    assigned.withColumn("run", run).repartition("shard", "run").sortWithinPartitions("shard", "slot").drop(
        "run").write.partitionBy("shard").parquet(path)
