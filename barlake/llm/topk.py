"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become sparse rows of integers. Queries and candidates are dealt into blocks; a task gets one block of each,
turns the candidates into postings by term, scatters each query weight times a term's postings into dense
arrays of scores, and keeps the k best by partition selection; the blocks' winners are merged by a window.

Defined results: a vector that is null or holds a null or non-finite component, or has no id, takes no part; vectors of
unequal length meet in the terms both have; rows with the query's id are its own; equal query rows are one query;
repeated candidates each take a rank; a table without queries gives no rows. Scores are exact below 2^63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import partitions, ship

CANDIDATES, QUERIES = 1 << 16, 1 << 12      # rows of a block at most, about
SCORES = 1 << 22                            # scores held at once


def whole_numbers(vectors: DataFrame, scale: float = 1024.0) -> DataFrame:
    """(vec_id, v): the vectors that take part, each component x as floor(scale * x)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | F.abs(x).eqNullSafe(F.lit(float("inf"))))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        "vec_id", v.alias("v"))


def _postings(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bounds by term, rows, weights, row count) of the non-zero components, by term."""
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    weight = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    term = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    full = weight != 0
    row, term, weight = row[full], term[full], weight[full]
    by = np.argsort(term, kind="stable")
    top = int(term.max()) + 1 if len(term) else 0
    return np.searchsorted(term[by], np.arange(top + 1)), row[by], weight[by], lengths


def best(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of each query of a block."""
    ids, own = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    bounds, rows, weights, _ = _postings(candidates["v"])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, SCORES // max(1, len(ids)))
    never = np.iinfo(np.int64).min
    for at in range(0, len(own), step):
        q_bounds, q_rows, q_weights, lengths = _postings(queries["v"].slice(at, step))
        scores = np.zeros((len(lengths), len(ids)), np.int64)
        for t in range(min(len(bounds), len(q_bounds)) - 1):
            c, q = slice(bounds[t], bounds[t + 1]), slice(q_bounds[t], q_bounds[t + 1])
            for r, w in zip(q_rows[q], q_weights[q]):
                if c.stop - c.start == len(ids):
                    scores[r] += w * weights[c]
                else:
                    scores[r, rows[c]] += w * weights[c]      # a row has a term once
        for i, line in enumerate(scores):
            me = own[at + i]
            line[ids == me] = never
            n = min(k, int((ids != me).sum()))
            if not n:
                continue
            least = np.partition(line, len(line) - n)[len(line) - n]
            found = np.flatnonzero(line >= least)
            found = found[np.lexsort((ids[found], -line[found]))[:n]]
            out.append((np.full(n, at + i), ids[found], line[found]))
    which, vec, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    return pa.table({"query_id": queries["vec_id"].take(pa.array(which)), "which": queries["which"].take(pa.array(which)),
                     "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.int64())})


def dealt(vectors: DataFrame, is_query: Column) -> tuple[DataFrame, DataFrame]:
    """Queries and candidates in their blocks (qb, cb), each query block beside each candidate block.

    Rows of one id are dealt to all blocks: a candidate by its place in the table, a query by its vector.
    """
    asked = vectors.filter(is_query).withColumn("which", F.xxhash64("v")).dropDuplicates(["vec_id", "v"])
    n, m = vectors.count(), asked.count()
    blocks = max(partitions(vectors.sparkSession), -(-n // CANDIDATES))
    groups = max(1, -(-m // QUERIES))
    place = lambda salt: F.xxhash64(F.lit("block"), "vec_id", salt)
    cand = vectors.withColumn("cb", F.pmod(place(F.monotonically_increasing_id()), F.lit(blocks))).withColumn(
        "qb", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    return asked.withColumn("qb", F.pmod(place(F.col("which")), F.lit(groups))).withColumn(
        "cb", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))), cand


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) from rows (vec_id, v): each query's k best, ties to the smaller id."""
    spark = vectors.sparkSession
    ship(spark)
    asked, cand = dealt(vectors, is_query)

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        return best(q, c, k)

    found = asked.groupBy("cb", "qb").cogroup(cand.groupBy("cb", "qb")).applyInArrow(
        run, "query_id long, which long, vec_id long, score long")
    by = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
