"""Ranked lexical search by MaxScore with pair bounds.

The documents are cut into blocks. A block's index has for every term a list of (document, value) and the greatest impact,
and for pairs of terms the list of documents that hold both, with the greatest impact that the two have together in
one document. A query's terms are paired, and each pair of terms bounds what a document can gain by it: a term's own
maximum if it holds that one, the joint maximum if it holds both, which is at most the sum of the two maxima and
often far less (terms that never meet in the block don't add up at all). So a pair can be searched for at four levels: the
documents of both lists; those that hold the term with the greater maximum; those that hold both; none. Each
level leaves out documents that gain at most the lesser maximum, the greater one, or the joint one. Levels are chosen
that save most postings while what is left out stays, all pairs together, below the score to beat; a candidate is dropped
as soon as its score so far and the bounds of what is left stay below.
One block in eight is searched first; the k-th score in there is what documents elsewhere must beat.

All numbers are 64-bit integers but for the logarithm. Terms are runs of ASCII letters and digits and of all characters
beyond ASCII, A-Z lower-cased. A pass takes up to ``items_per_pass`` queries, so what is broadcast (their terms,
pairs, weights and scores to beat) is bounded by that parameter; more queries take more passes over the documents.

Defined results: a null text holds no terms; documents without terms don't count; equal scores rank by ascending doc_id, null
last; rows that repeat are documents of their own; queries that repeat in id and text are one; a query without terms,
or whose terms occur nowhere, and an empty table give no rows; extra columns aren't read.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import shared_dir, ship

BLOCK = 8192            # documents of a block at most
FIRST = 8               # one block in so many is searched first
ITEMS_PER_PASS = 2000   # queries whose terms are broadcast together

_TERM = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()   # bytes.lower is ASCII only


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a whole text, in order."""
    return (text or b"").translate(_TERM).split()


@dataclass
class Queries:
    """The queries of a pass: distinct terms by number, each query's term numbers, and (once known) weights and pairs."""

    ids: list
    terms: dict[bytes, int]
    of: list[list[int]]
    weight: np.ndarray | None = None
    pairs: list[list[tuple[int, int]]] = field(default_factory=list)    # per query; (t, -1): a term without partner
    beat: np.ndarray | None = None                                      # the least score that can still rank

    @property
    def all_pairs(self) -> list[tuple[int, int]]:
        return sorted({p for own in self.pairs for p in own if p[1] >= 0})

    def weigh(self, documents: int, holding: dict[int, int]) -> None:
        """Weights of the terms that occur, and pairs of neighbours in the order of weight within each query."""
        self.weight = np.zeros(len(self.terms), np.int64)
        for t, df in holding.items():
            self.weight[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        self.pairs = []
        for own in self.of:
            live = sorted((t for t in own if self.weight[t] > 0), key=lambda t: (self.weight[t], t))
            pairs = [tuple(sorted(live[i:i + 2])) for i in range(0, len(live) - 1, 2)]
            self.pairs.append(pairs + [(t, -1) for t in live[2 * len(pairs):]])


def values(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term that occurs tf times in n adds to a score, over its weight."""
    m = 100 - 50 + (50 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def counted(docs: DataFrame, terms: dict[bytes, int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n, terms, tfs) of each row: its number of terms, and how often it holds each of the given ones."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            n, found, tfs = [], [], []
            for t in batch.column(1):
                words = terms_of(t.as_py())
                own = sorted((number[w], c) for w, c in Counter(words).items() if w in number)
                n.append(len(words))
                found.append([x for x, _ in own])
                tfs.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


_INDEX = "block long, a int, b int, docs binary, held binary, most long"


def index_block(block: int, ids: list, n: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], weight: np.ndarray,
                pairs: list[tuple[int, int]], documents: int, length: int) -> list[tuple]:
    """The rows of a block: its ids (a, b = -1, -1), a list for each term (a, -1) and for each pair that meets (a, b)."""
    rows = [(block, -1, -1, np.array([i or 0 for i in ids], "<i8").tobytes(),
             np.array([i is None for i in ids], "u1").tobytes(), 0)]
    sizes = np.array([len(t) for t in terms])
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    term, tf = np.concatenate(terms), np.concatenate(tfs).astype(np.int64)
    value = values(tf, np.repeat(n, sizes), documents, length)
    order = np.lexsort((doc, term))
    doc, term, value = doc[order], term[order], value[order]
    at = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
    lists = {}
    for s, e in zip(at, np.append(at[1:], len(term))):
        t = int(term[s])
        if weight[t] > 0:
            lists[t] = doc[s:e], value[s:e]
            rows.append((block, t, -1, doc[s:e].astype("<i4").tobytes(), value[s:e].astype("<i4").tobytes(),
                         int(weight[t] * value[s:e].max())))
    for a, b in pairs:
        if a in lists and b in lists:
            both, i, j = np.intersect1d(lists[a][0], lists[b][0], assume_unique=True, return_indices=True)
            if len(both):
                joint = weight[a] * lists[a][1][i] + weight[b] * lists[b][1][j]
                rows.append((block, a, b, both.astype("<i4").tobytes(), None, int(joint.max())))
    return rows


def build(rows: DataFrame, queries: Queries, documents: int, length: int, at: str) -> DataFrame:
    """The index of :func:`counted` rows, written to the folder ``at``: block by block as the tasks read them."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((queries.weight, queries.all_pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, pairs = shared.value
        first, made, held = TaskContext.get().partitionId() << 32, 0, []

        def block() -> pa.RecordBatch:
            ids, n, terms, tfs = zip(*held)
            out = index_block(first + made, ids, np.array(n, np.int64), [np.array(t, np.int32) for t in terms],
                              [np.array(t, np.int32) for t in tfs], weight, pairs, documents, length)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              [c.split()[0] for c in _INDEX.split(", ")])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) == BLOCK:
                    yield block()
                    made, held = made + 1, []
        if held:
            yield block()

    index = rows.filter("size(terms) > 0").mapInArrow(run, _INDEX)
    index.withColumn("turn", F.when(F.pmod(F.xxhash64("block"), F.lit(FIRST)) == 0, 1).otherwise(2)).write.partitionBy(
        "turn").parquet(at)
    return spark.read.schema(f"{_INDEX}, turn int").parquet(at)


@dataclass
class Block:
    """A block's lists as arrays; impacts are values times weight."""

    ids: np.ndarray
    nameless: np.ndarray
    lists: dict[int, tuple[np.ndarray, np.ndarray]]
    most: dict[int, int]
    meet: dict[tuple[int, int], tuple[np.ndarray, int]]

    @classmethod
    def of(cls, rows: Iterator[tuple], weight: np.ndarray) -> Block:
        got = cls(np.zeros(0, np.int64), np.zeros(0, bool), {}, {}, {})
        for a, b, docs, held, most in rows:
            if a < 0:
                got.ids, got.nameless = np.frombuffer(docs, "<i8"), np.frombuffer(held, "u1").astype(bool)
            elif b < 0:
                got.lists[a] = np.frombuffer(docs, "<i4"), np.frombuffer(held, "<i4").astype(np.int64) * weight[a]
                got.most[a] = most
            else:
                got.meet[a, b] = np.frombuffer(docs, "<i4"), most
        return got

    def candidates(self, pairs: list[tuple[int, int]], beat: int, joint: bool = True) -> tuple[np.ndarray, list]:
        """The documents that may score ``beat``, and the pairs with their bounds, greatest first.

        With ``joint`` false the bounds are the independent ones, each pair the sum of its terms' maxima.
        """
        bounds, levels, steps = [], [], []      # levels of a pair: (bound of what is left out, postings searched, lists)
        for a, b in pairs:
            own = sorted((t for t in (a, b) if t in self.most), key=self.most.get)
            tops, lists = [self.most[t] for t in own], [self.lists[t][0] for t in own]
            if joint and len(own) == 2:
                docs, most = self.meet.get((a, b), (np.zeros(0, np.int32), 0))
                both = max(tops[1], most)
                levels.append([(0, len(lists[0]) + len(lists[1]) - len(docs), lists), (tops[0], len(lists[1]), lists[1:]),
                               (tops[1], len(docs), [docs]), (both, 0, [])])
                bounds.append((both, own))
            else:
                levels += [[(0, len(x), [x]), (m, 0, [])] for m, x in zip(tops, lists)]
                bounds.append((sum(tops), own))
        for i, own in enumerate(levels):        # steps with ever less saved for a point of the bound
            at = 0
            while at < len(own) - 1:
                rate, to = max(((own[at][1] - x[1]) / (x[0] - own[at][0] + 1), j) for j, x in enumerate(own) if j > at)
                steps.append((rate, i, at, to))
                at = to
        below, chosen = 0, [0] * len(levels)
        for _, i, at, to in sorted(steps, key=lambda x: -x[0]):
            more = levels[i][to][0] - levels[i][at][0]
            if chosen[i] == at and below + more < beat:
                below, chosen[i] = below + more, to
        near = np.zeros(len(self.ids), bool)
        for own, at in zip(levels, chosen):
            for docs in own[at][2]:
                near[docs] = True
        return np.flatnonzero(near), sorted(bounds, key=lambda x: -x[0])

    def best(self, pairs: list[tuple[int, int]], k: int, beat: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents that score at least ``beat`` (and above 0)."""
        beat = max(1, beat)
        near, bounds = self.candidates(pairs, beat)
        score = np.zeros(len(self.ids), np.int64)
        left = sum(b for b, _ in bounds)
        for bound, own in bounds:
            if not len(near):
                break
            for t in own:
                docs, impact = self.lists[t]
                if 16 * len(near) < len(docs):      # few candidates: look them up
                    at = np.searchsorted(docs, near)
                    hit = (at < len(docs)) & (docs[np.minimum(at, len(docs) - 1)] == near)
                    score[near[hit]] += impact[at[hit]]
                else:
                    score[docs] += impact
            left -= bound
            near = near[score[near] + left >= beat]
        found = score[near]
        if len(near) > k:
            keep = found >= np.partition(found, len(found) - k)[len(found) - k]
            near, found = near[keep], found[keep]
        order = np.lexsort((self.ids[near], self.nameless[near], -found))[:k]
        return near[order], found[order]


def search(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    """(item, doc_id, score): each block's k best documents of each query, those below its score to beat left out."""
    spark = index.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((queries.pairs, queries.weight, queries.beat))

    def run(group: pa.Table) -> pa.Table:
        pairs, weight, beat = shared.value
        block = Block.of(zip(*(group[c].to_pylist() for c in ("a", "b", "docs", "held", "most"))), weight)
        items, ids, scores = [], [], []
        for item, own in enumerate(pairs):
            at, score = block.best(own, k, int(beat[item]))
            items.append(np.full(len(at), item, np.int32))
            ids.append(pa.array(block.ids[at], pa.int64(), mask=block.nameless[at]))
            scores.append(score)
        return pa.Table.from_arrays([pa.array(np.concatenate(items)), pa.chunked_array(ids, pa.int64()),
                                     pa.array(np.concatenate(scores))], ["item", "doc_id", "score"])

    return index.groupBy("block").applyInArrow(run, "item int, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def read_queries(items: DataFrame, text: str = "text", item_id: str = "item_id") -> Queries:
    """The queries of one pass, collected (their number is bounded by the caller)."""
    got = items.select(F.col(item_id).alias("id"), F.col(text).cast("binary").alias("text")).distinct().toArrow()
    terms: dict[bytes, int] = {}
    of = []
    for t in got["text"]:
        of.append(sorted({terms.setdefault(w, len(terms)) for w in terms_of(t.as_py())}))
    return Queries(got["id"].to_pylist(), terms, of)


def _pass(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int, text: str, doc_id: str, item_id: str) -> DataFrame:
    queries = read_queries(items, text, item_id)
    at = f"{shared_dir(spark).rstrip('/')}/lexical-{uuid.uuid4().hex}"
    counted(docs, queries.terms, text, doc_id).write.parquet(f"{at}/counted")
    rows = spark.read.parquet(f"{at}/counted")
    documents, length = rows.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = rows.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()     # at most a row per query term
    queries.weigh(documents, dict(zip(holding["t"].to_pylist(), holding["count"].to_pylist())))
    queries.beat = np.ones(len(queries.of), np.int64)
    index = build(rows, queries, documents, length, f"{at}/index")
    search(index.filter("turn = 1"), queries, k).write.parquet(f"{at}/first")
    first = _top(spark.read.parquet(f"{at}/first"), k)
    for r in first.filter(F.col("rank") == k).select("item", "score").collect():    # at most a row per query
        queries.beat[r.item] = r.score
    rest = search(index.filter("turn = 2"), queries, k)
    kind = items.schema[item_id].dataType
    names = spark.createDataFrame(list(enumerate(queries.ids)), T.StructType(
        [T.StructField("no", T.IntegerType()), T.StructField("item_id", kind)]))
    best = _top(first.drop("rank").unionByName(rest), k)
    return best.join(F.broadcast(names), F.col("item") == F.col("no")).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", doc_id: str = "doc_id",
           item_id: str = "item_id", items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents that score highest for each query, score above 0."""
    spark = docs.sparkSession
    passes = max(1, -(-items.count() // items_per_pass))
    out = None
    for i in range(passes):
        own = items if passes == 1 else items.filter(F.pmod(F.xxhash64(item_id, text), F.lit(passes)) == i)
        got = _pass(spark, docs, own, k, text, doc_id, item_id)
        out = got if out is None else out.unionByName(got)
    return out
