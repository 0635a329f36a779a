"""Quality scores by naive Bayes support vectors.

The features are indicators of the hashed byte n-grams of a whole text. Class counts over all labelled training rows,
added up in the tasks and then by feature, give log-count ratios; indicators scaled by them, at unit length,
feed a linear hinge-loss model that dual coordinate descent fits on a bounded sample of ids; a logistic curve, fitted
on sampled rows that the model hasn't seen, turns margins into scores.

Defined results: a null text counts as empty and gets the score of no evidence; rows without label or id don't teach,
nor do ids labelled both ways; with one class or none to learn from every score is the smoothed share of label
1; the rows of an id teach as much as one row (each a share in the class counts, and the one with the least features in
the sample); labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import ship, stored

BITS = 17                   # features: 2^BITS
GRAMS = (2, 3, 4)           # bytes of an n-gram
SAMPLE = 5000               # labelled ids at most that the linear model and the curve are fitted on
SAMPLE_FEATURES = 1 << 25   # and features that they may have together (128 MB on the driver)
UNIT = 1 << 20              # what the rows of an id add up to in the class counts
BROADCAST_LABELS = 1_000_000    # teaching labels (two numbers each) are broadcast up to this many; beyond, texts are shuffled
COST, EPOCHS = 1.0, 30


def features(text: bytes | None, seen: np.ndarray) -> np.ndarray:
    """The distinct features of a text; ``seen`` is a work array of 2^BITS False."""
    b = np.frombuffer(text or b"", np.uint8).astype(np.uint32)
    for n in GRAMS:
        if len(b) < n:
            continue
        h = np.full(len(b) - n + 1, n, np.uint32)
        for i in range(n):
            h = (h ^ b[i:len(b) - n + 1 + i]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        seen[(h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


@dataclass
class Model:
    weight: np.ndarray      # of an indicator in the margin
    square: np.ndarray      # of an indicator in the squared length
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        length = float(self.square[found].sum()) ** 0.5
        return float(self.weight[found].sum()) / length + self.bias if length else self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30))))


def log_count_ratios(neg: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Log of the smoothed share of a feature among label 1's features over that among label 0's."""
    p, q = pos + 1.0, neg + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss on scaled indicators at unit length, with a bias feature."""
    w, bias = np.zeros(len(ratio)), 0.0
    values = [ratio[r] / max(np.sqrt((ratio[r] ** 2).sum()), 1e-12) for r in rows]
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = y[i] * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / (v @ v + 1), 0.0), COST)
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve with smoothed targets, by Newton steps with a light ridge."""
    n1, n0 = label.sum(), len(label) - label.sum()
    t = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta = np.zeros(2)
    x = np.stack([margin, np.ones(len(margin))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * theta
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        theta -= step
        if abs(step).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])


def teaching(labels: DataFrame) -> DataFrame:
    """(doc_id, label): one row per id with one label, 0 or 1."""
    return labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("label"), F.max("quality").alias("other")).filter("label = other").drop("other")


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def packed(found: np.ndarray) -> bytes:
    """The features of a text as bytes: numbers, or beyond 2^BITS / 32 of them a bitmap (16 kB at most)."""
    if 32 * len(found) <= 1 << BITS:
        return b"n" + found.astype("<i4").tobytes()
    bits = np.zeros(1 << BITS, bool)
    bits[found] = True
    return b"b" + np.packbits(bits).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"n":
        return np.frombuffer(data, "<i4", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1))).astype(np.int32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_features: int = SAMPLE_FEATURES) -> Model:
    """Learn from the rows of docs (doc_id, text) with a label in labels (doc_id, label).

    Only the class counts (2^BITS rows) and the bounded sample's features come to the driver: those of at most ``sample``
    ids, in the order of a hash, as far as they have ``sample_features`` features together (one id in any case).
    """
    spark = docs.sparkSession
    ship(spark)
    place = F.xxhash64(F.lit("sample"), "doc_id")
    # ids alone are read here: how many rows each teaching id has
    known = stored(docs.select("doc_id").join(labels, "doc_id").groupBy("doc_id", "label").agg(F.count("*").alias("copies")))
    n = known.count()
    share = F.greatest(F.lit(1), F.floor(F.lit(UNIT) / F.col("copies"))).cast("long")
    chosen = F.pmod(place, F.lit(1 << 30)) < F.lit(int(min(1.0, 1.2 * sample / max(1, n)) * (1 << 30)))
    known = known.select("doc_id", "label", share.alias("share"), F.when(chosen, place).alias("place"))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(known) if n <= BROADCAST_LABELS else known, "doc_id").select("place", "share", "text", "label")
    size = 1 << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int64)
        seen = np.zeros(size, bool)
        names = ["feature", "neg", "pos", "place", "label", "n", "digest", "found"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        least: dict[int, tuple] = {}    # of the chosen ids; the rows of an id go on only as they get less
        for batch in batches:
            kept = []
            place, share, text, label = (batch.column(i) for i in range(4))
            for p, c, t, y in zip(place.to_pylist(), share.to_pylist(), text, label.to_pylist()):
                found = features(t.as_py(), seen)
                counts[y][found] += c
                if p is not None:
                    data = packed(found)
                    row = len(found), hashlib.blake2b(data, digest_size=16).digest()
                    if p not in least or row < least[p]:
                        least[p] = row
                        kept.append((None, None, None, p, y, *row, data))
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*kept), kinds)], names)
        some = np.flatnonzero(counts.any(0))
        if len(some):
            none = [pa.nulls(len(some), k) for k in kinds[3:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(counts[0][some]), pa.array(counts[1][some]), *none], names)

    got = stored(rows.mapInArrow(run, "feature int, neg long, pos long, place long, label int, n int, digest binary, found binary"))
    sums = got.filter("feature is not null").groupBy("feature").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    sums = sums.toArrow()
    counts = np.zeros((2, size))
    for c, name in ((0, "neg"), (1, "pos")):
        counts[c][sums["feature"].to_numpy()] = sums[name].to_numpy() / UNIT
    # one row for each place (an id): copies meet as slim rows, after each task has reduced its own
    one = got.filter("place is not null").groupBy("place").agg(F.min(F.struct("n", "digest", "found", "label")).alias("row"))
    first = one.select("place", "row.n").orderBy("place").limit(sample).toArrow()
    within = np.searchsorted(np.cumsum(first["n"].to_numpy()), sample_features, "right")
    upto = first["place"][min(max(within, 1), len(first)) - 1].as_py() if len(first) else 0
    picked = one.filter(F.col("place") <= upto).select("place", "row.label", "row.found").orderBy("place").limit(sample).toArrow()
    y = picked["label"].to_numpy()
    found = [unpacked(x.as_py()) for x in picked["found"]]
    ratio = log_count_ratios(*counts)
    weight, bias, slope, shift = np.zeros(size), 0.0, 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if 0 < y.sum() < len(y):
        learn = np.arange(len(y)) % 4 > 0
        if not 0 < y[learn].sum() < learn.sum() or not 0 < y[~learn].sum() < (~learn).sum():
            learn = np.ones(len(y), bool)
        w, bias = descend([f for f, k in zip(found, learn) if k], np.where(y[learn] > 0, 1.0, -1.0), ratio)
        weight = w * ratio
        model = Model(weight, ratio ** 2, bias, 1.0, 0.0)
        curve = ~learn if not learn.all() else learn
        margins = np.array([model.margin(f) for f, k in zip(found, curve) if k])
        slope, shift = logistic(margins, y[curve])
    return Model(weight.astype(np.float32), (ratio ** 2).astype(np.float32), bias, slope, shift)


def scores(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """The score of each whole text, row by row."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)    # two arrays of 2^BITS floats

    @F.pandas_udf(T.DoubleType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, seen = shared.value, np.zeros(1 << BITS, bool)
        for texts in batches:
            yield pd.Series([m.score(features(t, seen)) for t in texts], dtype="float64")

    return of((F.col(text) if isinstance(text, str) else text).cast("binary"))


def classified(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; held-out rows don't teach."""
    known = teaching(labels).filter(~held_out("doc_id"))
    model = fit(docs, known)
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), scores(docs.sparkSession, model, "text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``cut``."""
    model = fit(docs, teaching(labels).filter(~held_out("doc_id")))
    return docs.filter(scores(docs.sparkSession, model, "text") >= cut)
