"""How five filters interact: what each removes at every place of every order, and its exact Shapley share.

Each document gets a mask of the filters that it fails. All that an order of filters can remove follows from the counts
of the masks: what a coalition of filters removes is the number of documents that fail one of them, and a filter's
count at a step is the difference between two coalitions. The 32 coalitions of a part are tabulated once. The Shapley
shares are the solution of a least-squares problem: coalition removals by additive shares, weighted by the Shapley
kernel, with the shares bound to add up to what all filters remove; its normal equations are solved in
rationals, so the shares are exact.

Four filters look at a text alone. The fifth (repeats of a text) needs the whole table: the texts' digests
are grouped, never the texts, and a group of copies is reduced to a row per part and label before it meets in a task.

Defined results: a null text counts as empty; a null part as the empty string; a document without label or with a null
id loses nothing good or toxic; an id counts as good or toxic if any of its label rows says so; a null id is neither
a smaller nor a larger one, so such rows never fail the repeat filter; rows with equal id and text don't fail it by
each other; an empty table has no parts and gives no rows; extra columns aren't read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator, Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import ship

#: The filters' letters; the last one is the repeat filter.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT, SYMBOLS = 200, 50, 3, b"#$%&*|"

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_INNER = bytes(range(0x80, 0xC0))       # bytes that don't begin a code point

OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def text_failures(text: bytes) -> int:
    """The mask of the filters A to D (bits 0 to 3) that a whole text fails."""
    words = text.split()        # bytes split at the ASCII white space alone
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _INNER))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * upper > MAX_UPPER_PERCENT * points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """(doc_id, part, digest, mask) of each row: the slim form in which documents are shuffled."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            digests = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), digests, pa.array(map(text_failures, texts), pa.int32())],
                ["doc_id", "part", "digest", "mask"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("digest", T.BinaryType()),
                           T.StructField("mask", T.IntegerType())])
    return rows.mapInArrow(run, schema)


def mask_counts(rows: DataFrame, labels: DataFrame, repeat_bit: int = 1 << (len(FILTERS) - 1)) -> DataFrame:
    """(part, mask, n, good, toxic) from :func:`measured` rows: at most 32 rows a part.

    Rows of one id and text are counted first, so neither a repeated row nor a group of copies meets whole in
    a task; the window over a digest runs over a row per part and label.
    """
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    one = rows.groupBy("digest", "mask", "part", "doc_id").agg(F.count("*").alias("n")).join(marks, "doc_id", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c)
    alike = one.select("digest", "mask", "part", flag("good"), flag("toxic"), "doc_id", "n",
                       F.col("doc_id").isNull().alias("nameless"))
    alike = alike.groupBy("digest", "mask", "part", "good", "toxic", "nameless").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    least = F.min(F.when(~F.col("nameless"), F.col("first.doc_id"))).over(Window.partitionBy("digest"))
    spared = F.when(F.col("nameless"), F.col("n")).when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    both = alike.withColumn("spared", spared).select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("spared").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(repeat_bit)).alias("mask"), (F.col("n") - F.col("spared")).alias("n")),
    )).alias("x")).filter("x.n > 0")
    n = F.col("x.n")
    return both.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def removals(counts: dict[int, int], filters: int) -> list[int]:
    """For every coalition (a mask): the documents that fail one of its filters."""
    return [sum(n for mask, n in counts.items() if mask & coalition) for coalition in range(1 << filters)]


def solve(matrix: Sequence[Sequence[Fraction]], right: Sequence[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    rows = [[*map(Fraction, row), Fraction(b)] for row, b in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(j for j in range(i, len(rows)) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for j, row in enumerate(rows):
            if j != i and row[i]:
                rows[j] = [x - row[i] * y for x, y in zip(row, rows[i])]
    return [row[-1] for row in rows]


def shapley(removed: Sequence[int], filters: int) -> list[Fraction]:
    """Shapley values of a game given by :func:`removals`, by constrained least squares.

    Shares s minimize the kernel-weighted sum over the proper coalitions of (removed - sum of members' shares)^2, and
    add up to what all remove; the multiplier of that constraint is the last unknown.
    """
    everyone = (1 << filters) - 1
    gram = [[Fraction(0)] * (filters + 1) for _ in range(filters + 1)]
    right = [Fraction(0)] * filters + [Fraction(removed[everyone])]
    for coalition in range(1, everyone):
        members = [i for i in range(filters) if coalition >> i & 1]
        k = len(members)
        weight = Fraction(filters - 1, math.comb(filters, k) * k * (filters - k))
        for i in members:
            right[i] += weight * removed[coalition]
            for j in members:
                gram[i][j] += weight
    for i in range(filters):
        gram[i][filters] = gram[filters][i] = Fraction(1)
    return solve(gram, right)[:filters]


def steps(counts: dict[int, tuple[int, int, int]], names: str = FILTERS) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique, good, toxic, shapley) for each order and step of one part.

    ``counts`` has for each mask the documents, the good and the toxic ones.
    """
    filters = len(names)
    removed, good, toxic = (removals({m: c[i] for m, c in counts.items()}, filters) for i in range(3))
    total = sum(c[0] for c in counts.values())
    shares = [int(s * math.factorial(filters)) for s in shapley(removed, filters)]
    unique = [counts.get(1 << i, (0,))[0] for i in range(filters)]
    for order in itertools.permutations(range(filters)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = removed[after] - removed[before]
            yield ("".join(names[j] for j in order), step, total - removed[after], here, removed[1 << i] - here, unique[i],
                   good[after] - good[before], toxic[after] - toxic[before], shares[i])
            before = after


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """The report of each part from its mask counts: a row per part, order and step."""
    ship(counts.sparkSession)

    def report(group: pa.Table) -> pa.Table:     # at most 32 rows
        part = group["part"][0].as_py()
        found = {m: (n, g, t) for m, n, g, t in zip(*(group[c].to_pylist() for c in ("mask", "n", "good", "toxic")))}
        order, step, *numbers = zip(*steps(found, names))
        columns = [pa.array([part] * len(order), pa.string()), pa.array(order, pa.string()), pa.array(step, pa.int32()),
                   *[pa.array(c, pa.int64()) for c in numbers]]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in OUT.split(", ")])

    return counts.groupBy("part").applyInArrow(report, OUT)


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole documents, by language."""
    return audit(mask_counts(measured(docs), labels))
