"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations alone.

Every document gets a place in its source's seeded shuffle, and each further copy of a source follows the one
before. A copy's virtual finish time is the source's words up to and including it over the source's weight.
All copies are sorted by finish time over ranges and taken while their running total of words stays within the
budget. A source that runs out of copies leaves the queue and the others go on by weight, so that the cut
agrees with :func:`targets` up to the copies that straddle it.

Defined results: a null or empty text has 0 words; a null source is a source of its own, the last in order; rows
that repeat are documents of their own, one behind the other in the queue, so that the cut may take some of them only
(which of them is all one, as they are alike); a null doc_id shuffles like any value; an empty table gives no rows; extra
columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import WORD, free_name, free_stem, running_totals, stored

#: The cuts (one row per source, about 100 bytes) are broadcast up to this many; beyond, the join is shuffled.
BROADCAST_SOURCES = 20_000


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column | str, seed: str) -> Column:
    """60 bits of the MD5 of seed:doc_id: a place in the shuffle that any engine can recompute."""
    return F.conv(F.left(F.md5(F.concat_ws(":", F.lit(seed), F.col(doc_id).cast("string"))), F.lit(15)),
                  16, 10).cast("long")


def text_key(text: Column | str) -> Column:
    """60 bits of the MD5 of a text, which order the documents of one doc_id."""
    return F.conv(F.left(F.md5(F.coalesce(text, F.lit(""))), F.lit(15)), 16, 10).cast("long")


def targets(rows: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5,
            max_repeats: int = 2) -> DataFrame:
    """From rows (_source, _size): one row per source with its rank, weight, source_size, budget and target.

    Sources take ``weights`` in turn, by code point with null last, and share ``share`` of all words; no target
    exceeds ``max_repeats`` of its source, and what that cuts off is shared again by weight. In closed form: in
    order of cap over weight, let level be what remains of the budget after the forerunners' caps over the
    weights not yet capped; the first source whose cap isn't below its level sets it for all. The windows run
    over one row per source.
    """
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    s = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.get(cycle, F.col("rank") % len(weights)))
    s = s.withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
    s = s.withColumn("cap", F.col("source_size") * F.lit(max_repeats))
    s = s.withColumn("full_at", F.col("cap") / F.col("weight"))
    by = Window.orderBy("full_at", "rank")
    capped = F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("budget") - capped) / open_weight)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fits = F.when(F.col("level") <= F.col("full_at"), F.col("level"))
    level = F.coalesce(F.first(fits, ignorenulls=True).over(whole), F.max("full_at").over(whole))
    s = s.withColumn("level", level)
    return s.select("_source", "rank", "weight", "source_size", "budget",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def queue_cuts(rows: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5,
               max_repeats: int = 2) -> DataFrame:
    """Run the queue over rows (_source, _size, _key, _tie): the targets and each source's last copy taken.

    A source's copies leave in the order (epoch, _key, _tie), so its last copy taken tells them all; where several rows
    agree in these, ``taken`` of ``alike`` of them are taken. Two range sorts of slim rows, no texts; the rows of
    a hot source, and those that repeat, are spread over all ranges.
    """
    sources = stored(targets(rows, weights, share, max_repeats))
    slim = rows.join(_bounded(sources), F.col("_source").eqNullSafe(F.col("_s")))
    slim = slim.select("rank", "weight", "source_size", "budget", "_size", "_key", "_tie")
    placed = running_totals(slim, ["rank"], ["_key", "_tie"], {"words": F.sum("_size")})
    copies = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    finish = (F.col("epoch") * F.col("source_size") + F.col("words")) / F.col("weight")
    copies = copies.select("rank", "budget", "epoch", "_size", "_key", "_tie", finish.alias("finish"))
    order = ["finish", "rank", "epoch", "_key", "_tie"]
    queue = running_totals(copies, [], order, {"total": F.sum("_size")})
    place = F.struct("epoch", "_key", "_tie")
    fits = F.col("total") <= F.col("budget")
    last = stored(queue.filter(fits).groupBy(F.col("rank").alias("_r")).agg(F.max(place).alias("last")))
    equals = queue.join(_bounded(last, "_r", "_r"), (F.col("rank") == F.col("_r")) & (place == F.col("last")))
    last = equals.groupBy(F.col("rank").alias("_r")).agg(
        F.first("last").alias("last"), F.count_if(fits).alias("taken"), F.count("*").alias("alike"))
    return stored(sources.join(last, F.col("rank") == F.col("_r"), "left").select(
        "_source", "source_size", "target", "last", "taken", "alike"))


def _bounded(sources: DataFrame, name: str = "_source", to: str = "_s") -> DataFrame:
    s = sources.withColumnRenamed(name, to)
    return F.broadcast(s) if s.count() <= BROADCAST_SOURCES else s


def with_copies(df: DataFrame, source: str, key: str, tie: str, cuts: DataFrame, name: str = "copies") -> DataFrame:
    """Add a struct (copies, source_size, target) to each row, from the cuts of its source.

    Of the rows that are alike where the cut falls among them, as many get a copy more as it says: they are numbered, on
    their own (there are none where rows don't repeat).
    """
    stem = free_stem(df, "_mix_")
    s, cut = f"{stem}s", F.col(f"{stem}cut")
    c = cuts.select(F.col("_source").alias(s), F.struct("source_size", "target", "last", "taken", "alike").alias(f"{stem}cut"))
    joined = df.join(_bounded(c, s, s), F.col(source).eqNullSafe(F.col(s)), "left")
    at, last = F.struct(F.col(key), F.col(tie)), F.struct(cut["last"]["_key"], cut["last"]["_tie"])
    split = F.coalesce((at == last) & (cut["taken"] < cut["alike"]), F.lit(False))

    def told(rows: DataFrame, more: Column) -> DataFrame:
        n = F.when(cut["last"].isNull(), 0).otherwise(cut["last"]["epoch"] + more.cast("int"))
        return rows.select(*[F.col(f"`{x}`") for x in df.columns], F.struct(
            n.alias("copies"), cut["source_size"].alias("source_size"), cut["target"].alias("target")).alias(name))

    if cuts.filter("taken < alike").isEmpty():
        return told(joined, at <= last)
    numbered = running_totals(joined.filter(split), [s], [key, tie], {f"{stem}n": F.count(F.lit(1))})
    return told(joined.filter(~split), at <= last).unionByName(told(numbered, F.col(f"{stem}n") <= cut["taken"]))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, max_repeats: int = 2,
        seed: str = "mix") -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the queue takes it (0 to ``max_repeats``)."""
    columns = docs.columns
    key, tie, got = free_name(docs, "_key"), free_name(docs, "_tie"), free_name(docs, "_got")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    keyed = docs.withColumns({key: shuffle_key(doc_id, seed), tie: whole})
    rows = stored(keyed.select(F.col(source).alias("_source"), word_count(text).alias("_size"),
                               F.col(key).alias("_key"), F.col(tie).alias("_tie")))
    out = with_copies(keyed, source, key, tie, queue_cuts(rows, weights, share, max_repeats), got)
    out = out.filter(F.col(got)["copies"] > 0).withColumn(key, F.explode(F.sequence(F.lit(1), F.col(got)["copies"])))
    return out.select(*[F.col(f"`{c}`") for c in columns])


def mixed_words(docs: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5,
                max_repeats: int = 2, seed: str = "mix") -> DataFrame:
    """Per document its size in words, its source's size and target, and the words that the mix takes of it."""
    rows = stored(docs.select("doc_id", F.col("source").alias("_source"), word_count("text").alias("_size"),
                              shuffle_key("doc_id", seed).alias("_key"), text_key("text").alias("_tie")))
    out = with_copies(rows, "_source", "_key", "_tie", queue_cuts(rows, weights, share, max_repeats), "got")
    return out.select("doc_id", F.col("_size").alias("size"), F.col("got.source_size").alias("source_size"),
                      F.col("got.target").alias("target"), (F.col("got.copies") * F.col("_size")).alias("taken"))
