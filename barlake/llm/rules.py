"""Quality rules: statistics of whole texts and decision lists learned from labelled ones.

Sequential covering: a rule against low quality grows by the threshold with the best information gain on two thirds of
the examples, loses the last conditions that the other third doesn't bear out, and stays if that third agrees;
the examples it covers go and the next rule is learned. The list is emitted as an ordered conditional
expression on the statistics.

Defined results: a null text has no words and fails the base rules; without labels of both kinds the list is empty and the
base rules decide alone; ids labelled both ways don't teach; an id on several rows teaches once, by one of those that
pass the base rules; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import free_name, ship, stored

SAMPLE = 20_000             # labelled rows at most that rules are learned from
RULES, CONDITIONS, CUTS = 16, 4, 32
AGREE = 0.9                 # share of low quality that a rule needs among the pruning examples it covers

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"        # fixed values of the base rules
#: What a rule may test, by statistic: shares, so that long and short texts compare.
MEASURES = {
    "symbol_share": "n_symbols / greatest(n_words, 1)", "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)", "mean_word": "word_chars / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)", "shout_share": "n_shouts / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)", "n_words": "cast(n_words as double)",
}
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
         "n_shouts"]


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    v = len(ids)
    pair = a[:-2] * v + a[1:-1]
    if v > 2_000_000:           # three numbers no longer fit 64 bits: number the pairs first
        _, pair = np.unique(pair, return_inverse=True)
    order = np.argsort(window := pair * v + a[2:], kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i:n - 2 + i] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The STATS of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()         # bytes split at the ASCII white space alone
    lines = text.split("\n")
    dup = 0
    if len(set(lines)) < len(lines):
        earlier: set[str] = set()
        for line in lines:
            dup += line in earlier and bool(line.strip(SPACE))
            earlier.add(line)
    b = np.frombuffer(raw, np.uint8)
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), dup,
            repeated_words(words), len(lines), int(((b >= 65) & (b <= 90)).sum()), int(((b >= 48) & (b <= 57)).sum()),
            text.count("!"))


def statistics(text: Column | str) -> Column:
    """A struct of STATS for each whole text."""

    @F.pandas_udf(", ".join(f"{s} long" for s in STATS))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measure(t) for t in texts], columns=STATS, dtype="int64")

    return of(F.col(text) if isinstance(text, str) else text)


def base_failed(s: str = "") -> Column:
    c = lambda x: F.col(f"{s}{x}")
    return (c("n_words") < 50) | (c("n_repeat_words") * 100 > c("n_words") * 50)


@dataclass
class Rule:
    tests: list[tuple[str, str, float]]     # (measure, "<=" or ">", threshold)

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for m, op, t in self.tests:
            out &= x[m] <= t if op == "<=" else x[m] > t
        return out

    def sql(self, measures: dict[str, str]) -> str:
        return " AND ".join(f"({measures[m]}) {op} {t!r}D" for m, op, t in self.tests)


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the test with the best gain p (log2 p/(p+n) - log2 P/(P+N)) until only low quality is covered."""
    rule, inside = Rule([]), np.ones(len(bad), bool)
    while len(rule.tests) < CONDITIONS:
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        if not p0 or not n0:
            break
        best = (1e-9, None)
        for m, v in x.items():
            for t in np.unique(np.quantile(v[inside & bad], np.linspace(0, 1, CUTS), method="lower")):
                for op in ("<=", ">"):
                    hit = inside & (v <= t if op == "<=" else v > t)
                    p, n = (bad & hit).sum(), (~bad & hit).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0]:
                            best = (gain, (m, op, float(t)))
        if best[1] is None:
            break
        rule.tests.append(best[1])
        inside = rule.covers(x)
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = 3) -> list[Rule]:
    """The decision list: each rule rejects what it covers; the rest is kept."""
    rules: list[Rule] = []
    left = np.random.default_rng(seed).permutation(len(bad))
    while len(rules) < RULES:
        third = len(left) // 3
        prune, grow = left[:third], left[third:]
        at = lambda rows: {m: v[rows] for m, v in x.items()}  # noqa: B023, E731
        if not bad[grow].any() or bad[grow].all() or not bad[prune].any():
            break
        rule, px, pb = _grow(at(grow), bad[grow]), at(prune), bad[prune]

        def worth(tests: list) -> float:
            hit = Rule(tests).covers(px)
            p, n = (pb & hit).sum(), (~pb & hit).sum()      # noqa: B023
            return (p - n) / (p + n) if p + n else -1.0

        if not rule.tests:
            break
        rule = Rule(max((rule.tests[:k] for k in range(len(rule.tests), 0, -1)), key=worth))
        hit = rule.covers(px)
        if not hit.any() or (pb & hit).sum() < AGREE * hit.sum():
            break
        rules.append(rule)
        left = left[~rule.covers(at(left))]
    return rules


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The list as an ordered conditional expression on STATS columns: true to keep."""
    import re

    measures = {m: re.sub(r"\b(n_\w+|word_chars)\b", lambda c: prefix + c[1], e) for m, e in MEASURES.items()}
    if not rules:
        return F.lit(True)
    cases = " ".join(f"WHEN {r.sql(measures)} THEN false" for r in rules)
    return F.expr(f"CASE {cases} ELSE true END")


def _sampled(labels: DataFrame, sample: int) -> DataFrame:
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("label"), F.max("quality").alias("other")).filter("label = other").drop("other")
    return known.orderBy(F.xxhash64(F.lit("rules"), "doc_id"), "doc_id").limit(sample)


def learn_from(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from rows (doc_id, STATS) and labels (doc_id, quality); at most ``sample`` labels are used."""
    known = F.broadcast(stored(_sampled(labels, sample)))       # at most ``sample`` rows of two numbers
    rows = stats.join(known, "doc_id").filter(~base_failed()).select(
        "doc_id", "label", *[F.expr(e).alias(m) for m, e in MEASURES.items()])
    # one row per id, drawn by hash, whatever its rows: the labels bound what is gathered
    one = F.min(F.struct(F.xxhash64(*MEASURES).alias("draw"), "label", *MEASURES)).alias("one")
    got = rows.groupBy("doc_id").agg(one).select("one.label", *[f"one.{m}" for m in MEASURES]).toArrow()
    got = got.sort_by([(c, "ascending") for c in ("label", *MEASURES)])
    x = {m: got[m].to_numpy() for m in MEASURES}
    return learn(x, got["label"].to_numpy() == 0)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the base statistics, base_failed, kept) of every document."""
    ship(docs.sparkSession)
    stats = stored(docs.select("doc_id", statistics("text").alias("s")).select("doc_id", "s.*"))
    rules = learn_from(stats, labels)
    failed = base_failed()
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the learned list; a first pass measures the sample alone."""
    ship(docs.sparkSession)
    known = F.broadcast(stored(_sampled(labels, sample)))
    some = docs.select("doc_id", "text").join(known.select("doc_id"), "doc_id", "left_semi")
    rules = learn_from(stored(some.select("doc_id", statistics("text").alias("s")).select("doc_id", "s.*")), labels, sample)
    s = free_name(docs, "_stats")
    out = docs.withColumn(s, statistics("text"))
    return out.filter(~base_failed(f"{s}.") & verdict(rules, f"{s}.")).drop(s)
