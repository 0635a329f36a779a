"""Line dedup, ranked search and the filter audit against brute force, with odd inputs and changes taken back."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import audit, lexical, linededup
from barlake.llm.linededup import CuckooFilter, LineIndex

SCHEMA = "doc_id long, text string, lang string, shard int, n_lines int, kept_text string, _text_id string, GONE int, key int"


def frame(spark, rows):
    """Rows of (doc_id, text, lang), with columns named like the operators' own."""
    return spark.createDataFrame([(*r, 1, 2, "x", "y", 3, 4) for r in rows], SCHEMA).repartition(3)


# ---------------------------------------------------------------- line dedup
def lines_rows():
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["Menu", " menu\t", f"line {rng.randrange(40)}", f"own {i}", "", "\x0b", "ÄÖ", "äö", "nb sp "])
                          for _ in range(rng.randrange(9))), "en") for i in range(60)]
    return rows + [(None, "menu\nno id", "en"), (None, None, None), (61, None, "en"), (62, "", "en"), (63, "MENU\n" * 4000 + "end", "en"),
                   (64, "menu\nmenu", "en"), (64, "menu\nmenu", "en"), (65, "\n\n", "en")]


def plain_lines(rows, at_least=10, min_chars=1):
    """Per row (n_lines, n_dropped, kept text), by counting."""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    split = [(t or "").split("\n") for _, t, *_ in rows]
    seen = Counter(k for lines in split for k in {key(x) for x in lines} if len(k) >= min_chars)
    stay = [[x for x in lines if seen[key(x)] < at_least] for lines in split]
    return Counter((r[0], len(a), len(a) - len(b), "\n".join(b)) for r, a, b in zip(rows, split, stay))


def dropped(index, docs, **how):
    got = index.drop_lines(docs, **how)
    assert got.columns[:9] == docs.columns and got.columns[9:] == ["_kept_text", "_n_lines", "n_dropped"]
    return Counter((r.doc_id, r["_n_lines"], r.n_dropped, r["_kept_text"]) for r in got.collect())


@pytest.mark.parametrize("min_chars", [1, 6])
def test_lines_against_counting(spark, tmp_path, min_chars):
    rows = lines_rows()
    docs = frame(spark, rows)
    index = LineIndex.create(docs, f"{tmp_path}/i", min_chars=min_chars)
    assert dropped(index, docs) == plain_lines(rows, 10, min_chars)


def test_lines_over_many_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 3)
    rows = lines_rows()
    docs = frame(spark, rows)
    index = LineIndex.create(docs, f"{tmp_path}/i", at_least=2)
    assert index.filters.count() > 2
    assert dropped(index, docs, groups=50) == plain_lines(rows, 2)


def state(index):
    """Exact counts, and what the filters hold of all keys ever counted."""
    counts = {bytes(r.key): r.docs for r in index.counts.collect()}
    shards = {r.shard: CuckooFilter(r.buckets, r.slots, r.stash, r["size"]) for r in index.filters.collect()}
    return counts, sum(s.size for s in shards.values())


def test_insertions_and_deletions_are_reversible(spark, tmp_path):
    rows = lines_rows()
    old, new = rows[:40], rows[40:]
    a = LineIndex.create(frame(spark, old), f"{tmp_path}/a")
    b = a.insert(frame(spark, new), f"{tmp_path}/b")
    whole = LineIndex.create(frame(spark, rows), f"{tmp_path}/whole")
    assert state(b) == state(whole)
    assert dropped(b, frame(spark, rows)) == plain_lines(rows)
    c = b.delete(frame(spark, new), f"{tmp_path}/c")
    assert state(c) == state(a)
    assert dropped(c, frame(spark, old)) == plain_lines(old)
    d = c.delete(frame(spark, old), f"{tmp_path}/d")
    assert state(d) == ({}, 0)
    assert dropped(d, frame(spark, old)) == plain_lines(old, at_least=10**9)
    with pytest.raises(Exception, match="wasn't in the index"):
        c.delete(frame(spark, new), f"{tmp_path}/e")
    again = d.insert(frame(spark, rows), f"{tmp_path}/f")
    assert state(again) == state(whole)


def test_index_grows_into_more_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 5)
    few = [(i, "a\nb", "en") for i in range(3)]
    many = [(i, "\n".join(f"k{j}" for j in range(60)), "en") for i in range(2)]
    a = LineIndex.create(frame(spark, few), f"{tmp_path}/a", at_least=2)
    b = a.insert(frame(spark, many), f"{tmp_path}/b")
    assert a.filters.count() == 1 and b.filters.count() > 5
    assert dropped(b, frame(spark, few + many), groups=3) == plain_lines(few + many, 2)


def test_lines_of_an_empty_table(spark, tmp_path):
    none = frame(spark, lines_rows()).limit(0)
    index = LineIndex.create(none, f"{tmp_path}/i")
    assert dropped(index, none) == Counter() and state(index) == ({}, 0)


def test_cuckoo_filter_loses_nothing():
    keys = [hashlib.sha256(str(i).encode()).digest()[:16] for i in range(4100)]
    held = CuckooFilter(1024)      # 4096 slots: some find no place, and go to the stash
    held.add(keys)
    assert held.holds(keys).all() and held.stash
    assert held.holds([hashlib.sha256(b"-%d" % i).digest()[:16] for i in range(4000)]).mean() < 0.01
    held = CuckooFilter(*held.row(0)[1:2], *held.row(0)[3:], held.size)
    held.remove(keys[::2])
    assert held.holds(keys[1::2]).all() and held.holds(keys[::2]).mean() < 0.01 and held.size == 2050
    held.remove(keys[1::2])
    assert not held.slots.any() and not held.stash and held.size == 0
    twice = CuckooFilter(1)        # one bucket: equal fingerprints are kept as often as they are put in
    twice.add(keys[:9])
    twice.remove(keys[:8])
    assert twice.holds(keys[8:9]).all()


# ---------------------------------------------------------------- ranked search
def plain_search(rows, items, k):
    lower = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x)
    cut = lambda t: [lower(x) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    docs = [(d, cut(t)) for d, t, *_ in rows]
    full = [(d, w) for d, w in docs if w]
    n, length = len(full), sum(len(w) for _, w in full)
    df = Counter(t for _, w in full for t in set(w))
    out = Counter()
    for item, text in set(items):
        scored = []
        for d, w in full:
            m = 100 - 50 + (50 * len(w) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((10**9 * w.count(t)) // (1000 * w.count(t) + 20 * m)) for t in set(cut(text)) if t in w)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, None if none else d, -score] += 1
    return out


def search_rows():
    rng = random.Random(5)
    words = ["the", "The", "of", "Ünï", "ünï", "x1", "rare", "a", "b", "日本", "no break", "joint", "pair"] + [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40))) + rng.choice([".", "-the", "", "\x7f"]), "en") for i in range(120)]
    return rows + [(200, None, "en"), (201, "", "en"), (202, " .,;\x00", "en"), (None, "the rare pair", "en"), (None, "rare", "en"),
                   (203, "rare rare", "en"), (203, "rare rare", "en"), (204, "rare rare", "en"), (205, "joint the " * 3000, "en")]


ITEMS = [(1, "the rare PAIR of joint words w1 w2"), (1, "the rare PAIR of joint words w1 w2"), (2, "unknown"), (3, None), (4, ""),
         (5, "rare"), (6, "ünï Ünï 日本 x1"), (7, " ".join(f"w{i}" for i in range(30))), (None, "a b"), (8, "the the the")]


@pytest.mark.parametrize("k, block, per_pass", [(3, 8192, 2000), (10, 16, 2000), (50, 7, 3), (1, 5, 2000)])
def test_search_against_brute_force(spark, monkeypatch, k, block, per_pass):
    monkeypatch.setattr(lexical, "BLOCK", block)
    rows = search_rows()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical.ranked(frame(spark, rows), items, k, items_per_pass=per_pass).collect()
    assert Counter(map(tuple, got)) == plain_search(rows, ITEMS, k)


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(spark, search_rows())
    assert lexical.ranked(docs.limit(0), items).collect() == [] == lexical.ranked(docs, items.limit(0)).collect()


def test_pair_bounds_skip_more_and_lose_nothing():
    """Terms that seldom meet: joint bounds leave fewer candidates than sums of maxima, with the same best documents."""
    rng = np.random.default_rng(2)
    terms = [np.sort(rng.choice(40, rng.integers(1, 9), False)).astype(np.int32) for _ in range(3000)]
    tfs = [rng.integers(1, 4, len(t)).astype(np.int32) for t in terms]
    n = np.array([t.sum() + 5 for t in tfs])
    weight = rng.integers(500, 9000, 40)
    pairs = [(i, i + 1) for i in range(0, 40, 2)]
    rows = lexical.index_block(0, list(range(3000)), n, terms, tfs, weight, pairs, 3000, int(n.sum()))
    block = lexical.Block.of([r[1:] for r in rows], weight)
    fewer = 0
    for own in (pairs[:4], pairs[5:12], pairs[:1], [(0, 1), (2, -1)]):
        exact = np.zeros(3000, np.int64)
        for t in {t for p in own for t in p if t >= 0}:
            docs, impact = block.lists[t]
            exact[docs] += impact
        order = sorted(range(3000), key=lambda d: (-exact[d], d))[:20]
        beat = int(exact[order[-1]])
        at, score = block.best(own, 20, beat)
        assert at.tolist() == [d for d in order if exact[d] > 0] and score.tolist() == [exact[d] for d in at]
        assert block.best(own, 20)[0].tolist() == at.tolist()
        close, far = (block.candidates(own, beat, joint)[0] for joint in (True, False))
        assert set(order) <= set(close.tolist()) and set(order) <= set(far.tolist())
        fewer += len(far) - len(close)
    assert fewer > 0


# ---------------------------------------------------------------- filter audit
def audit_rows():
    rng = random.Random(9)
    rows = []
    for i in range(150):
        words = rng.choices([f"w{j}" for j in range(rng.choice([5, 400]))], k=rng.choice([0, 10, 199, 200, 260]))
        text = " ".join(words) + rng.choice(["", "", " UPPER CASE TEXT", " #", " x"])
        rows.append((i, rng.choice([text, text, "copy of one text"]), rng.choice(["en", "de", None, ""])))
    return rows + [(None, "copy of one text", "en"), (None, "copy of one text", "en"), (200, None, "en"), (201, "", "en"), (202, None, "fr"),
                   (203, "same id", "en"), (203, "same id", "en"), (203, "same id", "de"), (203, "other text", "de"), (204, "same id", "en")]


def label_rows():
    rng = random.Random(1)
    return ([(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 210, 2)]
            + [(None, 1, 1), (203, 0, 1), (203, 1, 0), (999, 1, 1)])


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = {}
    for d, t, _ in rows:
        if d is not None:
            texts[t or ""] = min(d, texts.get(t or "", d))
    failed = []
    for d, t, part in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
             "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
             "E": d is not None and d > texts[t]}
        failed.append((part or "", d, {x for x, y in f.items() if y}))
    out, removed_by = [], Counter()
    for part in {p for p, *_ in failed}:
        own = [(d, f) for p, d, f in failed if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                redundant = sum(x in f for _, f in own) - len(gone)
                left = [(d, f) for d, f in left if x not in f]
                removed_by[part, x] += len(gone)
                out.append((part, order, step, len(left), len(gone), redundant, sum(f == {x} for _, f in own),
                            sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_against_every_order(spark):
    rows, labels = audit_rows(), label_rows()
    got = audit.interactions(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(2))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, labels)


def test_audit_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, audit_rows())
    assert sorted(map(tuple, audit.interactions(docs, none).collect())) == plain_audit(audit_rows(), [])
    assert audit.interactions(docs.limit(0), none).collect() == []


@pytest.mark.parametrize("filters", [1, 2, 3, 5])
def test_least_squares_shares_are_the_mean_over_all_orders(filters):
    rng = random.Random(filters)
    counts = {m: rng.randrange(10**12) for m in range(1 << filters)}
    removed = audit.removals(counts, filters)
    mean = [Fraction(0)] * filters
    for order in itertools.permutations(range(filters)):
        mask = 0
        for i in order:
            mean[i] += Fraction(removed[mask | 1 << i] - removed[mask], math.factorial(filters))
            mask |= 1 << i
    assert audit.shapley(removed, filters) == mean


def test_audit_shuffles_no_text(spark):
    rows = audit.measured(frame(spark, audit_rows()))
    assert rows.columns == ["doc_id", "part", "digest", "mask"]
    marks = spark.createDataFrame(label_rows(), "doc_id long, quality int, toxic int")
    assert audit.mask_counts(rows, marks).groupBy("part").count().agg(F.max("count")).first()[0] <= 32
