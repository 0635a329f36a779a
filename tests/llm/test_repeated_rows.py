"""Repeated rows, hot ids and clashing names: mixing, the classifier, sharding; and the registered queries as a whole."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import mixing, nbsvm, queries, sharding, simhash
from barlake.llm.common import running_totals

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


# ---------------------------------------------------------------- mixing
@pytest.mark.parametrize("copies", [600, 40])
def test_mix_meets_its_targets_when_a_row_repeats(spark, copies):
    rows = [(7, "w " * 10, "a")] * copies + [(1000 + i, "w " * 10, "a") for i in range(700 - copies)]
    rows += [(2000 + i, "v " * 10, "b") for i in range(500)] + [(3000 + i, "u " * (i % 20), None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mixed_words(docs).collect()
    target, taken = {}, {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        target[r.source_size] = r.target
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 20 for s in target)
    again = mixing.mixed_words(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    mixed = mixing.mix(docs).groupBy("source").agg(F.sum(mixing.word_count("text")).alias("n")).collect()
    size = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("a", "b", None)}
    assert all(abs(r.n - target[size[r.source]]) <= 20 for r in mixed)


# ---------------------------------------------------------------- classifier
def test_classifier_equals_a_plain_version(spark):
    """Grams, shares of an id, ratios and margins written out in NumPy, for a sample that holds every labelled id."""
    docs = [(i, ("good words here " if i % 3 else "bad junk!! $$ ") * (1 + i % 5) + f"t{i}", "en") for i in range(120)]
    docs += [(3, docs[3][1], "de")] * 5 + [(4, "other text of an id", "en"), (None, "no id", "en"), (500, None, "en"), (501, "", "en")]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 120)] + [(7, 0), (None, 1), (500, 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = nbsvm.classified(frame, marks).collect()

    def grams(text):
        found, b = set(), (text or "").encode()
        for n in (2, 3, 4):
            for i in range(len(b) - n + 1):
                h = n
                for c in b[i:i + n]:
                    h = ((h ^ c) * 0x01000193) & 0xFFFFFFFF
                h ^= h >> 15
                found.add(((h * 0x9E3779B1) & 0xFFFFFFFF) >> 15)
        return found

    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    known = {d: y for d, y in labels if d not in (None, 7) and not held(d) and any(r[0] == d for r in docs)}
    counts = {0: {}, 1: {}}
    for d, t, _ in docs:
        if d in known:
            share = max(1, (1 << 20) // sum(r[0] == d for r in docs))
            for g in grams(t):
                counts[known[d]][g] = counts[known[d]].get(g, 0) + share
    size = 1 << 17
    q, p = (np.array([counts[y].get(g, 0) / (1 << 20) + 1 for g in range(size)]) for y in (0, 1))
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    model = nbsvm.fit(frame, nbsvm.teaching(marks).filter(~nbsvm.held_out("doc_id")))
    assert np.allclose(model.square, ratio ** 2, rtol=1e-5)
    for r, (d, t, _) in zip(sorted(got, key=str), sorted(docs, key=lambda x: str((x[0], held(x[0]))))):
        assert r.held_out == held(r.doc_id)
    scores = {}
    for d, t, _ in docs:
        g = sorted(grams(t))
        length = math.sqrt(sum(ratio[x] ** 2 for x in g))
        margin = sum(float(model.weight[x]) for x in g) / length + model.bias if g else model.bias
        scores.setdefault(d, []).append(1 / (1 + math.exp(-(model.slope * margin + model.shift))))
    for d in scores:
        mine = sorted(r.score for r in got if r.doc_id == d)
        assert np.allclose(mine, sorted(scores[d]), atol=1e-5)
        assert all(r.predicted == int(r.score >= 0.3) for r in got if r.doc_id == d)
    right = [(r.score >= 0.5) == (r.doc_id % 3 > 0) for r in got if r.held_out and r.doc_id < 120]
    assert len(right) > 10 and np.mean(right) > 0.95


def test_hot_id_does_not_push_out_the_sample(spark):
    """The labelled id of the lowest place, copied 6,000 times: the others still teach."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = nbsvm.teaching(labels).filter(~nbsvm.held_out("doc_id")).join(docs.select("doc_id"), "doc_id")
    low = known.orderBy(F.xxhash64(F.lit("sample"), "doc_id")).first().doc_id
    hot = docs.filter(F.col("doc_id") == low).crossJoin(spark.range(6000)).drop("id")
    got = nbsvm.classified(docs.unionByName(hot), labels).filter("held_out").join(labels.select("doc_id", "quality"), "doc_id")
    right, scores = got.agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("int")), F.count_distinct("score")).first()
    assert right > 0.95 and scores > 100


def test_sample_is_bounded_in_features(spark):
    rows = [(i, " ".join(hashlib.md5(f"{i}:{j}".encode()).hexdigest() for j in range(40)), i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    few = nbsvm.fit(docs, labels, sample_features=20_000)
    all_ = nbsvm.fit(docs, labels)
    assert np.count_nonzero(few.weight) < np.count_nonzero(all_.weight) and np.array_equal(few.square, all_.square)
    found = np.flatnonzero(np.arange(1 << nbsvm.BITS) % 3 == 0)
    assert np.array_equal(nbsvm.unpacked(nbsvm.packed(found)), found) and len(nbsvm.packed(found)) <= (1 << 14) + 1
    assert np.array_equal(nbsvm.unpacked(nbsvm.packed(found[:9])), found[:9])


# ---------------------------------------------------------------- large keys of fingerprints
def test_large_keys_are_split_by_further_bits(spark, monkeypatch):
    """Fingerprints that agree in three of five blocks: each level places them five times at most, and no link is lost."""
    monkeypatch.setattr(simhash, "GROUP", 400)
    rng = np.random.default_rng(8)
    few = rng.integers(0, 1 << 25, 3000, dtype=np.uint64)
    few = np.concatenate([few, few[:1500] ^ (np.uint64(1) << rng.integers(0, 25, 1500, dtype=np.uint64))])
    fps = np.unique((np.uint64(0xABCDEF12) << np.uint64(32)) | few).view(np.int64)
    frame = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    placed, most = simhash._placed(frame, 4)
    sizes = placed.groupBy("fixed", F.col("fp").bitwiseAND(F.col("fixed"))).count()
    assert sizes.agg(F.max("count")).first()[0] <= 400
    assert len(fps) * 5 < placed.count() <= most <= len(fps) * 5 ** 4
    near = simhash.trie_classes(np.zeros(len(fps), np.int64), fps.view(np.uint64), 4)
    want = {int(f): int(fps[near == c].min()) for c in np.unique(near) if (near == c).sum() > 1 for f in fps[near == c]}
    assert {r.node: r.component for r in simhash.classes(frame, 4).collect()} == want


def test_masks_fix_disjoint_blocks_of_the_other_bits():
    for fixed in (0, 0xFFF0000000000000, 0x0F0F0F0F00000000, (1 << 64) - (1 << 12)):
        masks = simhash.finer(fixed, 5)
        parts = [m ^ fixed for m in masks]
        assert sum(parts) == (1 << 64) - 1 - fixed and all(a & b == 0 for i, a in enumerate(parts) for b in parts[:i])
        fps = np.random.default_rng(1).integers(0, 1 << 64, 50, dtype=np.uint64)
        for f, r in zip(fps.tolist(), simhash.without(fps, fixed).tolist()):
            bits = "".join(format(f, "064b")[i] for i in range(64) if not format(fixed, "064b")[i] == "1")
            assert format(r, "064b")[:len(bits)] == bits


# ---------------------------------------------------------------- running totals, sharding
def test_running_totals_keep_columns_of_any_name(spark):
    names = ["x", "_rt_tie", "_rt_part", "_before_0", "_rt_p", "_rt_of", "_g0", "_tie"]
    df = spark.createDataFrame([(i % 5, *[f"{n}{i}" for n in names[1:]]) for i in range(50)], names).repartition(3)
    got = running_totals(df, ["x"], ["_tie"], {"n": F.count(F.lit(1))})
    assert got.columns == [*names, "n"]
    assert sorted(map(tuple, got.drop("n").collect())) == sorted(map(tuple, df.collect()))
    assert sorted((r.x, r.n) for r in got.collect()) == [(x, n) for x in range(5) for n in range(1, 11)]
    placed = sharding.assign(df, ["x", "_tie"], 8)
    assert sorted(map(tuple, placed.select(*names).collect())) == sorted(map(tuple, df.collect()))


def test_sharding_query_against_a_plain_version(spark):
    """op6 over the table: sizes, checksums, and the Feistel walk written out in whole numbers."""
    got = queries.op6_sharding(spark, SF).collect()
    docs = duckdb.sql(f"SELECT doc_id, COALESCE(text, '') FROM '{SF}/documents.parquet'").fetchall()
    rows = sorted((d, zlib.crc32(t.encode()), len(t.encode()) + 1) for d, t in docs)
    n, mask = len(rows), (1 << 64) - 1
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)

    def mixed(x, turn):
        z = (x + 0x9E3779B97F4A7C15 * (turn + 1)) & mask
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        return z ^ (z >> 31)

    def place(number):
        while True:
            left, right = divmod(number, b)
            for turn in range(sharding.ROUNDS):
                if turn % 2:
                    right = (right + mixed(left, turn) % b) % b
                else:
                    left = (left + mixed(right, turn) % a) % a
            number = left * b + right
            if number < n:
                return number

    want = {(d, size, crc, "rows", place(i) % 8, place(i) // 8, None) for i, (d, crc, size) in enumerate(rows)}
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in got} == want and len(got) == n


# ---------------------------------------------------------------- the registered queries
def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").fetchall()


def test_bpe_query_equals_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = set()
    for doc_id, text, *_ in table("documents"):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.add((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), back))))
    got = queries.op2_bpe(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert set(map(tuple, got)) == want and len(got) == len(want)


def test_simhash_query_against_all_pairs(spark):
    import xxhash
    fps = {}
    for doc_id, text, *_ in table("documents"):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps[doc_id] = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
    root = {d: d for d in fps}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = queries.op3_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{fps[d]:016x}", find(d)) for d in ids}


def test_token_count_query_against_encoding_anew(spark):
    import public_tokenizers
    import tiktoken
    ranks = {}
    import base64
    for line in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"):
        token, rank = line.split()
        ranks[base64.b64decode(token)] = int(rank)
    whole = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = queries.derived_edits(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")).collect()
    want = {}
    for r in docs:
        text = r.text or ""
        before = len(whole.encode_ordinary(text))
        for e in r.edits:
            text = text[:e.place] + e.inserted + text[e.place + e.deleted:]
        want[r.doc_id] = before, len(whole.encode_ordinary(text))
    got = queries.op5_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.n_tokens_edited) for r in got} == want


def test_classifier_query_on_held_out_labels(spark):
    """The plain version is tested above; here the registered query: every row, a score each, held-out labels met."""
    sf = SF.replace("0.001", "0.01")      # some 200 held-out rows
    quality = {d: q for d, q, _ in duckdb.sql(f"SELECT * FROM '{sf}/labels.parquet'").fetchall()}
    got = queries.op9_quality_classifier(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, in duckdb.sql(f"SELECT doc_id FROM '{sf}/documents.parquet'").fetchall())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
               and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    known = [(r.score >= 0.5) == (quality[r.doc_id] == 1) for r in got if r.held_out and quality.get(r.doc_id) is not None]
    assert np.mean(known) > 0.85


def test_rules_query_against_plain_counts(spark):
    quality = {d: q for d, q, _ in table("labels")}
    got = {r.doc_id: r for r in queries.op10_quality_rules(spark, SF).collect()}
    docs = table("documents")
    assert len(got) == len(docs)
    right = []
    for doc_id, text, *_ in docs:
        text, r = text or "", got[doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        repeat = {j for i, g in enumerate(grams) if g in twice for j in (i, i + 1, i + 2)}
        failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat), failed)
        assert not (failed and r.kept)
        if not failed and quality.get(doc_id) is not None:
            right.append(r.kept == (quality[doc_id] == 1))
    assert np.mean(right) > 0.85


def test_every_query_has_sql_or_a_test_of_its_own():
    """Without SQL: a test calls the registered query by its name."""
    folder = os.path.dirname(__file__)
    source = "".join(open(os.path.join(folder, f)).read() for f in os.listdir(folder) if f.endswith(".py"))
    for name in queries.QUERIES:
        assert name in queries.ORACLES or f"queries.{name}(" in source, name


@pytest.mark.parametrize("name", ["op1_mix_sources", "op11_line_dedup", "op12_ranked_search", "op13_filter_audit"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    want = sorted(map(str, rel.project(", ".join(f'"{c}"' for c in order)).fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*order).collect()) == want
