"""The operators against brute force, on fixtures with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import itertools
import math
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from barlake.llm import bpe, chat, common, edits, mixing, nbsvm, rules, sharding, simhash, topk, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# extra columns named like the operators' own, in several spellings
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, _key int, _TIE string, copies int, ids string, "
        "slot int, Component int, _stats int, _pick int")


def rows_of(long=3000):
    base = [(i, f"word{i} alpha beta gamma delta w{i % 7} x{i % 3}", "en", ["a", "b", None, "é"][i % 4]) for i in range(40)]
    odd = [(100, None, None, "a"), (101, "", "en", None), (None, "no id here", "en", "b"), (None, None, None, None),
           (102, " \t\n\x0b", "en", "b"), (103, "Same text " * 20, "en", "a"), (104, "same TEXT " * 20, "en", "b"),
           (105, "Same text " * 20, "de", "a"), (106, " ".join(f"l{i}" for i in range(long)), "fr", "é"),
           (107, "twice", "en", "a"), (107, "twice", "en", "a"), (108, "nbsp and em İΣ", "en", "a")]
    return [(*r, None, 1, "t", 2, "i", 3, 4, None, 5) for r in base + odd]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), DOCS).repartition(3).cache()


def test_mix_against_a_queue_in_order(spark, docs):
    got = mixing.mixed_words(docs).collect()
    rows = [(r[0], r[3], len(WORD.findall(r[1] or ""))) for r in rows_of()]
    names = sorted({s for _, s, _ in rows if s is not None}) + [None]
    size = {s: sum(n for _, x, n in rows if x == s) for s in names}
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    budget, target, left = 1.5 * sum(size.values()), {}, set(names)
    while True:
        level = (budget - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level > 2 * size[s]}
        if not full:
            break
        target |= {s: 2.0 * size[s] for s in full}
        left -= full
    target |= {s: weight[s] * level for s in left}
    assert math.isclose(sum(target.values()), budget)
    by_id = {}
    for d, s, n in rows:
        by_id.setdefault((d, n), []).append(s)
    taken = dict.fromkeys(names, 0)
    for r in got:
        s = next(x for x in by_id[r.doc_id, r.size] if size[x] == r.source_size)
        assert math.isclose(r.target, target[s]) and r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    longest = max(n for _, _, n in rows)
    assert all(abs(taken[s] - target[s]) <= longest for s in names) and sum(taken.values()) <= budget
    again = mixing.mixed_words(docs.repartition(5)).collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r.text or "")) for r in mixed.collect()) == sum(taken.values())


def test_mix_is_near_its_targets_on_the_table(spark):
    t = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mixed_words(t).join(t.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= 2 * r.most for r in got)


def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["", "Hello\x1cWORLD's ΑΣ İ Ⅰ <|endoftext|>x<|ENDOFTEXT|>  <|startoftext|>", "a" * 3000, "!?xyz" * 500,
             "é ́x ẛ̣", "日本語한국어 123½", None]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "i int, text string, ids string")
    got = bpe.encode(frame, path, outputs=("ids", "n_tokens", "ids_sha256", "decoded_sha256", "decoded")).collect()
    back = bpe.decode(bpe.encode(frame.drop("ids"), path, outputs=("ids",)), path).collect()
    for r, b in zip(sorted(got), sorted(back)):
        ids = library.encode(texts[r.i] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r._ids == ids and r.n_tokens == len(ids) and r.decoded == text and r.ids == "clash" and b.decoded == text
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode(frame.limit(0), path).count() == 0


def test_bpe_on_random_latin_runs():
    import random

    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBpe(open(path, encoding="utf-8").read())
    rng = random.Random(5)
    for _ in range(3000):
        x = "".join(rng.choice("aBcdé'sTreÀß½1 \x85\x1c!?<|ŸſŉİΣ") for _ in range(rng.randint(1, 100)))
        assert own.encode(x) == library.encode(x, add_special_tokens=False).ids


def classes_by_pairs(fps, distance):
    top = list(range(len(fps)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            top[find(j)] = find(i)
    return [find(i) for i in range(len(fps))]


def plain_fingerprint(text):
    import xxhash
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("group", [30_000, 3])
def test_simhash_against_all_pairs(spark, docs, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)      # 3: keys are split again and again
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    frame = docs.select((F.col("doc_id") + 100_000).alias("doc_id"), "text").union(table)
    got = simhash.near_duplicates(frame).collect()
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in frame.collect()]
    tops = classes_by_pairs([f for _, f in rows], 4)
    least = {}
    for (d, _), t in zip(rows, tops):
        least[t] = min((x for x in (least.get(t), d) if x is not None), default=None)
    want = sorted(((d, f, least[t]) for (d, f), t in zip(rows, tops)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_dedup_keeps_one_of_each_class(spark, docs):
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    named = simhash.near_duplicates(docs).select("component_id").distinct()
    assert kept.count() == named.count()
    ids = [r.doc_id for r in kept.collect()]
    assert 103 in ids and 104 not in ids and 105 not in ids and ids.count(107) <= 1
    assert simhash.deduplicate(docs.limit(0)).count() == 0


def test_trie_classes_on_dense_and_random_bits():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 300):
        base = rng.integers(0, 1 << 63, max(1, n // 6), dtype=np.uint64)
        r = base[rng.integers(0, len(base), n)]
        for _ in range(5):
            flip = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
            r = np.where(rng.random(n) < 0.5, r ^ flip, r)
        got = simhash.trie_classes(np.zeros(n, np.int64), r, 4).tolist()
        want = classes_by_pairs([int(x) for x in r], 4)
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


CONVERSATIONS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello <|im_end|>\\n"),
    (2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "good day"), (2, 3, "user", "<\\|"),
    (3, 0, "system", "be kind"), (3, 1, "user", "hi"), (4, 0, "user", None), (4, 1, None, ""), (4, 1, "assistant", "é\U0001f600"),
    (5, 0, "system", "be kind"), (5, 1, "user", "hi"), (5, 2, "assistant", "hello <|im_end|>\\n"), (5, None, "ro\nle", "\\"),
    (None, 0, "user", "x"), (None, 1, "assistant", "y"), (6, 0, "assistant", "a"), (6, 0, "assistant", "a")]


def test_chat_packs_shared_turns_once_and_reads_back(spark):
    frame = spark.createDataFrame([(*r, 1, "r") for r in CONVERSATIONS],
                                  "conv_id long, turn long, role string, text string, k int, begin string").repartition(3)
    segments, members = chat.pack(frame)
    got = {r.conv_id: r for r in chat.read_back(segments, members).collect()}
    turns = {}
    for c, t, role, text in sorted(CONVERSATIONS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    seg = sorted(segments.collect(), key=lambda r: r.begin)
    assert [s.begin for s in seg] == [0, *[s.end for s in seg[:-1]]]           # one stream, no gap
    assert len(seg) == len({tuple(t[:i]) for t in turns.values() for i in range(1, len(t) + 1)})
    paths = {}
    for m in sorted(members.collect(), key=lambda r: r.k):
        paths.setdefault(m.conv_id, []).append(m.begin)
    assert set(got) == set(turns)
    for c, t in turns.items():
        want = hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in t).encode()).hexdigest()
        loss = "".join(b for a, b in t if a == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(t), want, len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        on_path = [s for s in seg if s.begin in paths[c]]
        assert r.formatted_chars == sum(s.end - s.begin for s in on_path)
        leaf = on_path[-1].begin
        assert [s.begin for s in seg if s.begin <= leaf < s.subtree_end] == paths[c]   # its ancestors, no others
        at = 0
        for s in on_path:                                                       # position ids run on along a path
            assert s.position == at and len(s.piece) == s.end - s.begin
            at += len(s.piece)
    assert chat.read_back(*chat.pack(frame.limit(0))).count() == 0


def test_edit_counts_equal_encoding_anew(spark, docs):
    import base64

    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    count = lambda t: len(library.encode_ordinary(t))
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    frame = docs.select("doc_id", "text").union(table).withColumn("edits", F.expr(
        "array(named_struct('place', cast(doc_id % 50 as int), 'deleted', cast(doc_id % 9 as int), 'inserted', \"'\"),"
        "named_struct('place', cast(doc_id % 71 as int), 'deleted', 0, 'inserted', 're  '),"
        "named_struct('place', 100000000, 'deleted', 5, 'inserted', text), null,"
        "named_struct('place', cast(null as int), 'deleted', cast(null as int), 'inserted', cast(null as string)))"))
    frame = frame.withColumn("edits", F.when(F.col("doc_id") != 3, F.col("edits")))
    out = edits.count(frame, path, public_tokenizers.PATTERN, edits="edits",
                      outputs=("n_tokens", "n_tokens_edited", "n_reencoded", "text_edited", "tree"))
    for r in out.collect():
        text = r.text or ""
        assert r.n_tokens == count(text)
        for e in r.edits or []:
            if e is not None:
                p = min(e.place or 0, len(text))
                text = text[:p] + (e.inserted or "") + text[p + (e.deleted or 0):]
        assert r.text_edited == text and r.n_tokens_edited == count(text)
    stored = out.select("doc_id", F.col("text_edited").alias("text"), "tree")
    again = edits.count(stored, path, public_tokenizers.PATTERN, tree="tree", outputs=("n_tokens", "n_pretokens"))
    assert all(r.n_tokens == count(r.text) and r.n_pretokens == 0 for r in again.collect())


def test_token_tree_under_many_edits():
    import random
    bpe_ = edits.ByteBpe(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read(), public_tokenizers.PATTERN)
    rng = random.Random(2)
    start = " ".join(f"word{i}'s  value\n" for i in range(1500))
    tree = edits.TokenTree(bpe_, start)
    tree.encoded = 0
    for n in range(1, 121):
        p, k = rng.randint(0, len(tree.text)), rng.choice([0, 1, 3, 50, 2000])
        s = rng.choice(["", "e", " ", "'", "re", "  \n", "hello ", "x" * 90])
        want = tree.text[:p] + s + tree.text[p + k:]
        tree.edit(p, k, s)
        assert tree.text == want and tree.total == edits.TokenTree(bpe_, want).total
    assert tree.encoded < 120 * 6 * edits.LEAF          # a few leaves an edit, not the text


def test_permutation_is_one_to_one_and_inverts():
    for n in [*range(1, 70), 1000, 12_345]:
        x = np.arange(n)
        p = sharding.permute(x, n, seed=4)
        assert sorted(p) == x.tolist() and (sharding.permute(p, n, seed=4, inverse=True) == x).all()
    shard, slot = sharding.locate(77, 1000, 8)
    assert sharding.row_at(shard, slot, 1000, 8) == 77


def test_shards_are_gapless_and_reproducible(spark, docs):
    one = sharding.assign(docs, ["doc_id", "text", "lang", "source"], 8).collect()
    two = sharding.assign(docs.repartition(7), ["doc_id", "text", "lang", "source"], 8).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r._slot, r.shard)
    assert sorted(map(key, one)) == sorted(map(key, two)) and one[0].slot == 3      # the clashing column is kept
    for s in range(8):
        slots = sorted(r._slot for r in one if r.shard == s)
        assert slots == list(range(len(slots))) and abs(len(slots) - len(one) / 8) < 1
    assert all(sharding.locate(r.row_number, len(one), 8) == (r.shard, r._slot) for r in one)
    assert sharding.assign(docs.limit(0), ["doc_id"], 8).count() == 0


def test_top_k_against_every_product(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(0, 1000, 10)]
    rows += [(i + 5, list(v)) for i, v in rows[:30]]                                    # equal vectors
    rows += [(2001, None), (2002, [1.0, None]), (2003, [float("nan")] * 6), (2004, [float("-inf")] * 6), (2005, []),
             (2006, [1.0]), (2007, [0.0] * 8), (None, [1.0] * 6), (400, rows[40][1]), (700, [2.0] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = topk.top_k(topk.whole_numbers(frame), F.col("vec_id") % 100 == 0, k=10).collect()
    ok = [(i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in sorted({(i, v) for i, v in ok if i % 100 == 0}):
        best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q))[:10]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(topk.whole_numbers(frame.limit(0)), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_blocks_stay_small_with_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 50)
    v = spark.range(900).select(F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") + 1000).alias("vec_id"),
                                F.array(F.col("id") % 200, F.lit(1).cast("long")).alias("v")).repartition(4)
    asked, cand = topk.dealt(v, F.col("vec_id") == 100)
    assert cand.groupBy("cb", "qb").count().agg(F.max("count")).first()[0] < 100
    assert asked.groupBy("cb", "qb").count().agg(F.max("count")).first()[0] < 100
    assert cand.select("vec_id", "v").distinct().count() == v.distinct().count()
    got = topk.top_k(v, F.col("vec_id") == 100, k=3).filter("rank = 1").collect()
    assert len(got) == asked.select("which").distinct().count() and all(r.vec_id != 100 for r in got)


def test_warc_round_trip_and_revisits(spark, tmp_path):
    big, other = "<p>" + "x" * 200, "y" * 150 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabcé"
    rows = [(5, "u\r\nX: 1", big), (3, "v", big), (9, None, big), (1, "w", "tiny"), (2, "w", "tiny"), (4, "z", None),
            (6, "z", ""), (7, "q", other), (8, "q", other), (None, "n", other), (3, "again", big)]
    frame = spark.createDataFrame([(*r, 1, "c") for r in rows], "page_id long, url string, html string, id int, digest string")
    path = str(tmp_path / "w")
    warc.write(warc.resolved(frame.repartition(3)), path)
    records = warc.read(spark, path).cache()
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.digest)
                  for r in warc.resolve(records).collect()), key=str)
    first = {big: 3, other: 7}
    want = []
    for i, _, html in rows:
        html = html or ""
        to = first.get(html) if first.get(html, i) != i else None
        want.append((i, "revisit" if to else "response", to, len(html.encode()), hashlib.sha256(html.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert sorted(bytes(r.payload).decode() for r in records.filter("record_type = 'response'").collect()) == sorted(
        h or "" for i, _, h in rows if first.get(h or "", i) == i)
    empty = str(tmp_path / "e")
    warc.write(warc.resolved(frame.limit(0)), empty)
    assert warc.read(spark, empty).count() == 0


@pytest.mark.parametrize("bits", [1, 4, 26])
def test_warc_bitmaps_of_any_fill_give_the_same_records(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(common, "PLACE_BITS", bits)
    rows = [(i, f"u{i}", f"payload {i % 23} " * 20) for i in range(60)] + [(None, "n", "payload 3 " * 20), (7, "again", "other " * 30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write(warc.resolved(frame.repartition(3)), path)
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.resolve(warc.read(spark, path)).collect()), key=str)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html] = min(first.get(html, i), i)
    want = [(i, *(("response", None) if i == first[html] else ("revisit", first[html]))) for i, _, html in rows]
    assert got == sorted(want, key=str)


def test_warc_long_pages_and_archives_rolled_by_bytes(spark, tmp_path):
    huge = "0123456789abcdef\r\n\r\n" * 2_500_000          # 50 MB
    rows = [(1, "h", huge), (2, "h", huge)] + [(10 + i, "s", f"{i:04d}" * 250) for i in range(40)] + [
        (100 + i, "m", f"{i:04d}" * 25_000) for i in range(5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write(warc.resolved(frame), path, file_bytes=1 << 17)
    files = lambda kind: len(list((tmp_path / "w" / kind).glob("part-*")))
    assert files(f"upto-{1 << 13}") >= 41 / 16 and files(f"upto-{1 << 17}") == 5 and files("longer") == 1
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes, r.digest)
           for r in warc.resolve(warc.read(spark, path)).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {i: ("revisit" if i == 2 else "response", 1 if i == 2 else None, len(t), digest(t)) for i, _, t in rows}


def test_classifier_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = nbsvm.classified(spark.read.parquet(f"{d}/documents.parquet"), labels)
    held = got.filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    assert (held.predicted == held.quality).mean() > 0.95
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert (held.predicted[held.quality == 1]).mean() > 0.98


def test_classifier_on_odd_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (5, 0), (5, 1), (7, None), (8, 3)],
                                   "doc_id long, quality int")
    got = nbsvm.classified(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    for some in (labels.limit(0), labels.filter("quality = 1")):
        scores = {round(r.score, 9) for r in nbsvm.classified(docs, some).collect()}
        assert len(scores) == 1
    assert nbsvm.keep_good(docs, labels).columns == docs.columns
    assert nbsvm.classified(docs.limit(0), labels).count() == 0


def test_classifier_samples_the_matched_rows(spark):
    labels = spark.range(50_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"))
    docs = spark.range(0, 50_000, 499).select(F.col("id").alias("doc_id"), F.concat(
        F.when(F.col("id") % 2 == 1, "fine prose of calm water ").otherwise("#### buy $$$ now !!! "), "id").alias("text"))
    model = nbsvm.fit(docs, labels, sample=200)     # 101 of 50,000 labels have a row: all of them are fitted on
    seen = np.zeros(1 << nbsvm.BITS, bool)
    of = lambda text: model.score(nbsvm.features(text, seen))
    assert model.slope and of(b"fine prose of calm water") > 0.7 > 0.3 > of(b"#### buy $$$ now !!!")


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    y = rng.choice([-1.0, 1.0], 300)
    found = [np.unique(rng.choice(np.arange(50) if s > 0 else np.arange(30, 80), 12)) for s in y]
    neg, pos = (np.bincount(np.concatenate([f for f, s in zip(found, y) if s == k]), minlength=80) for k in (-1, 1))
    ratio = nbsvm.log_count_ratios(neg, pos)
    w, b = nbsvm.descend(found, y, ratio)
    margin = np.array([(w * ratio)[f].sum() / np.sqrt((ratio[f] ** 2).sum()) + b for f in found])
    assert (np.sign(margin) == y).mean() > 0.97


def plain_stats(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(WORD.search(line))
        seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = {g for g in grams if grams.count(g) > 1} if len(grams) < 4000 else {
        g for g, n in __import__("collections").Counter(grams).items() if n > 1}
    covered = {i + j for i, g in enumerate(grams) if g in many for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_rule_statistics_against_plain_counts(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    extra = spark.createDataFrame([(900_001, "a b c a b c a\na b\n\n \na b\na b"), (900_002, "x y z # | <> q")],
                                  "doc_id long, text string")
    frame = docs.select((F.col("doc_id") + 500_000).alias("doc_id"), "text").union(table).union(extra)
    text = {}
    for r in frame.collect():
        text.setdefault(r.doc_id, []).append(r.text)
    for r in rules.judged(frame, labels).collect():
        stats = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert stats in [plain_stats(t) for t in text[r.doc_id]]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert rules.judged(frame.limit(0), labels).count() == 0
    none = rules.judged(frame, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)


def test_learned_list_and_its_expression_agree(spark):
    rng = np.random.default_rng(4)
    n = 3000
    x = {m: rng.random(n) for m in rules.MEASURES}
    bad = (x["symbol_share"] > 0.7) & (x["mean_word"] <= 0.6) | (x["dup_line_share"] > 0.9)
    learned = rules.learn(x, bad)
    verdict = ~np.logical_or.reduce([r.covers(x) for r in learned])
    assert (verdict == ~bad).mean() > 0.97
    stats = spark.createDataFrame([tuple(int(v) for v in rng.integers(0, 60, len(rules.STATS))) for _ in range(300)],
                                  ", ".join(f"{s} long" for s in rules.STATS))
    got = stats.select(rules.verdict(learned).alias("kept"), *[F.expr(e).alias(m) for m, e in rules.MEASURES.items()]).toPandas()
    want = ~np.logical_or.reduce([r.covers({m: got[m].to_numpy() for m in rules.MEASURES}) for r in learned])
    assert (got.kept.to_numpy() == want).all()


def test_rules_keep_good_documents(spark, docs):
    t, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    kept = rules.keep_good(t, labels).join(labels, "doc_id").groupBy("quality").count().collect()
    of = {r.quality: r["count"] for r in kept}
    assert of[1] >= 320 and of.get(0, 0) <= 6
    assert rules.keep_good(docs, labels).columns == docs.columns
    assert rules.keep_good(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("hot", [3, 4])
def test_rules_learn_from_all_labels_beside_a_repeated_id(spark, hot):
    ids = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 3 != 0).cast("int").alias("quality"))
    repeats = spark.range(2000).select(F.lit(hot).cast("long").alias("doc_id"), F.col("id").alias("n"))
    rows = ids.select("doc_id", F.col("doc_id").alias("n")).union(repeats)
    n = {"n_words": F.lit(1000), "word_chars": 4000 + F.col("n"), "n_lines": F.lit(5),
         "n_symbols": F.when(F.col("doc_id") % 3 == 0, 200 + F.col("doc_id")).otherwise(F.col("doc_id") % 50)}
    stats = rows.select("doc_id", *[n.get(s, F.lit(0)).cast("long").alias(s) for s in rules.STATS]).repartition(4)
    learned = rules.learn_from(stats, ids, sample=300)
    kept = stats.select("doc_id", rules.verdict(learned).alias("kept")).distinct().collect()
    assert sum(r.kept == (r.doc_id % 3 != 0) for r in kept) >= 295      # the lowest bad value is a threshold, not above it
    again = rules.learn_from(stats.repartition(7), ids, sample=300)
    assert again == learned


@pytest.mark.parametrize("name", ["op1_mix_sources", "op4_chat", "op7_top_k", "op8_warc"])
def test_queries_equal_their_sql(spark, name):
    from barlake.llm import queries
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_pipeline_runs_and_stages_keep_their_columns(spark, tmp_path):
    import corpus_pipeline as P
    t = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(900_000, None, None, None, None), (None, "some words " * 60, "en", "src0", 5),
                                  (900_001, "", "en", None, 0)], t.schema)
    docs_ = t.union(more).union(t.limit(5))
    rows = docs_.count()
    for name, stage in P.STAGES:
        out = stage(spark, docs_, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "bpe":
            assert out.columns == t.columns
        if name.startswith("quality") or "dedup" in name:
            assert 0 < out.count() <= rows
        else:
            assert out.count() > 0
        docs_, rows = out, out.count()
    empty = t.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_token_tree_with_small_leaves(monkeypatch):
    import random
    bpe_ = edits.ByteBpe(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read(), public_tokenizers.PATTERN)
    rng = random.Random(5)
    bits = ["a", "'", "r", "e", " ", "  ", "\n", "word ", "don't ", "12", "!", "é", "中", " \n ", "'ll"]
    for leaf in (1, 2, 5):
        monkeypatch.setattr(edits, "LEAF", leaf)
        for size in (0, 1, 40, 300):
            text = "".join(rng.choices(bits, k=size))
            tree = edits.TokenTree(bpe_, text)
            for _ in range(60):
                p, k = rng.randint(0, len(text) + 2), rng.choice([0, 1, 3, 40, 10_000 if rng.random() < 0.1 else 2])
                s = "".join(rng.choices(bits, k=rng.choice([0, 1, 3, 30])))
                tree.edit(p, k, s)
                text = text[:p] + s + text[p + k:]
                assert tree.text == text and tree.total == edits.TokenTree(bpe_, text).total
                ends = {0, *(m.end() for m in bpe_.pattern.finditer(text))}
                assert set(np.cumsum(tree.chars[len(tree.chars) // 2:]).tolist()) <= ends
