"""Chat formatting over a prefix tree: conversations that share initial turns share their formatted tokens.

A token here is one code point of the formatted text. A tree node is a turn with everything before it; its key
is the running XOR of 128-bit hashes of (place, role, text), which prefix sums compute without gathering a
conversation. Conversations are ranked depth-first by the nodes at which their path branches off (a path with b
branchings needs b other conversations of up to b turns, so such a key is of the order of the square root of
the table at most). A node belongs to the first conversation that has it; its tokens are emitted once, after its
parent's subtree so far. With E(r) the tokens emitted for conversations up to rank r, a node's place is
E(first) less what its first conversation has from there on, and its subtree ends at E(last): the token at p
attends to a node's tokens exactly if ``begin <= p < subtree_end``, its own and its ancestors', causally.

Defined results: a null role or text counts as empty; turns go by number, null first, and rows with equal numbers by
role and text; repeated rows are repeated turns; null conv_ids form one conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import running_totals, ship, stored

START, END = "<|im_start|>", "<|im_end|>"


def escape(c: Column) -> Column:
    """No control string is left in the text: a backslash is doubled, and one parts < and |."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s, flags=re.S)


def template(role: Column, text: Column) -> tuple[Column, Column]:
    """A turn's head and its whole formatted text; a line break in a role is written as \\n."""
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    return head, F.concat(head, escape(text), F.lit(END + "\n"))


def turns_with_places(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, role, text, chars, upto, part): place from 1, formatted length, and length up to and with the turn.

    ``part`` is the partition that the turn had in the running totals.
    """
    empty = F.lit("")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"),
                                F.coalesce("text", empty).alias("text"))
    rows = rows.withColumn("chars", F.char_length(template(F.col("role"), F.col("text"))[1]).cast("long"))
    return stored(running_totals(rows, ["conv_id"], ["turn", "role", "text"],
                                 {"k": F.count(F.lit(1)), "upto": F.sum("chars")}, keep="part"))


def pack(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The packed stream and who reads it.

    First, one row per tree node: begin and end (its tokens' places in the stream), position (the position id
    of its first token; the ids run on from there), subtree_end, piece (its text), and loss_begin and loss_end
    (the code points of the piece under the loss mask; null where there are none). Second, rows (conv_id, k, begin).
    """
    turns = turns_with_places(conversations)
    x = turns.select("conv_id", "k", "chars", "upto", "part", F.xxhash64(F.lit(1), "k", "role", "text").alias("x1"),
                     F.xxhash64(F.lit("2"), "k", "text", "role").alias("x2"))
    keyed = running_totals(x, ["conv_id"], ["k"], {"p1": F.bit_xor("x1"), "p2": F.bit_xor("x2")}, xor=["p1", "p2"],
                           by="part")
    keyed = stored(keyed.drop("part"))
    nodes = stored(keyed.groupBy("k", "p1", "p2").agg(F.min("x1").alias("x1"), F.min("x2").alias("x2")))
    node = ["k", "p1", "p2"]
    parent = [(F.col("k") - 1).alias("pk"), F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"),
              F.col("p2").bitwiseXOR(F.col("x2")).alias("q2")]
    children = nodes.select(*node, *parent)
    # every first turn counts as a branch, so the root's children, a third of all nodes or more, meet nowhere
    later = children.filter("k > 1")
    forks = later.groupBy("pk", "q1", "q2").count().filter("count > 1").drop("count")
    branches = later.join(forks, ["pk", "q1", "q2"], "left_semi").select(*node).union(
        children.filter("k = 1").select(*node)).withColumn("branch", F.lit(True))
    steps = keyed.join(branches, node, "left")
    paths = steps.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("branch"), F.struct(*node)))).alias("path"), F.max("upto").alias("all"))
    ranks = stored(running_totals(paths, [], ["path", "conv_id"], {"rank": F.count(F.lit(1))})
                   .select(F.col("conv_id").alias("c"), "rank", "all"))
    ranked = stored(keyed.join(ranks, F.col("conv_id").eqNullSafe(F.col("c"))))
    owned = ranked.groupBy(*node).agg(F.min("rank").alias("first"), F.max("rank").alias("last"),
                                      F.min_by("conv_id", "rank").alias("owner"),
                                      F.first("chars").alias("chars"), F.first("upto").alias("upto"))
    owned = stored(owned)
    fresh = owned.groupBy(F.col("first").alias("r")).agg(F.sum("chars").alias("fresh"))
    emitted = ranks.join(fresh, F.col("rank") == F.col("r"), "left").select(
        "rank", "all", F.coalesce("fresh", F.lit(0)).alias("fresh"))
    emitted = stored(running_totals(emitted, [], ["rank"], {"sofar": F.sum("fresh")}))
    a = emitted.select(F.col("rank").alias("first"), "all", F.col("sofar").alias("upto_first"))
    b = emitted.select(F.col("rank").alias("last"), F.col("sofar").alias("subtree_end"))
    placed = owned.join(a, "first").join(b, "last")
    position = F.col("upto") - F.col("chars")
    placed = stored(placed.select(*node, "owner", "chars", position.alias("position"), "subtree_end",
                                  (F.col("upto_first") - F.col("all") + position).alias("begin")))
    members = ranked.join(placed.select(*node, "begin"), node).select("conv_id", "rank", "k", "begin")
    texts = turns.select("conv_id", F.col("k").alias("place"), "role", "text")
    head, piece = template(F.col("role"), F.col("text"))
    learned = F.col("role") == "assistant"
    segments = placed.join(texts, F.col("owner").eqNullSafe(F.col("conv_id")) & (F.col("k") == F.col("place"))).select(
        "begin", (F.col("begin") + F.col("chars")).alias("end"), "position", "subtree_end", piece.alias("piece"),
        F.when(learned, F.char_length(head)).alias("loss_begin"),
        F.when(learned, F.col("chars") - len(END) - 1).cast("int").alias("loss_end"))
    return segments, members.select("conv_id", "k", "begin")


def attention(segments: DataFrame) -> DataFrame:
    """Each segment with the range of tokens that attend to it, [begin, subtree_end), and its position ids."""
    return segments.withColumn("position_ids", F.sequence("position", F.col("position") + F.col("end")
                                                          - F.col("begin") - 1))


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*)" + re.escape(END) + r"\n", re.S)


def read_back(segments: DataFrame, members: DataFrame) -> DataFrame:
    """Per conversation, from the packed stream alone: turns and loss text with digests, and formatted length.

    A conversation's pieces stream through one task in order; hashes are updated piece by piece, so a very
    long conversation holds no more memory than its longest turn.
    """
    ship(segments.sparkSession)
    rows = members.join(segments, "begin").select("conv_id", "k", "piece", "loss_begin", "loss_end")
    kind = dict(members.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: list | None = None

        def close() -> None:
            conv, n, turns, chars, loss, formatted = now
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        for batch in batches:
            ids = batch.column(0)
            columns = [batch.column(i).to_pylist() for i in range(1, 5)]
            for conv, (_, piece, begin, end) in zip(ids.to_pylist(), zip(*columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = _TURN.fullmatch(piece).groups()
                now[1] += 1
                now[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                now[5] += len(piece)
                if begin is not None:
                    learned = unescape(piece[begin:end])
                    now[3] += len(learned)
                    now[4].update(learned.encode())
            if len(done) >= 5000:
                yield _result(done, ids.type)
                done = []
        if now is not None:
            close()
            yield _result(done, ids.type)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "k").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def _result(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*done)) or [[]] * 6
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                       "formatted_chars"])
