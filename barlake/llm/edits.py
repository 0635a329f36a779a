"""Edit-aware token counts: segment trees over the pre-tokens of each document.

A document's pre-tokens are grouped into leaves of ``LEAF``; two heap-ordered segment trees hold sums of
characters and of tokens. An edit finds its leaves by descending the tree of characters, pre-tokenizes anew from the
start of a leaf that lies ``CONTEXT`` characters before the edit, and stops where a pre-token ends at an old leaf's
end behind the edit: from there on the old leaves stand. Only the leaves in between are encoded again and
their ancestors' sums updated.

Defined results: a null text counts as empty; places beyond the text are moved to its end; edits without a place or
deletion count as 0, a null insertion as empty; a null array has no edits; edits apply in order, each to the result of the
one before; repeated rows are counted alike; extra columns are carried along.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barlake.llm.common import free_name, ship

LEAF = 64           # pre-tokens of a leaf
CONTEXT = 4         # characters that a pre-token's end can depend on (longest contraction, white space and its next)
CACHED = 400_000    # pre-tokens a worker keeps, of up to LONG characters
LONG = 64
SLICE_BYTES = 4 << 20


class ByteBpe(dict):
    """Token counts of pre-tokens from a file of ranked byte strings. As a dict: cache from pre-token to count."""

    def __init__(self, ranks: bytes, pattern: str):
        super().__init__()
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.pattern = regex.compile(pattern)
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __missing__(self, word: str) -> int:
        n = len(self.library.encode_ordinary(word))
        if len(word) <= LONG:
            if len(self) >= CACHED:
                self.clear()
            self[word] = n
        return n


class TokenTree:
    """The segment trees of one document. ``chars`` and ``tokens`` are heaps: node i has children 2i and 2i + 1."""

    def __init__(self, bpe: ByteBpe, text: str, chars: list[int] | None = None, tokens: list[int] | None = None):
        self.bpe, self.text, self.encoded = bpe, text, 0
        if chars is None:
            words = bpe.pattern.findall(text)
            self.encoded = len(words)
            lengths, counts = [*map(len, words)], [*map(bpe.__getitem__, words)]
            leaves = range(0, len(words), LEAF)
            self._build([sum(lengths[i:i + LEAF]) for i in leaves], [sum(counts[i:i + LEAF]) for i in leaves])
        else:
            self.chars, self.tokens = list(chars), list(tokens)

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        size = 1
        while size < len(chars):
            size *= 2
        self.chars = [0] * size + chars + [0] * (size - len(chars))
        self.tokens = [0] * size + tokens + [0] * (size - len(tokens))
        for i in range(size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _leaves(self, begin: int, safe: int, old: int, old_end: int) -> tuple[list[int], list[int], int]:
        """Encode from ``begin`` on, up to an end of an old leaf at or behind ``safe``: (chars, tokens, that leaf).

        ``old_end`` is where leaf ``old`` ends in the new text; later ends are looked up as the encoding passes them.
        """
        chars, tokens, n, count, at = [], [], 0, 0, begin
        start, size = begin, len(self.chars) // 2
        for m in self.bpe.pattern.finditer(self.text, begin):
            at, n, count = m.end(), n + 1, count + self.bpe[m.group()]
            self.encoded += 1
            while old_end < at and old < size - 1:
                old += 1
                old_end += self.chars[size + old]
            stop = at >= safe and at == old_end
            if n == LEAF or stop:
                chars.append(at - start)
                tokens.append(count)
                start, n, count = at, 0, 0
            if stop:
                return chars, tokens, old
        if n:
            chars.append(at - start)
            tokens.append(count)
        return chars, tokens, size - 1

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds a place, by descent."""
        i, size, begin = 1, len(self.chars) // 2, 0
        while i < size:
            left = self.chars[2 * i]
            if place < left:
                i = 2 * i
            else:
                place, begin, i = place - left, begin + left, 2 * i + 1
        return i - size, begin

    def edit(self, place: int, deleted: int, inserted: str) -> None:
        """Delete characters at a place and insert a string there."""
        place = min(max(place, 0), len(self.text))
        deleted = min(max(deleted, 0), len(self.text) - place)
        if not deleted and not inserted:
            return
        size = len(self.chars) // 2
        first, begin = self.leaf_at(max(place - CONTEXT, 0)) if self.text else (0, 0)
        while first > 0 and self.chars[size + first] == 0:      # an empty leaf behind the last one
            first -= 1
            begin -= self.chars[size + first]
        grown = len(inserted) - deleted
        self.text = self.text[:place] + inserted + self.text[place + deleted:]
        old, end = first, begin + self.chars[size + first]
        while end < place + deleted and old < size - 1:     # the leaves that the edit cuts
            old += 1
            end += self.chars[size + old]
        self._replace(first, *self._leaves(begin, place + len(inserted), old, end + grown))

    def _replace(self, first: int, chars: list[int], tokens: list[int], last: int) -> None:
        """Put new leaves in the place of old ones; where they don't fit the heap is laid out anew, unencoded."""
        size, room = len(self.chars) // 2, last - first + 1
        if len(chars) > room:
            merged_c = self.chars[size:size + first] + chars + self.chars[size + last + 1:]
            merged_t = self.tokens[size:size + first] + tokens + self.tokens[size + last + 1:]
            some = [i for i, c in enumerate(merged_c) if c]
            self._build([merged_c[i] for i in some], [merged_t[i] for i in some])
            return
        for j in range(room):
            i = size + first + j
            self.chars[i], self.tokens[i] = (chars[j], tokens[j]) if j < len(chars) else (0, 0)
        lo, hi = size + first, size + last
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            for i in range(lo, hi + 1):
                self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
                self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]


_loaded: dict[str, ByteBpe] = {}


def _load(key: str, ranks: bytes, pattern: str) -> ByteBpe:
    if key not in _loaded:
        _loaded[key] = ByteBpe(ranks, pattern)
    return _loaded[key]


TREE = T.StructType([T.StructField("chars", T.ArrayType(T.IntegerType())),
                     T.StructField("tokens", T.ArrayType(T.IntegerType()))])
EDITS = "array<struct<place:int,deleted:int,inserted:string>>"
#: What count() can add, from the tree before and after the edits.
OUTPUTS = {"n_tokens": T.LongType(), "n_tokens_edited": T.LongType(), "n_edits": T.LongType(),
           "n_pretokens": T.LongType(), "n_reencoded": T.LongType(), "text_edited": T.StringType(), "tree": TREE}


def count(df: DataFrame, ranks: str, pattern: str, text: str = "text", edits: str | None = None,
          tree: str | None = None, outputs: tuple[str, ...] = ("n_tokens", "n_tokens_edited", "tree"),
          keep: list[str] | None = None) -> DataFrame:
    """Count the tokens of each whole text, then of the text with its edits, encoding only what edits touch.

    ``edits`` names a column of type EDITS; ``tree`` one with the TREE of an earlier call, which saves encoding the
    unedited text. With "tree" and "text_edited" among ``outputs`` the state can be stored and edited again.
    """
    spark = df.sparkSession
    ship(spark)
    with open(ranks, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())
    keep = df.columns if keep is None else keep
    carried = df.select(*[f"`{c}`" for c in keep])
    names = [free_name(carried, o) for o in outputs]
    schema = T.StructType([*carried.schema.fields, *[T.StructField(n, OUTPUTS[o]) for n, o in zip(names, outputs)]])
    arrow = {"text_edited": pa.string(), "tree": pa.struct([("chars", pa.list_(pa.int32())),
                                                            ("tokens", pa.list_(pa.int32()))])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(ranks + pattern, file.value, pattern)
        for batch in batches:
            step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                body, todo, state = (part.column(len(keep) + i) for i in range(3))
                rows = []
                for t, e, s in zip(body, todo, state):
                    s = s.as_py()
                    doc = TokenTree(bpe, t.as_py() or "", s and s["chars"], s and s["tokens"])
                    got = {"n_tokens": doc.total, "n_pretokens": doc.encoded, "n_edits": 0}
                    doc.encoded = 0
                    for one in e.as_py() or []:
                        if one is not None:
                            doc.edit(one["place"] or 0, one["deleted"] or 0, one["inserted"] or "")
                            got["n_edits"] += 1
                    got |= {"n_tokens_edited": doc.total, "n_reencoded": doc.encoded, "text_edited": doc.text,
                            "tree": {"chars": doc.chars, "tokens": doc.tokens}}
                    rows.append([got[o] for o in outputs])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)],
                     *[pa.array(c, arrow.get(o, pa.int64())) for o, c in zip(outputs, zip(*rows))]],
                    names=schema.names)

    from pyspark.sql import functions as F
    none = F.lit(None)
    source = df.select(*[f"`{c}`" for c in keep], F.col(f"`{text}`").alias("__text"),
                       (F.col(f"`{edits}`") if edits else none.cast(EDITS)).cast(EDITS).alias("__edits"),
                       (F.col(f"`{tree}`") if tree else none.cast(TREE)).cast(TREE).alias("__tree"))
    return source.mapInArrow(run, schema)
