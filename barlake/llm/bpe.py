"""BPE encoding and decoding of whole texts, as the ``tokenizers`` library does it from the same file.

The merge loop keeps a word's parts as one array of boundaries with the rank of each adjacent pair beside it:
scan for the smallest rank, delete the boundary after it, and look up the ranks of the two pairs that changed.
A word above ``LONG`` symbols takes a heap of the same ranks instead, so that a text without white space costs
n log n. Words are found once per worker: a bounded cache maps a run between ASCII white space to its ids.

Defined results: a null text is encoded as an empty one (no ids, decoded text empty); special tokens written in a
text are their ids, as in the library; extra columns are carried along by :func:`encode`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barlake.llm.common import free_name, ship

LONG = 64            # symbols of a word up to which the rank array is scanned
CACHED = 400_000     # runs a worker keeps
SLICE_BYTES = 4 << 20


SHIFT = 24           # a pair of ids as one number: left << SHIFT | right


def merge_short(parts: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """Merge the symbols of a word by contiguous rank array; ``made`` has the id that each rank's merge gives."""
    none = len(made)
    get = ranks.get
    rank = [get(a << SHIFT | b, none) for a, b in zip(parts, parts[1:])]
    while rank and (low := min(rank)) != none:
        i = rank.index(low)
        parts[i] = new = made[low]
        del parts[i + 1], rank[i]
        if i:
            rank[i - 1] = get(parts[i - 1] << SHIFT | new, none)
        if i < len(rank):
            rank[i] = get(new << SHIFT | parts[i + 1], none)
    return parts


def merge_long(parts: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """The same result for long words: a heap of (rank, place) over a linked list of the parts."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = (a << SHIFT | b for a, b in zip(parts, parts[1:]))
    heap = [(ranks[p], i, p) for i, p in enumerate(pairs) if p in ranks]
    heapq.heapify(heap)
    while heap:
        rank, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= n or parts[i] << SHIFT | parts[j] != pair:
            continue
        parts[i], parts[j] = made[rank], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (p := parts[k] << SHIFT | parts[after[k]]) in ranks:
                heapq.heappush(heap, (ranks[p], k, p))
    return [p for p in parts if p >= 0]


class WordBpe(dict):
    """A tokenizer from its JSON. As a dict it is the cache from a run of text to its ids."""

    def __init__(self, spec: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.library, spec = Tokenizer.from_str(spec), json.loads(spec)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {self.vocab[a] << SHIFT | self.vocab[b]: i for i, (a, b) in enumerate(merges)}
        self.made = [self.vocab[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
                                if self.special else r"(?!)")
        strings = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.words: dict[str, list[int]] = {}
        # lower case by character, and words split as _LATIN_WORDS does: then the fast path agrees with the library
        self.latin = _LATIN_SPEC in json.dumps(spec["pre_tokenizer"]) and '"Lowercase"' in json.dumps(spec["normalizer"])
        self.tokens = [strings.get(i, "") for i in range(max(strings) + 1)]
        self.digits = [str(i) for i in range(len(self.tokens))]

    def word(self, word: str) -> list[int]:
        """Ids of one pre-token in the byte alphabet."""
        parts = [*map(self.vocab.get, word[:-1]), self.vocab.get(word[-1] + self.suffix)]
        if None in parts:   # the model has no such symbol and no unknown token: the library leaves it out
            parts = [p for p in parts if p is not None]
        return (merge_short if len(parts) <= LONG else merge_long)(parts, self.ranks, self.made)

    def pre_tokens(self, piece: str) -> list[str]:
        """The library's own normalizer and pre-tokenizer decide on all but early Latin characters."""
        if self.latin:
            if piece.isascii() and piece.isprintable():
                return _LATIN_WORDS.findall(piece.lower())
            if _LATIN.fullmatch(piece):
                return ["".join(map(_BYTES.__getitem__, w.encode())) for w in _LATIN_WORDS.findall(piece.lower())]
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))]

    def __missing__(self, run: str) -> tuple[int, ...]:
        ids: list[int] = []
        for piece in self.split.split(run):
            if piece in self.special:
                ids.append(self.special[piece])
            elif piece:
                for word in self.pre_tokens(piece):
                    got = self.words.get(word)
                    if got is None:
                        got = self.word(word)
                        if len(word) <= LONG:
                            if len(self.words) >= CACHED:
                                self.words.clear()
                            self.words[word] = got
                    ids += got
        got = tuple(ids)
        if len(run) <= LONG:
            if len(self) >= CACHED:
                self.clear()
            self[run] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        # white space ends a word and is dropped, and no composition reaches over it: runs stand alone
        return list(chain.from_iterable(map(self.__getitem__, _RUN.findall(text)))) if text else []

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


_RUN = re.compile(r"[^ \t-\r]+")


def _byte_alphabet() -> list[str]:
    """The printable characters stand for their own bytes, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _chars(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == kind)


# Up to U+017F (but U+0130) NFC changes nothing and lower case is a single character there.
_LATIN = re.compile("[\x00-\u012f\u0131-\u017f]*")
_BYTES = _byte_alphabet()
_SPACE = " \t-\r\x85\xa0"
_LATIN_SPEC = json.dumps(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_chars('L')}]+|[{_chars('N')}]|"
                          f"[^{_SPACE}{_chars('L')}{_chars('N')}]+")
_loaded: dict[str, WordBpe] = {}


def load(key: str, spec: str) -> WordBpe:
    """The worker's tokenizer for this file, with its cache."""
    if key not in _loaded:
        _loaded[key] = WordBpe(spec)
    return _loaded[key]


#: Columns that encode() can add: Arrow type, Spark type and value from the tokenizer, ids and decoded text.
OUTPUTS = {
    "ids": (pa.list_(pa.int32()), T.ArrayType(T.IntegerType()), lambda t, ids: ids),
    "decoded": (pa.string(), T.StringType(), lambda t, ids: t.decode(ids)),
    "n_tokens": (pa.int64(), T.LongType(), lambda t, ids: len(ids)),
    "ids_sha256": (pa.string(), T.StringType(),
                   lambda t, ids: hashlib.sha256(" ".join(map(t.digits.__getitem__, ids)).encode()).hexdigest()),
    "decoded_sha256": (pa.string(), T.StringType(),
                       lambda t, ids: hashlib.sha256(t.decode(ids).encode()).hexdigest()),
}


def encode(df: DataFrame, tokenizer: str, text: str = "text", outputs: tuple[str, ...] = ("ids", "decoded"),
           keep: list[str] | None = None) -> DataFrame:
    """Add ``outputs`` (see OUTPUTS) for each whole text; ``tokenizer`` is a file the driver reads.

    ``keep`` names the columns to carry along (default all); a clash with an output gets underscores before
    the output's name. No shuffle: each task works batch by batch, in slices of a few MB of text.
    """
    spark = df.sparkSession
    ship(spark)
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    keep = df.columns if keep is None else keep
    carried = df.select(*[f"`{c}`" for c in keep])
    names = {o: free_name(carried, o) for o in outputs}
    body = free_name(carried, "_text")
    schema = T.StructType([*carried.schema.fields, *[T.StructField(names[o], OUTPUTS[o][1]) for o in outputs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load(tokenizer, spec.value)
        for batch in batches:
            step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                cols: dict[str, list] = {o: [] for o in outputs}
                for s in part.column(part.num_columns - 1):
                    ids = t.encode(s.as_py())
                    for o in outputs:
                        cols[o].append(OUTPUTS[o][2](t, ids))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(cols[o], OUTPUTS[o][0]) for o in outputs]],
                    names=[*part.schema.names[:-1], *names.values()])

    source = df.select(*[f"`{c}`" for c in keep], df[f"`{text}`"].alias(body))
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Add the decoded text of an array of ids, special tokens included; null gives the empty text."""
    spark = df.sparkSession
    ship(spark)
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(free_name(df, output), T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load(tokenizer, spec.value)
        for batch in batches:
            texts = [t.decode(x.as_py() or []) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
