"""WARC archives with revisit resolution.

Record headers (id, url, length, digest; no payload) are shuffled by payload digest; of equal payloads of at least
``least`` bytes the one with the smallest id is written as a response, the others as revisits that refer to it, with fresh
headers and no payload. Revisits are made of their headers alone. Which payloads to write, the scan of the pages learns from
two bitmaps over hashed (id, digest), one of revisits and one of responses: a payload whose place holds no revisit is
written where it was read, one whose place holds revisits only is passed over, and only those of places that hold both
are shuffled and joined exactly. The bitmaps have a fixed size; on corpora that fill them more payloads are shuffled, with the
same result.

Archives are written by Spark's text sink (a record's own terminator is the line separator), so they go to any
file system Spark writes to. They are rolled by bytes: records are written by size class, each class with as many
records to a file as its largest size allows. Reading parses records by Content-Length and joins revisits to their responses.

Defined results: a null payload counts as empty; rows that repeat the smallest id of a payload are all responses; a null id
is never referred to (rows without id are revisits if another row with their payload has one, else
responses); line breaks in a URL are percent-encoded, and a null URL leaves its header out; an empty table
gives an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import place_maps, place_of, shared_dir, ship, stored, with_flags

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 8 << 20


def _rows(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.unhex(F.sha2("payload", 256))})
    return rows.withColumn("place", place_of("id", "digest"))


def decided(heads: DataFrame, least: int) -> DataFrame:
    """``heads`` with ``original``: the id that a revisit refers to, else null."""
    first = heads.filter(F.col("bytes") >= least).groupBy(F.col("digest").alias("d")).agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null").drop("n")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return heads.join(first, F.col("digest") == F.col("d"), "left").select(
        *heads.columns, F.when(revisit, F.col("first")).alias("original"))


def resolved(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
             least: int = 100) -> DataFrame:
    """(id, url, payload, bytes, digest, original): original is the id that a revisit refers to, else null; the payload of a
    revisit is null, ``bytes`` and ``digest`` are those of the payload that it had."""
    rows = _rows(pages, page_id, url, payload)
    heads = stored(decided(stored(rows.drop("payload")), least))
    revisit = F.col("original").isNotNull()
    maps = place_maps(heads.groupBy("place").agg(F.max(revisit).alias("revisits"), F.max(~revisit).alias("responses")))
    names = {"revisits": "revisits", "responses": "responses"}
    marked = with_flags(rows, "place", maps, names)
    sure, unsure = marked.filter("not revisits"), marked.filter("revisits and responses")
    both = with_flags(heads.filter("original is null"), "place", maps, names).filter("revisits").select(
        F.col("id").alias("i"), F.col("digest").alias("d")).distinct()
    # no semi join: the optimizer would push it below the bitmaps and so shuffle every payload
    unsure = unsure.join(both, F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")))
    kind = heads.schema["original"].dataType
    columns = ["id", "url", "payload", "bytes", F.lower(F.hex("digest")).alias("digest"), "original"]
    responses = sure.select(*rows.columns).union(unsure.select(*rows.columns)).withColumn("original", F.lit(None).cast(kind))
    revisits = heads.filter("original is not null").withColumn("payload", F.lit(None).cast("string"))
    return responses.select(*columns).union(revisits.select(*columns))


def record(date: str) -> Column:
    """A row of :func:`resolved` as a WARC record, without the terminator."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes"), F.lit("\r\n\r\n"))
    revisit = F.col("original").isNotNull()
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: "), urn("id")), F.lit(f"WARC-Date: {date}"),
             F.concat(F.lit("WARC-Target-URI: "), target),
             F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
             F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("original"))),
             F.lit("Content-Type: application/http;msgtype=response"), F.concat(F.lit("Content-Length: "), length)]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), http,
                    F.when(revisit, F.lit("")).otherwise(F.col("payload")))


def write(rows: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 1 << 29,
          classes: tuple[int, ...] = (1 << 13, 1 << 17, 1 << 22)) -> None:
    """Write the records of :func:`resolved` as gzipped archives under ``path``, a folder for each size class.

    Payloads of an archive hold ``file_bytes`` together at most, before compression (a longer payload has its own archive).
    A class costs another scan of the lengths of the pages, its payloads are hashed and written once.
    """
    held = F.when(F.col("original").isNull(), F.col("bytes")).otherwise(0)
    for low, high in zip((-1, *classes), (*classes, None)):
        inside = held > low if high is None else (held > low) & (held <= high)
        rows.filter(inside).select(record(date).alias("value")).write.option("lineSep", "\r\n\r\n").option(
            "compression", "gzip").option("maxRecordsPerFile", 1 if high is None else max(1, file_bytes // high)).text(
            f"{path}/{'longer' if high is None else f'upto-{high}'}")


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """The (headers, block) pairs of an archive, one record in memory at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers.get("content-length", 0)))
        yield headers, block


def _id(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``: (page_id, record_type, refers_to, digest, payload).

    ``digest`` is the payload's own for responses and the header's for revisits, whose payload is null.
    """
    ship(spark)
    schema = "page_id long, record_type string, refers_to long, digest string, payload binary"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_type", "refers_to", "digest", "payload"]
        for batch in batches:
            for content in batch.column(0):
                data = pa.BufferReader(content.as_buffer())
                packed = content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b"
                rows, held = [], 0
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=data) if packed else data)):
                    kind = headers["warc-type"]
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    digest = (hashlib.sha256(payload).hexdigest() if kind == "response"
                              else headers["warc-payload-digest"].removeprefix("sha256:"))
                    rows.append((_id(headers["warc-record-id"]), kind, _id(headers.get("warc-refers-to")), digest,
                                 payload))
                    held += len(block)
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path)
    return files.select("content").mapInArrow(run, schema)


def resolve(records: DataFrame) -> DataFrame:
    """Join each revisit to its original response: adds payload_bytes, from the original's payload. The archives are
    parsed once; what is stored of them has no payloads."""
    r = stored(records.withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload"))
    originals = r.filter("record_type = 'response'").groupBy(F.col("page_id").alias("o"), F.col("digest").alias("d")).agg(
        F.max("payload_bytes").alias("original_bytes"))
    out = r.join(originals, (F.col("refers_to") == F.col("o")) & (F.col("digest") == F.col("d")), "left")
    return out.select("page_id", "record_type", "refers_to", "digest",
                      F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"))


def scratch(spark: SparkSession) -> str:
    """A new folder for archives in the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
