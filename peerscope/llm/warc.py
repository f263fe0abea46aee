"""WARC archives: write with revisits and segments, read back with segment reassembly (operator 6).

Writing: a page's payload goes into a response record (HTTP head, then the body in chunked transfer
framing).  Pages whose payload another page with a smaller id has become revisit records.  A block of
more than ``SEGMENT_BYTES`` is cut at any byte into a first record and continuation records, which may
lie anywhere in the archives.  Archives are gzip files of at most ``RECORDS_PER_FILE`` records.

Reading: a task reads an archive as a stream of fragments that end at the version line; a fragment is
completed by the following ones until its Content-Length is reached, so a payload may hold the version
line itself.  Continuation records are grouped by origin identifier, ordered by segment number, their
numbers and total length verified, and the chunked framing is decoded.  Only segmented records are
shuffled.  Revisits find their payload's length at the response they refer to.

Two payloads count as equal when their SHA-1, a second 64-bit hash and their length agree.

Defined results: null payloads are empty; equal payloads under one smallest page id (repeated rows) are
all responses; broken archives (lengths, numbers or totals that don't fit) raise an error in the task.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm.common import saved, trimming
from peerscope.session import ensure_checkpoint_dir

VERSION = b"WARC/1.1\r\n"
SEGMENT_BYTES = 16 << 10
RECORDS_PER_FILE = 20_000
CHUNK = 4096
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "page_id long, record_type string, record_id string, refers_to_id string, refers_to long, digest string, "
    "origin string, segment int, total long, block binary"
)


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    """``body`` in chunked transfer framing."""
    out = [b"%x\r\n%b\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The body behind chunked framing (chunk extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        n = int(framed[at:line].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(framed[line + 2 : line + 2 + n])
        at = line + 2 + n
        if framed[at : at + 2] != b"\r\n" or len(out[-1]) != n:
            raise ValueError("broken chunk")
        at += 2


def body_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked", head) else body


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}:{segment}')}>"


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its last line end (the writer adds that)."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return VERSION + head.encode("utf-8", "surrogatepass") + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n"


def records_of(page_id, url, payload: bytes, first, segment_bytes: int) -> Iterator[bytes]:
    """All records of one page: a revisit, a response, or a segmented response."""
    digest = digest_of(payload)
    rid = record_id(page_id, digest)
    uri = re.sub(r"[\r\n]", "", url) if url else None
    base = [("WARC-Target-URI", uri), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page_id)]
    if first is not None and first != page_id:
        revisit = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_id(first, digest)), ("X-Refers-To-Page", first)]
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *base, *revisit], HEAD)
        return
    block = HEAD + chunked(payload)
    kind = [("WARC-Type", "response"), ("WARC-Record-ID", rid), *base]
    if len(block) <= segment_bytes:
        yield record(kind, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for n, at in enumerate(cuts, 1):
        piece = block[at : at + segment_bytes]
        if n == 1:
            yield record([*kind, ("WARC-Segment-Number", 1)], piece)
        else:
            own = record_id(page_id, digest, n)
            last = [("WARC-Segment-Total-Length", len(block))] if n == len(cuts) else []
            yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Segment-Origin-ID", rid),
                          ("WARC-Segment-Number", n), ("WARC-Date", DATE), ("X-Page-Id", page_id), *last], piece)


def with_first_page(pages: DataFrame, payload: Column, least_bytes: int = 0) -> DataFrame:
    """``pages`` with ``_first``: the smallest page id of the rows with an equal payload of at least
    ``least_bytes`` bytes.  The minimum aggregates before the shuffle and only payloads seen more than
    once are joined; a very common payload is a skewed side that adaptive execution splits."""
    same = ["_sha1", "_x", "_n"]
    keyed = pages.withColumn("_payload", payload).withColumns(
        {"_sha1": F.sha1("_payload"), "_x": F.xxhash64("_payload"), "_n": F.octet_length("_payload")}
    )
    firsts = keyed.where(F.col("_n") >= least_bytes).groupBy(*same).agg(F.min("page_id").alias("_first"))
    return keyed.join(firsts, same, "left").drop(*same)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write pages (page_id, url, html) as WARC archives (gzip) into the folder ``path``."""
    rows = with_first_page(
        pages.select("page_id", "url", F.col("html")), F.coalesce(F.col("html"), F.lit("")).cast("binary"), least_bytes
    ).select("page_id", "url", "_payload", "_first")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for r in records_of(page_id, url, payload, first, segment_bytes):
                    out.append(r)
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = rows.mapInArrow(trimming(render), "record binary")
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.mode("overwrite")
        .option("lineSep", "\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path`` (RECORD_SCHEMA), blocks as they lie in the records."""
    lines = spark.read.option("lineSep", VERSION.decode()).text(path)
    rows = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, file, out, size = [], None, [], 0
        head, have, need = b"", 0, None
        names = [f.split(" ")[0] for f in RECORD_SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(),
                 pa.int64(), pa.binary()]

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [[]] * len(names)
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
            out.clear()
            return made

        def number(x):
            return None if x is None else int(x)

        for batch in batches:
            for value, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != file:
                    if held:
                        raise ValueError(f"{file}: the last record is cut off")
                    file = name
                    if value == b"":
                        continue  # what precedes the first version line
                held += [VERSION, value] if held else [value]
                have = have + len(VERSION) + len(value) if len(held) > 1 else len(value)
                if need is None:  # a head may hold the version line too
                    held = [b"".join(held)]
                    head, sep, _ = held[0].partition(b"\r\n\r\n")
                    if not sep:
                        continue
                    f = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n"))
                    n = int(f["Content-Length"])
                    need = len(head) + n + 8
                if have < need:
                    continue
                rest = b"".join(held)[len(head) + 4 :]
                if rest[n:] != b"\r\n\r\n":
                    raise ValueError(f"{file}: a record whose length is not its Content-Length")
                out.append((number(f.get("X-Page-Id") if f.get("X-Page-Id") != "None" else None), f["WARC-Type"],
                            f["WARC-Record-ID"], f.get("WARC-Refers-To"), number(f.get("X-Refers-To-Page")),
                            (f.get("WARC-Payload-Digest") or "").removeprefix("sha1:") or None,
                            f.get("WARC-Segment-Origin-ID"), number(f.get("WARC-Segment-Number")),
                            number(f.get("WARC-Segment-Total-Length")), rest[:n]))
                size += n
                held, need = [], None
                if size > 8 << 20:
                    yield flushed()
                    size = 0
        if held:
            raise ValueError(f"{file}: the last record is cut off")
        yield flushed()

    return rows.mapInArrow(trimming(parse), RECORD_SCHEMA)


def reassembled(records: DataFrame) -> DataFrame:
    """Responses and revisits with whole blocks; continuation records are joined to their origin.

    A group is the segments of one record, bounded by one page's size.  Equal records (a repeated page)
    have one identifier; their segments are joined once and come as often as there are first ones."""
    whole = records.where("record_type <> 'continuation' AND segment IS NULL")
    parts = records.where("segment IS NOT NULL").withColumn("origin", F.coalesce("origin", "record_id"))
    keep = ["page_id", "record_type", "record_id", "refers_to_id", "refers_to", "digest"]
    joined = parts.groupBy("origin").agg(
        *[F.max(F.when(F.col("record_type") != "continuation", F.col(c))).alias(c) for c in keep],
        F.max("total").alias("total"),
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("_s"),
        F.count(F.when(F.col("segment") == 1, 1)).alias("_copies"),
    )
    numbers = F.transform("_s", lambda s: s["segment"])
    in_order = numbers == F.sequence(F.lit(1), F.size("_s"))

    @F.arrow_udf("binary")
    def end_to_end(pieces: pa.Array) -> pa.Array:
        return pa.array([b"".join(p) for p in pieces.to_pylist()], pa.binary())

    joined = joined.withColumn("block", end_to_end(F.transform("_s", lambda s: s["block"])))
    good = in_order & (F.octet_length("block") == F.col("total")) & F.col("record_id").isNotNull()
    checked = F.when(good, F.col("block")).otherwise(
        F.raise_error(F.concat(F.lit("segments of "), "origin", F.lit(" don't fit"))).cast("binary")
    )
    joined = joined.withColumn("block", checked).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("_copies", F.lit(1)))))
    return whole.select(*keep, "block").union(joined.select(*keep, "block"))


def read_pages(records: DataFrame) -> DataFrame:
    """Per page: page_id, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to."""

    @F.arrow_udf("struct<payload:binary,digest:string>")
    def decoded(kinds: pa.Array, blocks: pa.Array) -> pa.Array:
        bodies = [body_of(b) if k == "response" else None for k, b in zip(kinds.to_pylist(), blocks.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array(bodies, pa.binary()), pa.array([None if b is None else digest_of(b) for b in bodies], pa.string())],
            names=["payload", "digest"],
        )

    whole = reassembled(records).withColumn("_d", decoded("record_type", "block"))
    wrong = (F.col("record_type") == "response") & (F.col("_d.digest") != F.col("digest"))
    return whole.select(
        "page_id",
        F.col("_d.payload").alias("payload"),
        F.octet_length("_d.payload").cast("long").alias("payload_bytes"),
        F.when(wrong, F.raise_error(F.concat(F.lit("digest of "), "record_id"))).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def archive_summary(pages: DataFrame, name: str = "archives", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives into the shared folder, read them back, one row per record:
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/peerscope/{name}-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    # saved: the archives are read once, though revisits look up their response
    read = saved(read_pages(read_records(spark, path)).drop("payload"), f"{name}-read")
    lengths = read.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("_n"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = read.where("record_type = 'response'").select(*cols)
    revisits = read.where("record_type = 'revisit'").join(lengths, "payload_digest", "left")
    return responses.union(revisits.select("page_id", F.col("_n").alias("payload_bytes"), *cols[2:]))
