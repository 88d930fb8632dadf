"""WARC archives: one gzip member for each record, written and read back by Spark tasks.

Writing: payload digests decide, by aggregation, which record of equal payloads is
the response that the others revisit.  Each task then writes its rows to archives
of bounded size in the given folder, under a temporary name until complete; the
table that the writer returns names the archives that count, so what a lost or
repeated attempt leaves behind is never read.

Reading: an archive is read from front to back in pieces.  Every gzip member is
inflated step by step, a record is framed by its Content-Length, and its block and
payload digests are computed from the bytes and compared with the headers.  A
revisit names its response's record; reading looks that record up in the archives,
and the two payload digests must be the same.

Folders may be in any store that Arrow's filesystems open (file, hdfs, s3, gs).

Defined results: null html is an empty payload, a null url becomes ``urn:page:<id>``,
a null page_id is written without its header and read back as null.  Rows that
repeat the greatest page_id of equal payloads are each a response; a page crawled again with another payload is a record
of its own.  Columns beyond page_id, url
and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

LEAST_REVISIT_BYTES = 1000
#: Digests of repeated payloads that may be broadcast, 40 bytes each.
BROADCAST_DIGESTS = 200_000
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 16
LEVEL = 3
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


class DamagedArchive(ValueError):
    pass


def sha1_label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def with_roles(pages: DataFrame, scratch: Scratch, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, html) as page_id, url, payload, record_type, refers_to and refers_url.

    Digests of payloads that occur again are written as a table; while they are few,
    they go to the pages, so that payloads needn't be shuffled.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha2("payload", 256)), "size": F.octet_length("payload")})
    large = rows.filter(F.col("size") >= least_bytes).select("page_id", "url", "digest")
    repeated = large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("response"), F.count("*").alias("n")).filter("n > 1").select("digest", F.col("response.page_id").alias("response_id"), F.col("response.url").alias("response_url"))
    repeated = scratch.keep(repeated, "repeated")
    marked = rows.join(F.broadcast(repeated) if repeated.count() <= BROADCAST_DIGESTS else repeated, "digest", "left")
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return marked.select("page_id", "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("response_id")).alias("refers_to"), F.when(revisit, F.col("response_url")).alias("refers_url"))


def target_of(page_id: int | None, url: str | None) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else f"urn:page:{page_id}"


def record_id(page_id: int | None, target: str, digest: str) -> str:
    """Of a page, address and payload; only rows that repeat all three share one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {target} {digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None, refers_url: str | None = None) -> bytes:
    """One WARC/1.1 record, before compression."""
    block = HTTP_HEAD + (payload if record_type == "response" else b"")
    target, digest = target_of(page_id, url), sha1_label(hashlib.sha1(payload).digest())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: {record_id(page_id, target, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: {digest}",
        f"WARC-Block-Digest: {sha1_label(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if record_type == "revisit":
        original = target_of(refers_to, refers_url)
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, original, digest)}", f"WARC-Refers-To-Target-URI: {original}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(rows: DataFrame, folder: str, most_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes with_roles() rows as archives in folder; returns (path, n_records, n_bytes)."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        out, path, done = None, "", (0, 0)

        def close() -> pa.RecordBatch:
            out.close()
            store.move(path + ".open", path)
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [done[0]], "n_bytes": [done[1]]})

        for batch in stream:
            for row in batch.to_pylist():
                if out is not None and done[1] >= most_bytes:
                    yield close()
                    out = None
                if out is None:
                    store.create_dir(top, recursive=True)
                    path, done = f"{top}/{uuid.uuid4().hex}.warc.gz", (0, 0)
                    out = store.open_output_stream(path + ".open", compression=None)
                member = gzip_member(record(**row))
                out.write(member)
                done = (done[0] + 1, done[1] + len(member))
        if out is not None:
            yield close()

    return rows.mapInArrow(run, "path string, n_records long, n_bytes long")


def members(source) -> Iterator[Iterator[bytes]]:
    """For each gzip member of a stream, its inflated pieces; each is to be used up before the next."""
    held = b""
    ended = False

    def inflate() -> Iterator[bytes]:
        nonlocal held, ended
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            piece = unpacker.decompress(held, PIECE)  # of nothing, what is still inside
            held = unpacker.unconsumed_tail or unpacker.unused_data
            if piece:
                yield piece
            elif not unpacker.eof and not held and not (held := source.read(PIECE)):
                raise DamagedArchive("the archive ends within a member")
        ended = True

    while held or (held := source.read(PIECE)):
        ended = False
        yield inflate()
        if not ended:
            raise DamagedArchive("a member was not read to its end")


def read_record(pieces: Iterator[bytes]) -> dict:
    """Headers, lengths and digests of one record; its payload is never held whole."""
    head = b""
    for piece in pieces:
        head += piece
        if b"\r\n\r\n" in head:
            break
    head, found, rest = head.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise DamagedArchive("a record has no header")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    left = int(headers["content-length"])
    block, payload, n_payload = hashlib.sha1(), hashlib.sha1(), 0
    http, tail = b"", b""
    in_payload = False

    def take(part: bytes) -> None:
        nonlocal left, http, tail, in_payload, n_payload
        own, after = part[:left], part[left:]
        left -= len(own)
        tail += after
        block.update(own)
        if not in_payload:
            http += own
            _, cut, own = http.partition(b"\r\n\r\n")
            in_payload = bool(cut)
        if in_payload:
            payload.update(own)
            n_payload += len(own)

    take(rest)
    for piece in pieces:
        take(piece)
    if left or tail != b"\r\n\r\n":
        raise DamagedArchive("a record is not as long as its Content-Length says")
    if sha1_label(block.digest()) != headers["warc-block-digest"]:
        raise DamagedArchive("a block does not match its digest")
    kind = headers["warc-type"]
    if kind == "response" and (sha1_label(payload.digest()) != headers["warc-payload-digest"] or n_payload != int(headers["x-payload-bytes"])):
        raise DamagedArchive("a payload does not match its digest")
    number = lambda name: int(headers[name]) if name in headers and headers[name] != "None" else None
    return {
        "page_id": number("x-page-id"),
        "payload_bytes": number("x-payload-bytes"),
        "payload_digest": base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex(),
        "record_type": kind,
        "record_id": headers["warc-record-id"],
        "refers_to_record": headers.get("warc-refers-to"),
        "target_uri": headers["warc-target-uri"],
    }


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_record string, target_uri string"
RECORD_TYPE = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_record", pa.string()), ("target_uri", pa.string())])


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The records of the archives named in column path; a task reads whole archives one after the other."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in stream:
            for path in batch.column("path").to_pylist():
                held = []
                with store.open_input_stream(path, compression=None, buffer_size=PIECE) as source:
                    for pieces in members(source):
                        held.append(read_record(pieces))
                        if len(held) == 4096:
                            yield from pa.Table.from_pylist(held, RECORD_TYPE).to_batches()
                            held = []
                if held:
                    yield from pa.Table.from_pylist(held, RECORD_TYPE).to_batches()

    return archives.select("path").mapInArrow(run, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes pages as archives in the shared folder and reads all of their records back."""
    scratch = Scratch(spark, "warc")
    folder = scratch.at("archives")
    written = scratch.keep(write_archives(with_roles(pages, scratch), folder), "listing")
    n = max(1, written.count())
    return resolved(scratch.keep(read_archives(written.repartition(n), folder), "records"))


def resolved(records: DataFrame) -> DataFrame:
    """The records with refers_to, the page of the response that a revisit names; stops at one that is missing or of another payload."""
    named = records.filter(F.col("refers_to_record").isNotNull()).select(F.col("refers_to_record").alias("_id")).distinct()
    responses = records.filter("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest")).join(named, "_id", "left_semi")
    # Rows that repeat page, address and payload have one identifier.
    joined = records.join(responses.distinct(), F.col("refers_to_record") == F.col("_id"), "left")
    bad = F.col("refers_to_record").isNotNull() & ~F.coalesce(F.col("_digest") == F.col("payload_digest"), F.lit(False))
    stop = F.raise_error(F.lit("a revisit refers to no response with its payload")).cast("long")
    return joined.select("page_id", "payload_bytes", "payload_digest", "record_type", F.when(bad, stop).otherwise(F.col("_page")).alias("refers_to"), "target_uri")
