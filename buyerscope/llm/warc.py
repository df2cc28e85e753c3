"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is three records: the request, the response (or a revisit, when another
capture with the same payload has the response) and metadata. Request and metadata name
the response or revisit in WARC-Concurrent-To. ``assemble`` joins the records of an
archive through these identifiers and gives one nested row a capture.

Files hold one gzip member a record and are written by tasks into the shared folder; a
table names the files of the attempts that counted.

Defined cases: a null html is an empty payload, and empty payloads are compared like
others. Null URLs become empty. Null page_ids are smaller than all others. Of rows with
equal payload and page_id one is the response. Records whose partner is missing give a
capture with null there. An empty table gives no capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.llm.shared_files import attempt_name, mapped, new_folder, one_task_each, opened
from buyerscope.sources.staging import drop_staged, staged

DATE = "2024-01-01T00:00:00Z"
#: Bytes of a file (before compression) after which the next one begins.
FILE_BYTES = 1 << 27
CRLF = b"\r\n"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "https://example.com/captures")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(number: int, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind}/{number}')}>"


def record(kind: str, own_id: str, fields: dict[str, str], block: bytes) -> bytes:
    """One record, compressed by itself."""
    head = {"WARC-Type": kind, "WARC-Record-ID": own_id, "WARC-Date": DATE} | fields | {"Content-Length": str(len(block))}
    lines = [b"WARC/1.1", *[f"{k}: {v}".encode() for k, v in head.items()], b"", b""]
    return gzip.compress(CRLF.join(lines) + block + CRLF * 2, 1, mtime=0)


def capture(row: dict) -> list[bytes]:
    """The three records of a page; ``target`` is the number of the page that has its payload."""
    n, payload, url = row["number"], row["html"], " ".join(row["url"].split())
    main, digest = record_id(n, "response"), f"sha1:{digest32(payload)}"
    path = url.partition("://")[2].partition("/")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    at = {"WARC-Target-URI": url}
    fields = at | {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": digest}
    if row["target"] is None:
        response = record("response", main, fields, head + payload)
    else:
        profile = {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
        fields |= profile | {"WARC-Refers-To": record_id(row["target"], "response")}
        response = record("revisit", main, fields, head)
    ask = f"GET /{path[2]} HTTP/1.1\r\nHost: {path[0]}\r\n\r\n".encode()
    with_main = at | {"WARC-Concurrent-To": main}
    request = record("request", record_id(n, "request"), with_main | {"Content-Type": "application/http; msgtype=request"}, ask)
    notes = f"pageId: {'' if row['page_id'] is None else row['page_id']}\r\n".encode()
    metadata = record("metadata", record_id(n, "metadata"), with_main | {"Content-Type": "application/warc-fields"}, notes)
    return [request, response, metadata]


def write(pages: DataFrame) -> list[str]:
    """Write all pages (page_id, url, html) as WARC files; returns the files.

    Which page answers for a payload is decided on digests alone: the largest page_id.
    Only payloads that occur more than once are joined back.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    rows = staged(
        pages.select(
            F.monotonically_increasing_id().alias("number"), F.col("page_id").cast("long"),
            F.coalesce(F.col("url"), F.lit("")).alias("url"), utf8("html").alias("html"), F.sha1(utf8("html")).alias("sha1"),
        ),
        "pages",
    )
    first = F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "number"))
    shared = rows.groupBy("sha1").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = staged(shared.select(F.col("sha1").alias("of"), F.col("first.number").alias("first")), "shared")
    known = rows.join(shared, F.col("sha1") == F.col("of"), "left").select(
        "number", "page_id", "url", "html", F.when(F.col("first") != F.col("number"), F.col("first")).alias("target")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        file, size = None, 0
        for b in slices(batches, "html"):
            for row in b.to_pylist():
                if file is None:
                    uri = f"{folder}/{attempt_name(part)}.warc.gz"
                    where, path = opened(uri)
                    file, size = where.open_output_stream(path, compression=None), 0
                    file.write(record("warcinfo", record_id(row["number"], "warcinfo"), {"Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                for data in capture(row):
                    file.write(data)
                size += len(row["html"])
                if size >= FILE_BYTES:
                    file.close()
                    yield pa.RecordBatch.from_pylist([{"file": uri}])
                    file = None
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pylist([{"file": uri}])

    files = sorted(r.file for r in known.mapInArrow(run, "file string").collect())
    drop_staged(rows)
    drop_staged(shared)
    return files


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one decompressed record."""
    head, _, rest = data.partition(CRLF * 2)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def members(data) -> Iterator[bytes]:
    """The decompressed members of a gzip file, one after another."""
    view, at = memoryview(data), 0
    while at < len(view):
        one, out = zlib.decompressobj(31), []
        while not one.eof:
            piece = view[at : at + (1 << 16)]
            if not len(piece):
                raise ValueError("a record is cut off")
            out.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        yield b"".join(out)


FIELDS = {
    "record_id": "warc-record-id", "kind": "warc-type", "concurrent_to": "warc-concurrent-to", "refers_to": "warc-refers-to",
    "uri": "warc-target-uri", "date": "warc-date", "digest": "warc-payload-digest", "content_type": "content-type",
}


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """All records of the files: header fields and the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*[(k, pa.string()) for k in FIELDS], ("block", pa.binary())])
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows, size = [], 0
                for data in members(mapped(uri, "u1")):
                    fields, block = parse(data)
                    rows.append({k: fields.get(f) for k, f in FIELDS.items()} | {"block": block})
                    size += len(block)
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = ", ".join(f"{k} string" for k in FIELDS) + ", block binary"
    return one_task_each(spark, [(f,) for f in files], "file string").mapInArrow(run, schema)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row a capture: (capture_id, request, response, metadata).

    response is the response or revisit record, the others those that name it in
    concurrent_to. A capture of which a record is missing has null there; of two records
    of a kind for one capture the one with the smaller id counts.
    """

    def of(kind: str):
        part = found.where(F.col("kind") == kind)
        return part.where("concurrent_to is not null").groupBy("concurrent_to").agg(F.min(F.struct(*found.columns)).alias(kind))

    main = found.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), F.struct(*found.columns).alias("response")
    )
    request = of("request").withColumnRenamed("concurrent_to", "capture_id")
    metadata = of("metadata").withColumnRenamed("concurrent_to", "capture_id")
    return main.join(request, "capture_id", "full").join(metadata, "capture_id", "full").select(
        "capture_id", "request", "response", "metadata"
    )


def payloads(captures: DataFrame) -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to) of each capture.

    A revisit's payload is the one of the response that it refers to. Payloads that don't
    match their digest are an error.
    """
    block = "response.block"
    payload = F.expr(f"substring({block}, locate('\\r\\n\\r\\n', decode({block}, 'ISO-8859-1')) + 4)")
    page = F.regexp_extract(F.decode("metadata.block", "UTF-8"), r"pageId: (-?\d+)", 1)
    facts = captures.where("response is not null").select(
        "capture_id",
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.col("response.kind").alias("record_type"),
        F.col("response.refers_to").alias("target"),
        F.regexp_replace("response.digest", "^sha1:", "").alias("payload_digest"),
        F.when(F.col("response.kind") == "response", F.octet_length(payload)).cast("long").alias("own_bytes"),
        F.when(F.col("response.kind") == "response", F.sha1(payload)).alias("own_sha1"),
    )
    known = staged(facts, "captures")
    wrong = known.where("record_type = 'response'").select("payload_digest", "own_sha1").mapInArrow(_wrong, "n long").agg(F.sum("n")).first()[0]
    if wrong:
        raise ValueError(f"{wrong} payloads don't match their digest")
    responses = known.where("record_type = 'response'").select(
        F.col("capture_id").alias("of"), F.col("page_id").alias("of_page"), F.col("own_bytes").alias("of_bytes")
    )
    return known.join(responses, F.col("target") == F.col("of"), "left").select(
        "page_id", F.coalesce("own_bytes", "of_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("of_page")).alias("refers_to"),
    )


def _wrong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many base32 digests differ from the hexadecimal ones beside them."""
    for b in batches:
        pairs = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        n = sum(base64.b32decode(said).hex() != own for said, own in pairs)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])
