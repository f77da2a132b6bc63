"""WARC archives: a sink and a source of records, and the assembly of captures from them.

A capture is written as three records, each a gzip member of its own: the request, the
response (or a revisit that refers to the response with the same payload) and metadata. The
request and the metadata name the response or revisit in ``WARC-Concurrent-To``. Assembly
joins the records through these identifiers and gives one nested row per capture.

Archives are written by Spark's text writer, so its commit protocol holds: a value is the
bytes of a capture's members, the line separator an empty gzip member. Files end in ``.txt``;
they are read by their content. A file is read whole by one task; ``most_captures`` bounds it.

Defined results: a null payload is empty, a null URL is written as an empty target and read
back as null. Captures of equal payload and equal least id are all responses, with one record
id if their rows are equal. A record of an unknown type is read but belongs to no capture. A
response without request or metadata has null there. A null capture id is kept as null and
is never the least while another is there. Archives that end inside a record raise an error.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm.ship import ship
from regloom.session import scratch_path

#: Captures in a file, zlib's level, and bytes given to it at once in reading.
MOST_CAPTURES, LEVEL, FEED = 20_000, 4, 4096


def member(data: bytes) -> bytes:
    """One gzip member; the same bytes every time."""
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


#: An empty gzip member, which adds nothing to what is read.
SEPARATOR = member(b"").decode("latin-1")


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def record(kind: str, identity: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {identity}", "WARC-Date: 2024-01-01T00:00:00Z"]
    lines += [f"{k}: {v}" for k, v in headers] + [f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str | None) -> str:
    """A header value: what would end its line is percent-encoded."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def capture_records(identity: int | None, url: str | None, payload: bytes, first: int | None, is_first: bool) -> bytes:
    """The members of one capture."""
    digest, target = payload_digest(payload), _field(url)
    original = record_id("response", digest, len(payload), first)
    main = original if is_first else record_id("revisit", digest, identity, target)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if not is_first:
        headers += [("WARC-Refers-To", original), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    host, _, path = target.partition("://")[2].partition("/")
    request = f"GET /{path.partition('#')[0]} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    fields = b"" if identity is None else f"capture-id: {identity}\r\n".encode()
    link = [("WARC-Target-URI", target), ("WARC-Concurrent-To", main)]
    return (
        member(record("request", record_id("request", main), [*link, ("Content-Type", "application/http;msgtype=request")], request))
        + member(record("response" if is_first else "revisit", main, headers, head + (payload if is_first else b"")))
        + member(record("metadata", record_id("metadata", main), [*link, ("Content-Type", "application/warc-fields")], fields))
    )


def write_archives(pages: DataFrame, path: str, *, id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> None:
    """Writes three records for every row; of payloads alike, of ``least_bytes`` or more, only the one of least id is stored."""
    spark = pages.sparkSession
    ship(spark)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).cast("bigint").alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    keyed = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    # What repeats, as a table of its own: the join below then has two plain sides, whose hot
    # keys Spark can split.
    firsts = scratch_path(spark, "payloads")
    again = keyed.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    again.where("n > 1").select("digest", "size", "first").write.parquet(firsts)
    repeated = spark.read.parquet(firsts).select(F.col("digest").alias("r_digest"), F.col("size").alias("r_size"), "first")
    joined = keyed.join(repeated, (F.col("digest") == F.col("r_digest")) & (F.col("size") == F.col("r_size")), "left")
    is_first = F.col("r_digest").isNull() | F.col("id").eqNullSafe(F.col("first"))
    judged = joined.select("id", "url", "payload", F.when(F.col("r_digest").isNull(), F.col("id")).otherwise(F.col("first")).alias("first"), is_first.alias("is_first"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                values = [capture_records(*row) for row in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])

    written = judged.mapInArrow(work, "value binary").select(F.col("value").cast("string").alias("value"))
    written.write.options(lineSep=SEPARATOR, encoding="ISO-8859-1", maxRecordsPerFile=MOST_CAPTURES).text(path)


def members(content: bytes) -> Iterator[bytes]:
    """What each gzip member of a file holds; empty ones are left out."""
    view, at = memoryview(content), 0
    while at < len(view):
        press, parts = zlib.decompressobj(31), []
        # Fed bit by bit, so that what is left over of a step stays small.
        while not press.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            step = view[at : at + FEED]
            parts.append(press.decompress(step))
            at += len(step)
        at -= len(press.unused_data)
        data = b"".join(parts)
        if data:
            yield data


def parse_record(data: bytes) -> dict:
    head, parted, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/") or not parted:
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError("the archive ends inside a record")
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": fields.get("warc-type"),
        "target_uri": fields.get("warc-target-uri") or None,
        "date": fields.get("warc-date"),
        "concurrent_to": fields.get("warc-concurrent-to"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "http_head": block[: len(block) - len(payload)].decode("utf-8", "replace") if payload is not block else None,
        "payload": payload,
    }


RECORD = "record_id string, record_type string, target_uri string, date string, concurrent_to string, refers_to string, payload_digest string, http_head string, payload binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for every record of the archives under a path."""
    ship(spark)
    schema = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.string()) for c in RECORD.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for data in members(content.as_buffer()):
                    rows.append(parse_record(data))
                    size += len(data)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(work, RECORD)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit: the record, ``request`` and ``metadata`` as structs, ``original``.

    ``original`` is what a revisit refers to: its ``capture_id`` and ``payload_bytes``.
    """
    spark = records.sparkSession
    path = scratch_path(spark, "records")
    records.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    companion = F.struct("record_id", "target_uri", "date", "http_head", "payload")
    beside = (
        stored.where(F.col("record_type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
        .groupBy(F.col("concurrent_to").alias("to"))
        .agg(F.min(F.when(F.col("record_type") == "request", companion)).alias("request"), F.min(F.when(F.col("record_type") == "metadata", companion)).alias("metadata"))
    )
    capture_id = F.regexp_extract(F.col("metadata.payload").cast("string"), r"(?m)^capture-id: (-?\d+)\r?$", 1)
    main = stored.where(F.col("record_type").isin("response", "revisit"))
    captures = main.join(beside, main["record_id"] == beside["to"], "left").withColumn("capture_id", F.when(capture_id != "", capture_id.cast("bigint")))
    # What revisits refer to: identifiers and sizes only, each once, as a table of its own.
    target = scratch_path(spark, "responses")
    captures.where("record_type = 'response'").groupBy("record_id").agg(F.min("capture_id").alias("capture_id"), F.min("payload_bytes").alias("payload_bytes")).write.parquet(target)
    responses = spark.read.parquet(target).select(F.col("record_id").alias("original_id"), F.struct("capture_id", "payload_bytes").alias("original"))
    # Who refers to nothing is dealt by its own identifier, not to one null key.
    refers = F.coalesce(captures["refers_to"], captures["record_id"]) == responses["original_id"]
    joined = captures.join(responses, refers & captures["refers_to"].isNotNull(), "left")
    return joined.select("capture_id", *stored.columns, "request", "metadata", "original")
