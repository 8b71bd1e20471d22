"""WARC archives: writing, deduplication by payload, segment reassembly.

Writing goes through Spark's own text writer, one row for each record and the
blank line that ends a record as line separator, so that a lost executor's
files are written anew under Spark's commit protocol. Records with a payload
seen before become ``revisit`` records. Records whose block is over
``segment_bytes`` are cut: the first record is the response, the rest are
``continuation`` records with the origin's identifier and a segment number; the
last of them states the total length. So no record is over ``segment_bytes`` and
its headers, and an archive of ``RECORDS_PER_FILE`` of them is bounded in bytes.

A record's identifier names its key and its payload's digest, and a number
where rows repeat both, so it is one row's. Reading inflates an archive piece by
piece and holds one record at a time. Records that are whole need no shuffle;
segments are grouped by origin identifier, ordered by number, checked against
the total length, and the chunked transfer framing is decoded.

Defined results: a null payload is an empty one; a null key stays null, keys are
of any type that casts to a string and back; rows repeated with key and payload,
or with a key only, become one record each, of the type their payload has (a
revisit of repeated rows refers to what their identifiers share); a missing or
repeated segment, a wrong length, bad chunking or a wrong digest raises. An empty
table makes archives without records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcweave.scratch import Scratch

RECORDS_PER_FILE = 16_384
SEGMENT_BYTES = 8 << 10
CHUNK_BYTES = 2 << 10
INFLATED_AT_ONCE = 1 << 18
ROWS_AT_ONCE = 256
ID = "urn:page:"
RECORD_FIELDS = (
    "record_type string, record_id string, origin_id string, segment long, total_length long, "
    "refers_to string, digest string, block binary"
)


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def with_digests(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Add payload_digest; stays in place, no shuffle."""

    def digests(batches):
        for batch in _small_batches(batches):
            at = batch.schema.get_field_index(payload)
            found = [digest_of(x.as_py() or b"") for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "payload_digest"])

    fields = ", ".join(f"`{n}` {t}" for n, t in pages.dtypes)
    return pages.mapInArrow(digests, f"{fields}, payload_digest string")


def record_types(pages: DataFrame, scratch: Scratch, least_bytes: int = 0) -> DataFrame:
    """(key, payload_digest, record_type, refers_to) of rows (key, payload_digest, payload_bytes).

    Of the rows with equal payloads of at least ``least_bytes`` the one with
    the smallest key is the response. Only narrow rows move; a payload that a
    third of all pages share is one pre-aggregated row on the joined side, which
    is written first so that adaptive skew handling can split the other side.
    """
    keyed = pages.where(F.col("payload_bytes") >= least_bytes)
    first = scratch.save(keyed.groupBy("payload_digest").agg(F.min("key").alias("first")), "first")
    roles = pages.join(first.hint("merge"), "payload_digest", "left")
    again = (F.col("payload_bytes") >= least_bytes) & ~F.col("key").eqNullSafe(F.col("first"))
    return roles.select(
        "key",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _http(chunked: bool) -> bytes:
    framing = b"Transfer-Encoding: chunked\r\n" if chunked else b""
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + framing + b"\r\n"


def _chunked(payload: bytes) -> bytes:
    parts = [payload[i : i + CHUNK_BYTES] for i in range(0, len(payload), CHUNK_BYTES)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Decode chunked transfer framing, extensions and trailers included."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block


def record_name(key, digest: str, copy: int | None = None) -> str:
    """The identifier of one row's record; ``copy`` tells rows with equal key and digest apart."""
    own = "!" if key is None else quote(str(key), safe="")
    return f"<{ID}{own}:{digest}{'' if copy is None else f':{copy}'}>"


def key_of(name: str | None) -> str | None:
    """The key in a record's identifier."""
    own = name[len(ID) + 1 : -1].split(":")[0] if name else "!"
    return None if own == "!" else unquote(own)


def records_of(key, url, payload, digest, kind, refers_to, copy, date, segment_bytes) -> Iterator[bytes]:
    """The records of one page, in order."""
    name = record_name(key, digest, copy)
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if kind == "revisit":
        head += [
            ("WARC-Refers-To", record_name(refers_to, digest)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("Content-Type", "application/http;msgtype=response"),
        ]
        yield _record(head, _http(False))
        return
    block = _http(True) + _chunked(payload)
    head.append(("Content-Type", "application/http;msgtype=response"))
    if len(block) <= segment_bytes:
        yield _record(head, block)
        return
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record([*head, ("WARC-Segment-Number", 1)], parts[0])
    for number, part in enumerate(parts[1:], 2):
        yield _record(
            [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"{name[:-1]}:segment:{number}>"),
                ("WARC-Date", date),
                ("WARC-Segment-Origin-ID", name),
                ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None),
            ],
            part,
        )


def write_warc(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write rows (key, url, payload, payload_digest, record_type, refers_to, copy) as compressed archives."""
    fields = ["key", "url", "payload", "payload_digest", "record_type", "refers_to", "copy"]

    def records(batches):
        for batch in _small_batches(batches):
            rows = batch.select(fields).to_pylist()
            found = []
            for r in rows:
                found += records_of(
                    r["key"], r["url"], r["payload"] or b"", r["payload_digest"], r["record_type"], r["refers_to"], r["copy"], date, segment_bytes
                )
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])

    (
        pages.mapInArrow(records, "record binary")
        .select(F.col("record").cast("string"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def _inflated(content: bytes) -> Iterator[bytes]:
    """The content piece by piece; gzip members, if it starts as one, are inflated."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        member = zlib.decompressobj(31)
        waiting = b""
        while not member.eof:
            if not waiting:
                if at >= len(view):
                    raise ValueError("an archive is cut short")
                waiting = view[at : at + INFLATED_AT_ONCE]
                at += len(waiting)
            yield member.decompress(waiting, INFLATED_AT_ONCE)
            waiting = member.unconsumed_tail
        at -= len(member.unused_data)


def _parsed(pieces: Iterator[bytes]) -> Iterator[tuple]:
    """The records of an archive; no more than one of them and a piece is held."""
    held, at = b"", 0

    def more() -> bool:
        nonlocal held, at
        piece = next(pieces, None)
        if piece is not None:
            held, at = held[at:] + piece, 0
        return piece is not None

    while at < len(held) or more():
        if at == len(held):
            continue
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                raise ValueError("a record's headers do not end")
        if held[at : at + 5] != b"WARC/":
            raise ValueError("no WARC record where one should start")
        found = dict(re.findall(r"(?m)^([^:\r\n]+):[ \t]*(.*?)\r?$", held[at:end].decode()))
        headers = {name.lower(): value for name, value in found.items()}
        length, start = int(headers["content-length"]), end + 4 - at
        while len(held) - at < start + length + 4:
            if not more():
                raise ValueError("a record is cut short")
        start += at
        if held[start + length : start + length + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        number = lambda name: int(headers[name]) if name in headers else None
        digest = headers.get("warc-payload-digest")
        yield (
            headers["warc-type"],
            headers["warc-record-id"],
            headers.get("warc-segment-origin-id"),
            number("warc-segment-number"),
            number("warc-segment-total-length"),
            headers.get("warc-refers-to"),
            digest.removeprefix("sha1:") if digest else None,
            held[start : start + length],
        )
        at = start + length + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, one row each, as stored."""
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = pa.schema([
        ("record_type", pa.string()), ("record_id", pa.string()), ("origin_id", pa.string()), ("segment", pa.int64()),
        ("total_length", pa.int64()), ("refers_to", pa.string()), ("digest", pa.string()), ("block", pa.binary()),
    ])

    def records(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in _parsed(_inflated(content.as_py())):
                    rows.append(row)
                    if len(rows) == ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return files.mapInArrow(records, RECORD_FIELDS)


def reassemble(records: DataFrame) -> DataFrame:
    """Responses and revisits with their whole blocks, as a list of parts in order.

    One record's segments form one row, as large as the record itself.
    """
    whole = records.where(F.col("segment").isNull()).select(
        "record_type", "record_id", "refers_to", "digest", F.array("block").alias("parts"), F.lit(None).cast("long").alias("total_length"), F.lit(1).cast("long").alias("last")
    )
    parts = records.where(F.col("segment").isNotNull())
    joined = (
        parts.groupBy(F.coalesce("origin_id", "record_id").alias("record_id"))
        .agg(
            F.min(F.when(F.col("segment") == 1, F.col("record_type"))).alias("record_type"),
            F.min("refers_to").alias("refers_to"),
            F.min("digest").alias("digest"),
            F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
            F.max("total_length").alias("total_length"),
            F.max("segment").alias("last"),
        )
        .select("record_type", "record_id", "refers_to", "digest", F.col("parts.block").alias("parts"), F.coalesce("total_length", F.lit(-1)).alias("total_length"), "last")
    )
    return whole.unionByName(joined)


def _payload(parts: list[bytes], total: int | None, last: int) -> bytes:
    block = b"".join(parts)
    if total is not None and (len(parts) != last or len(block) != total):
        raise ValueError(f"{len(parts)} segments of {len(block)} bytes, {last} of {total} stated")
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head) else body


def payloads(blocks: DataFrame, with_payload: bool = True, key_type: str = "long") -> DataFrame:
    """(key, record_type, refers_to, payload_digest, payload_bytes[, payload]) of reassembled records.

    Revisits have no payload of their own: their payload and its length are null here.
    """

    def decoded(batches):
        for batch in _small_batches(batches):
            rows = []
            for r in batch.to_pylist():
                payload = None
                if r["record_type"] == "response":
                    payload = _payload(r["parts"], r["total_length"], r["last"])
                    if r["digest"] != digest_of(payload):
                        raise ValueError(f"the payload of {r['record_id']} does not have its digest")
                size = None if payload is None else len(payload)
                rows.append((key_of(r["record_id"]), r["record_type"], key_of(r["refers_to"]), r["digest"], size, payload if with_payload else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["key", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    found = blocks.mapInArrow(
        decoded, "key string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
    )
    typed = {name: F.col(name).cast(key_type) for name in ("key", "refers_to")}
    return found.withColumns(typed)


def resolve_revisits(found: DataFrame) -> DataFrame:
    """Give revisits the payload length of the response with their digest."""
    responses = (
        found.where(F.col("record_type") == "response").groupBy("payload_digest").agg(F.max("payload_bytes").alias("_bytes"))
    )
    joined = found.drop("payload").join(responses.hint("merge"), "payload_digest", "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_bytes")


def archive(pages: DataFrame, scratch: Scratch, path: str, least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Deduplicate rows (key, url, payload) and write them as archives below ``path``."""
    digested = with_digests(pages.select("key", "url", "payload"))
    narrow = scratch.save(
        digested.select("key", "payload_digest", F.length(F.coalesce("payload", F.lit(b""))).cast("long").alias("payload_bytes")),
        "digests",
    )
    roles = record_types(narrow, scratch, least_bytes)
    roles = scratch.save(roles.groupBy(*roles.columns).agg(F.count("*").alias("copies")), "roles")
    roles = roles.withColumnsRenamed({"payload_digest": "_digest", "key": "_key"})
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("payload_digest") == F.col("_digest"))
    # Only rows that repeat key and payload need a number; a task writes all of a record's segments.
    copy = F.when(F.col("copies") > 1, F.monotonically_increasing_id()).alias("copy")
    placed = digested.join(roles, same).select("key", "url", "payload", "payload_digest", "record_type", "refers_to", copy)
    write_warc(placed, path, segment_bytes=segment_bytes)
