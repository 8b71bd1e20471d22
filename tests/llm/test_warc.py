import base64
import gzip
import hashlib

import pytest

from arcweave.llm import warc
from arcweave.llm.queries import op6_warc

SF = "/root/testdata/sf0.001"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows):
    first = {}
    for key, _, payload in rows:
        data = payload or b""
        first[data] = min(first.get(data, key), key)
    return sorted(
        (key, len(payload or b""), b32(payload or b""), "response" if first[payload or b""] == key else "revisit",
         None if first[payload or b""] == key else first[payload or b""])
        for key, _, payload in rows
    )


def test_query_matches_brute_force(spark):
    rows = [(r.page_id, r.url, (r.html or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = sorted(tuple(r) for r in op6_warc(spark, SF).collect())
    assert got == expected(rows)


@pytest.mark.parametrize("segment_bytes", [7, 90, 1 << 20])
def test_round_trip_of_odd_payloads(spark, scratch, segment_bytes):
    rows = [
        (1, "http://a/ü x\r\nWARC-Type: fake", "é😀\r\n\r\nWARC/1.1\r\n".encode() * 5), (2, None, None), (3, "u", b""), (4, "u", b"\r\n0\r\n\r\n"),
        (5, "u", bytes(range(256)) * 3), (6, "u", b"x"), (7, "u", b"x"), (-8, "u", b"x"), (9, "u", bytes(range(255, -1, -1)) * 300),
    ]
    data = spark.createDataFrame([(*r, "mine", 1) for r in rows], "key long, url string, payload binary, payload_digest string, record_type int")
    path = scratch.folder("w")
    warc.archive(data, scratch, path, segment_bytes=segment_bytes)
    records = warc.read_records(spark, path)
    found = scratch.save(warc.payloads(warc.reassemble(records)), "found")
    stored = {r.key: bytes(r.payload) for r in found.where("record_type = 'response'").collect()}
    got = sorted((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.resolve_revisits(found).collect())
    assert got == expected(rows)
    assert all(stored[key] == (payload or b"") for key, _, payload in rows if key in stored)
    if segment_bytes == 7:
        assert records.where("record_type = 'continuation'").count() > 100
        broken = records.where("segment is null or segment <> 2")
        with pytest.raises(Exception, match="segments of"):
            warc.payloads(warc.reassemble(broken)).collect()


@pytest.mark.parametrize("segment_bytes", [90, 1 << 20])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_repeated_rows_and_keys_keep_their_records(spark, scratch, segment_bytes, kind):
    a, b, c, d = (bytes([x]) * 400 for x in range(4))
    rows = [(1, "u", a), (1, "u", a), (1, "u", b), (2, "u", a), (2, "u", a), (None, "u", c), (None, "u", d), (None, "u", d), (None, "u", a), (5, "u", None), (5, "v", None)]
    if kind == "string":
        rows = [(None if k is None else f"{k}:null >!é", *rest) for k, *rest in rows]
    data = spark.createDataFrame(rows, f"key {kind}, url string, payload binary")
    path = scratch.folder("w")
    warc.archive(data, scratch, path, segment_bytes=segment_bytes)
    records = warc.read_records(spark, path)
    names = [r.record_id for r in records.select("record_id").collect()]
    assert len(names) == len(set(names))
    assert (records.where("record_type = 'continuation'").count() > 0) == (segment_bytes == 90)
    found = warc.payloads(warc.reassemble(records), key_type=kind)
    first = {}
    for key, _, payload in rows:
        known = [k for k in (first.get(payload), key) if k is not None]
        first[payload] = min(known) if known else None
    wanted = [
        (key, len(payload or b""), b32(payload or b""), "response" if first[payload] == key else "revisit", None if first[payload] == key else first[payload])
        for key, _, payload in rows
    ]
    got = warc.resolve_revisits(found).select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert sorted(bytes(r.payload) for r in found.where("record_type = 'response'").collect()) == sorted(p or b"" for k, _, p in rows if first[p] == k)


def test_archives_are_read_piece_by_piece(monkeypatch):
    monkeypatch.setattr(warc, "INFLATED_AT_ONCE", 7)
    blocks = [b"x" * n for n in (0, 1, 50, 1000)] + [b"\r\n\r\nWARC/1.1\r\n\r\n"]
    plain = b"".join(warc._record([("WARC-Type", "resource"), ("WARC-Record-ID", f"<{i}>")], block) + b"\r\n\r\n" for i, block in enumerate(blocks))
    half = len(plain) // 2
    packed = gzip.compress(plain[:half]) + gzip.compress(plain[half:])
    for content in (plain, packed):
        pieces = list(warc._inflated(content))
        assert b"".join(pieces) == plain and (content is plain or max(map(len, pieces)) <= 7)
        assert [r[-1] for r in warc._parsed(iter(pieces))] == blocks
    for content in (plain[:-1], plain[:half], packed[:-9]):
        with pytest.raises(ValueError):
            list(warc._parsed(warc._inflated(content)))
    assert list(warc._parsed(warc._inflated(b""))) == []


def test_pages_of_the_tables_are_segmented(spark, scratch):
    pages = spark.read.parquet(f"{SF}/pages.parquet").selectExpr("page_id AS key", "url", "encode(html, 'UTF-8') AS payload")
    path = scratch.folder("w")
    warc.archive(pages, scratch, path)
    assert warc.read_records(spark, path).where("segment = 1").count() > 0


def test_empty_table(spark, scratch):
    path = scratch.folder("w")
    warc.archive(spark.createDataFrame([], "key long, url string, payload binary"), scratch, path)
    assert warc.payloads(warc.reassemble(warc.read_records(spark, path))).count() == 0


def test_chunk_framing():
    assert warc.unchunked(b"3;x=y\r\nabc\r\n2\r\nde\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcde"
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")
