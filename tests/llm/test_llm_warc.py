import base64
import gzip
import hashlib
import time
from pathlib import Path

import pytest

from fieldrank.llm import warc

PAGE = "page_id long, url string, html string"


def brute(pages):
    best = {}
    for page_id, _, text in pages:
        data = (text or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, (page_id is not None, page_id or 0)), (page_id is not None, page_id or 0))
    out = []
    for page_id, _, text in pages:
        data = (text or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        own = (page_id is not None, page_id or 0)
        if data in best and best[data] != own:
            out.append((page_id, len(data), digest, "revisit", best[data][1]))
        else:
            out.append((page_id, len(data), digest, "response", None))
    return sorted(out, key=str)


ODD = [
    (1, "http://a/1", "x" * 1000), (7, "http://a/7", "x" * 1000), (3, None, "x" * 1000),
    (2, "http://a/2", "x" * 999), (4, "http://a/4", "x" * 999),
    (5, "http://a/5\r\nX-Evil: 1", "tricky WARC/1.1\r\nWARC/1.1\r\n\r\n\r\nContent-Length: 3\r\n\r\n" * 40),
    (6, "http://b", "tricky WARC/1.1\r\nWARC/1.1\r\n\r\n\r\nContent-Length: 3\r\n\r\n" * 40),
    (8, "http://c", None), (9, "http://d", ""), (None, "http://e", "ü" * 600), (10, "http://f", "ü" * 600),
    (11, "http://g", "\r\n\r\n"), (12, "http://h", "z" * 500_000), (13, "http://i", "WARC/1.1\r\n"),
]


def test_odd_pages(spark, clashing):
    pages = spark.createDataFrame(ODD, PAGE)
    for df in (pages, clashing(pages).repartition(3)):
        assert sorted(map(tuple, warc.resolved_pages(df).collect()), key=str) == brute(ODD)


def test_one_of_repeated_rows_is_the_response(spark):
    pages = spark.createDataFrame([(4, "u", "y" * 2000)] * 5, PAGE)
    rows = warc.resolved_pages(pages).collect()
    assert sorted((r.record_type, r.refers_to) for r in rows) == [
        ("response", None), *[("revisit", 4)] * 4
    ]


def test_empty_table(spark):
    assert warc.resolved_pages(spark.createDataFrame([], PAGE)).collect() == []


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ODD, PAGE)
    warc.write_archives(pages.coalesce(1), str(tmp_path / "a"))
    rows = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    for page_id, url, text in ODD:
        assert bytes(rows[page_id].payload) == (text or "").encode()
        assert rows[page_id].url == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
    assert len({r.record_id for r in rows.values()}) == len(ODD)
    files = sorted(Path(tmp_path / "a").glob("*.gz"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n")


def test_revisits_have_no_payload_and_fresh_headers(spark, tmp_path):
    raw, out = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_archives(spark.createDataFrame(ODD, PAGE), raw)
    warc.resolve(spark, raw, out, date="2025-05-05T00:00:00Z")
    rows = {r.page_id: r for r in warc.read_archives(spark, out).collect()}
    assert {r.date for r in rows.values()} == {"2025-05-05T00:00:00Z"}
    assert bytes(rows[1].payload) == b"" and bytes(rows[7].payload) == b"x" * 1000
    text = "".join(gzip.decompress(f.read_bytes()).decode() for f in Path(out).glob("*.gz"))
    assert text.count("WARC-Profile: http") == 4
    assert f"WARC-Refers-To: {rows[7].record_id}" in text


def test_damaged_archives_are_refused():
    parser = warc.Parser()
    list(parser.feed("a", b""))
    list(parser.feed("a", b"WARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"))
    with pytest.raises(ValueError):
        parser.close()


def foreign(kind, block, *lines, version="1.0", end="\r\n\r\n"):
    head = "\r\n".join([f"WARC/{version}", f"warc-type: {kind}", *lines, f"content-length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + end.encode()


def test_archives_of_others(spark, tmp_path):
    """WARC 1.0, names in lower case, base32 digests, own HTTP headers, other record types,
    folded headers, one gzip member per record, revisits already there."""
    body = b"\x00\xff binary WARC/1.0\r\n" + b"b" * 1500
    http = b"HTTP/1.1 200 OK\r\nServer: own\r\n\r\n"
    base32 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    tiny = b"tiny"
    tiny_hex = hashlib.sha1(tiny).hexdigest().upper()
    is_http = "Content-Type: application/http; msgtype=response"
    records = [
        foreign("warcinfo", b"software: x\r\nformat: WARC File Format 1.0\r\n", "WARC-Record-ID: <i>"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Record-ID: <q>"),
        foreign("response", http + body, "warc-record-id: <r1>", is_http, f"WARC-Payload-Digest: sha1:{base32}", "WARC-Date:2020-01-01T00:00:00Z"),
        foreign("response", http + body, "WARC-RECORD-ID: <r2>", is_http, "WARC-Target-URI: http://a/\r\n  folded", version="1.1"),
        foreign("response", http + tiny, "WARC-Record-ID: <r3>", is_http, f"WARC-Payload-Digest: SHA1:{tiny_hex}"),
        foreign("revisit", http, "WARC-Record-ID: <v1>", is_http, f"WARC-Payload-Digest: sha1:{tiny_hex}"),
        foreign("revisit", b"", "WARC-Record-ID: <v2>", "WARC-Payload-Digest: sha1:" + "A" * 32),
        foreign("metadata", b"", "WARC-Record-ID: <m>", "WARC-Payload-Digest: md5:00"),
    ]
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (raw / "two.warc").write_bytes(records[0])
    warc.resolve(spark, str(raw), out)
    rows = warc.read_archives(spark, out).collect()
    found = {r.record_id: r for r in rows}
    assert len(rows) == 9 and len(found) == 8
    types = {key: row.record_type for key, row in found.items()}
    assert types == {
        "<i>": "warcinfo", "<q>": "request", "<r1>": "revisit", "<r2>": "response",
        "<r3>": "response", "<v1>": "revisit", "<v2>": "revisit", "<m>": "metadata",
    }
    assert bytes(found["<r2>"].payload) == body and bytes(found["<r1>"].payload) == b""
    assert bytes(found["<r2>"].http) == bytes(found["<r1>"].http) == http
    assert found["<r2>"].url == "http://a/ folded" and found["<r1>"].date == "2020-01-01T00:00:00Z"
    assert found["<r1>"].payload_bytes == len(body) and found["<v1>"].payload_bytes == len(tiny)
    assert bytes(found["<v1>"].head).count(b"WARC-Refers-To: <r3>") == 1
    assert bytes(found["<v2>"].head) + b"\r\n\r\n" == records[6]
    assert bytes(found["<q>"].head) + bytes(found["<q>"].payload) + b"\r\n\r\n" == records[1]
    # Settled archives stay as they are.
    warc.resolve(spark, out, str(tmp_path / "again"))
    again = {r.record_id: r for r in warc.read_archives(spark, str(tmp_path / "again")).collect()}
    for key, row in found.items():
        assert (again[key].record_type, again[key].payload, again[key].payload_digest) == (
            row.record_type, row.payload, row.payload_digest
        )


def test_ids_of_other_types_and_ids_of_repeated_rows(spark, tmp_path):
    texts = [("a b", "u", "x" * 1000), ("10%0D", "u", "x" * 1000), ("9\r\nX: y", "u", "x" * 1000), ("", "u", None), (None, "u", "s")]
    pages = spark.createDataFrame(texts, PAGE.replace("page_id long", "page_id string"))
    rows = {r.page_id: r for r in warc.resolved_pages(pages).collect()}
    assert {key: row.refers_to for key, row in rows.items()} == {
        "a b": None, "10%0D": "a b", "9\r\nX: y": "a b", "": None, None: None
    }
    same = spark.createDataFrame([(4, "u", "y" * 2000)] * 5, PAGE)
    warc.write_archives(same, str(tmp_path / "same"))
    assert len({r.record_id for r in warc.read_archives(spark, str(tmp_path / "same")).collect()}) == 5


def test_payloads_that_quote_the_version_line_are_read_in_linear_time():
    def seconds(times):
        parser, piece = warc.Parser(), b"1\r\n" + b"q" * 200
        block = (b"WARC/1." + piece) * times
        head = f"1\r\nWARC-Type: resource\r\nContent-Length: {len(block)}\r\n\r\n".encode()
        start = time.process_time()
        list(parser.feed("a", b""))
        pieces = [head, *[piece] * (times - 1), piece + b"\r\n\r\n"]
        records = [record for part in pieces for record in parser.feed("a", part)]
        parser.close()
        assert [record[4] for record in records] == [block]
        return time.process_time() - start

    seconds(10)
    assert seconds(100_000) < 2
