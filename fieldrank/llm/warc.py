"""WARC archives: writing, reading and revisit resolution.

Archives are gzipped; WARC 1.0 and 1.1 are read, 1.1 is written. They are written by
Spark's text writer with the record separator as line separator and read by its text
reader with the start of the version line as separator, so both work on every file
system Spark knows and one record at a time, however large a file is. A version line
inside a payload only cuts a record in pieces; the parser joins them by Content-Length.

Resolution: headers are shuffled by payload digest, without payloads. Of records
with equal payloads of at least ``MIN_BYTES`` the one with the largest page id
stays a response (of equal ids the one that stands last in the archives), and the
others become revisits that refer to it. Revisits that the archives already hold refer
to the response of their digest too, of any size. These records get fresh headers and
keep their own HTTP headers; records of other types and revisits whose response is in
none of the archives are written as they were read.

Nulls: a null payload is empty, a null id, address or date has no header line and
reads back as null. Repeated rows are records of their own, with ids of their own. An
empty table gives an empty archive. Line breaks in an address are percent-encoded. Page
ids may have any type that a text can be cast to. Only the named columns are used;
others may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.llm.common import join_measured, picked
from fieldrank.materialise import materialise, scratch_folder

MIN_BYTES = 1000

# Fixed values of the format.
_MARK = "WARC/1."
_VERSION = f"{_MARK}1\r\n"
_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Header lines besides those of the standard.
_PAGE, _BYTES, _REFERS = "X-Page-Id", "X-Payload-Length", "X-Refers-To-Page-Id"

DATE = "2024-01-01T00:00:00Z"


def _line(name: str, value: Column) -> Column:
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def record_id(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]), F.lit(">")
    )


def _id_line(name: str, value: Column) -> Column:
    # Encoded, as an id may be any text.
    return _line(name, F.url_encode(value.cast("string")))


def _record(kind: Column, headers: list[Column], http: Column, body: Column) -> Column:
    block = F.concat(http, body)
    return F.concat(
        F.lit(_VERSION), _line("WARC-Type", kind), *headers,
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block)), F.lit("\r\n"), block,
    )


def _write(records: DataFrame, record: Column, path: str) -> None:
    records.select(record.alias("value")).write.option("lineSep", _END).option(
        "compression", "gzip"
    ).text(path)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", date: str = DATE) -> None:
    """A response record per page."""
    rows = picked(pages, page_id=page_id, url=url, html=html)
    body = F.coalesce(F.col("html"), F.lit(""))
    headers = [
        _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"), F.col("_digest"), F.col("_row"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        _id_line(_PAGE, F.col("page_id")),
        _line(_BYTES, F.octet_length(body)),
    ]
    numbered = rows.withColumns({
        "_digest": F.sha1(body.cast("binary")), "_row": F.monotonically_increasing_id(),
    })
    _write(numbered, _record(F.lit("response"), headers, F.lit(_HTTP), body), path)


class Parser:
    """Puts together the records of archives from pieces between version marks."""

    def __init__(self):
        self.archive, self.number = None, 0
        self._next()

    def _next(self) -> None:
        self.pieces, self.size, self.headers, self.ends = [], 0, None, (0, 0)

    def feed(self, archive: str, piece: bytes) -> Iterator[tuple[str, int, dict, bytes, bytes]]:
        """Archive, number, headers (names in lower case), their text and the block of
        each record that ``piece`` completes."""
        if archive != self.archive:
            self.close()
            # What stands before the first version line is nothing.
            self.archive, self.number = archive, 0
            if piece:
                raise ValueError(f"{archive} does not start with a record")
            return
        self.pieces.append(_MARK.encode() + piece)
        self.size += len(self.pieces[-1])
        if self.headers is None:
            self._open()
        head, end = self.ends
        if self.headers is None or self.size < end:
            return
        data = b"".join(self.pieces)
        if data[end - len(_END):] != _END.encode():
            raise ValueError(f"record {self.number} of {archive} is longer than it says")
        yield archive, self.number, self.headers, data[:head], data[head:end - len(_END)]
        self.number += 1
        self._next()

    def _open(self) -> None:
        # Only until the headers are whole, so pieces of a block are joined once.
        data = b"".join(self.pieces)
        self.pieces = [data]
        at = data.find(_END.encode())
        if at < 0:
            return
        self.headers = _headers(data[:at])
        length = self.headers.get("content-length", "")
        if not length.isdecimal():
            raise ValueError(f"record {self.number} of {self.archive} has no length")
        head = at + len(_END)
        self.ends = head, head + int(length) + len(_END)

    def close(self) -> None:
        if self.pieces:
            raise ValueError(f"{self.archive} ends inside record {self.number}")


def _headers(head: bytes) -> dict[str, str]:
    found, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        found[last] = value.strip()
    return found


_READ = (
    "archive string, number long, record_type string, record_id string, url string, date string, "
    "page_id string, payload_bytes long, payload_digest string, refers_to string, head binary, "
    "http binary, payload binary"
)


def _hex_digest(value: str | None) -> str | None:
    """The SHA-1 of a digest header in lower-case hexadecimal; of other kinds null."""
    kind, _, digest = (value or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(digest.upper()).hex() if len(digest) == 32 else digest.lower()


def _row(archive: str, number: int, headers: dict, head: bytes, block: bytes, keep: bool) -> tuple:
    kind = headers.get("warc-type")
    digest = _hex_digest(headers.get("warc-payload-digest"))
    http, payload, length = None, block, headers.get(_BYTES.lower())
    if headers.get("content-type", "").startswith("application/http"):
        top, end, payload = block.partition(_END.encode())
        http = top + end
    if kind == "response":
        found = hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError(f"record {number} of {archive} does not match its digest")
        digest, length = found, len(payload)

    def page(name: str) -> str | None:
        return unquote_plus(headers[name.lower()]) if name.lower() in headers else None

    return (
        archive, number, kind, headers.get("warc-record-id"), headers.get("warc-target-uri"),
        headers.get("warc-date"), page(_PAGE), None if length is None else int(length), digest,
        page(_REFERS), head if keep and kind != "response" else None, http if keep else None,
        payload if keep else None,
    )


def read_archives(
    spark: SparkSession, path: str, payloads: bool = True, page_type: str = "bigint"
) -> DataFrame:
    """The records below ``path``; digests of responses are checked.

    ``payload`` is what follows the HTTP headers (``http``), or the whole block of a record
    without any; ``head`` are the WARC headers of records that are no responses. These
    three are null without ``payloads``. Page ids are read as ``page_type``; archives of
    others have none.
    """
    pieces = (
        spark.read.option("lineSep", _MARK).text(path)
        .select(F.col("_metadata.file_name").alias("archive"), F.col("value").cast("binary"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.string(),
                 pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            rows = [
                _row(*record, payloads)
                for piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for record in parser.feed(*piece)
            ]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        parser.close()

    names = [part.split()[0] for part in _READ.split(", ")]
    return pieces.mapInArrow(run, _READ).withColumns({
        name: F.col(name).cast(page_type) for name in ("page_id", "refers_to")
    })


def revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The records (``archive``, ``number``) that repeat a payload, and what they refer to."""
    response, revisit = F.col("record_type") == "response", F.col("record_type") == "revisit"
    held = headers.where(F.col("payload_digest").isNotNull()).where(
        (response & (F.col("payload_bytes") >= min_bytes)) | revisit
    )
    # Revisits of the archives may refer to smaller payloads than are looked at here.
    named = materialise(headers.where(revisit).select("payload_digest").distinct())
    small = headers.where(response & (F.col("payload_bytes") < min_bytes))
    asked = held.unionByName(join_measured(small, named, ["payload_digest"], "left_semi")) if named.rows else held
    spot = F.struct("page_id", "archive", "number", "record_id", "url", "date", "payload_bytes")
    originals = materialise(
        asked.groupBy("payload_digest")
        .agg(F.max(F.when(response, spot)).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL").select("payload_digest", "first.*")
        .withColumnsRenamed({
            "archive": "_archive", "number": "_number", "page_id": "refers_to",
            "record_id": "refers_to_record", "url": "refers_to_url", "date": "refers_to_date",
            "payload_bytes": "refers_to_bytes",
        })
    )
    copies = join_measured(
        held.select("archive", "number", "payload_digest"), originals, ["payload_digest"], "inner",
    )
    return copies.where(
        (F.col("archive") != F.col("_archive")) | (F.col("number") != F.col("_number"))
    ).select("archive", "number", "refers_to", "refers_to_record", "refers_to_url", "refers_to_date",
             "refers_to_bytes", F.lit(True).alias("is_revisit"))


def resolve(spark: SparkSession, path: str, out: str, min_bytes: int = MIN_BYTES,
            date: str | None = None, page_type: str = "bigint") -> None:
    """Write the archives of ``path`` deduplicated, with fresh headers, to ``out``.

    Records keep their dates unless ``date`` is given.
    """
    headers = materialise(
        read_archives(spark, path, False, page_type).drop("head", "http", "payload")
    ).df
    repeated = materialise(revisits(headers, min_bytes))
    rows = read_archives(spark, path, page_type=page_type).drop("refers_to")
    rows = join_measured(rows, repeated, ["archive", "number"], "left")
    again = F.coalesce(F.col("is_revisit"), F.lit(False))
    headers = [
        _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.col("date") if date is None else F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(again, F.lit(_PROFILE))),
        _line("WARC-Refers-To", F.col("refers_to_record")),
        _line("WARC-Refers-To-Target-URI", F.col("refers_to_url")),
        _line("WARC-Refers-To-Date", F.col("refers_to_date")),
        _id_line(_REFERS, F.col("refers_to")),
        _id_line(_PAGE, F.col("page_id")),
        _line(_BYTES, F.coalesce("refers_to_bytes", "payload_bytes")),
    ]
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    http = F.coalesce(F.col("http").cast("string"), F.lit(_HTTP))
    payload = F.col("payload").cast("string")
    fresh = _record(kind, headers, http, F.when(again, F.lit("")).otherwise(payload))
    as_read = F.concat(
        F.col("head").cast("string"), F.coalesce(F.col("http").cast("string"), F.lit("")), payload
    )
    settled = (F.col("record_type") == "response") | again
    _write(rows, F.when(settled, fresh).otherwise(as_read), out)


def resolved_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write pages to archives, resolve revisits, and read the records back."""
    spark = pages.sparkSession
    kind = pages.schema[page_id].dataType.simpleString()
    raw, out = scratch_folder(spark), scratch_folder(spark)
    write_archives(pages, raw, page_id, url, html)
    resolve(spark, raw, out, min_bytes, page_type=kind)
    return read_archives(spark, out, payloads=False, page_type=kind).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
