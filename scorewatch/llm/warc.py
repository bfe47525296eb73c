"""WARC archives of web pages, written as one gzip stream each and normalised.

`write_archives` packs pages into archives whose records share one gzip stream (of about
ARCHIVE bytes before compression). `normalise` inflates such a stream once, rewrites every
record as a gzip member of its own and returns, beside the new archive, its offset index.
`read_records` goes by the index: it inflates one member at a time and checks the payload
against its digest. Archives are rows (archive, data), so that they lie in tables on any
store that Spark reads, and every executor can reach them.

Of pages with equal payloads of LEAST bytes or more, the one with the smallest id is a
response and the others revisit it, without a payload of their own; smaller payloads are all
responses. Rows that repeat the smallest id are responses too. A null html is an empty
payload. A page without an id is a response unless a page with an id has the same payload. A
null url gives a record without a target. Repeated rows give a record each; other columns
are ignored, whatever their names; an empty table gives no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVE = 8_000_000
LEAST = 100
_END = b"\r\n\r\n"
_PAGE = "urn:x-page:"


def record(page_id: int | None, url: str | None, html: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record around an HTTP response, or around its head alone for a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_to is not None else head + html
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_PAGE}{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        fields.append(f"WARC-Refers-To: <{_PAGE}{refers_to}>")
        fields.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    fields += [
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(fields).encode() + _END + block + _END


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of a record, fields of the HTTP head, payload."""
    head, _, rest = raw.partition(_END)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(_END)
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def records(data: bytes) -> Iterator[bytes]:
    """Records of a gzip stream, inflated once from front to end, whatever its members."""
    buffer, stream = bytearray(), zlib.decompressobj(31)
    at, step = 0, 1 << 16
    while at < len(data) or buffer:
        if at < len(data):
            buffer += stream.decompress(data[at : at + step])
            at += step
            while stream.eof and stream.unused_data:
                rest, stream = stream.unused_data, zlib.decompressobj(31)
                buffer += stream.decompress(rest)
        done = 0
        while (end := buffer.find(_END, done)) >= 0:
            length = next(x for x in bytes(buffer[done:end]).split(b"\r\n") if x.startswith(b"Content-Length: "))
            stop = end + 2 * len(_END) + int(length[16:])
            if stop > len(buffer):
                break
            yield bytes(buffer[done:stop])
            done = stop
        del buffer[:done]
        if at >= len(data) and (buffer or not stream.eof):
            # Without its trailer a stream is not known to be whole, nor its bytes to be right.
            raise ValueError("the archive ends inside a record or its last gzip member")


def normalised(data: bytes) -> tuple[bytes, list[dict]]:
    """The archive with a gzip member for each record, and the offset index."""
    parts, index, at = [], [], 0
    for raw in records(data):
        member = gzip.compress(raw, 6, mtime=0)
        fields = parse(raw)[0]
        entry = {"record_id": fields["WARC-Record-ID"], "type": fields["WARC-Type"], "offset": at, "length": len(member)}
        index.append(entry)
        parts.append(member)
        at += len(member)
    return b"".join(parts), index


def plan(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Pages with size and digest of the payload, and the page that a revisit refers to."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].cast("bigint").alias("id"), pages["url"].alias("url"), html.alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("bigint"), "digest": F.sha2("html", 256)})
    first = rows.where(F.col("size") >= LEAST).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("c"))
    first = first.where("c > 1").select("digest", "first")
    again = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("id", "url", "html", "size", "digest", again.alias("refers_to"))


def write_archives(planned: DataFrame) -> DataFrame:
    """(archive, data): pages as records of archives that are one gzip stream each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, parts, stream = 0, 0, [], zlib.compressobj(6, zlib.DEFLATED, 31)

        def full() -> pa.RecordBatch:
            name = f"part-{TaskContext.get().partitionId():06d}-{number:06d}.warc.gz"
            return pa.RecordBatch.from_pydict({"archive": [name], "data": pa.array([b"".join([*parts, stream.flush()])], pa.binary())})

        for batch in batches:
            for i in range(batch.num_rows):
                number_, url, html, length, digest, refers = (c[i].as_py() for c in batch.columns)
                raw = record(number_, url, html.encode(), length, digest, refers)
                parts.append(stream.compress(raw))
                size += len(raw)
                if size >= ARCHIVE:
                    yield full()
                    number, size, parts, stream = number + 1, 0, [], zlib.compressobj(6, zlib.DEFLATED, 31)
        if size:
            yield full()

    return planned.mapInArrow(run, "archive string, data binary")


_INDEX = pa.list_(
    pa.struct([("record_id", pa.string()), ("type", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
)


def normalise(archives: DataFrame) -> DataFrame:
    """(archive, data, index): every record a member of its own, with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(*batch.columns, strict=True):
                new, index = normalised(data.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()]), pa.array([new], pa.binary()), pa.array([index], _INDEX)],
                    ["archive", "data", "index"],
                )

    kind = "archive string, data binary, index array<struct<record_id: string, type: string, offset: bigint, length: bigint>>"
    return archives.mapInArrow(run, kind)


def _number(urn: str | None) -> int | None:
    digits = urn[1 + len(_PAGE) : -1] if urn else ""
    return int(digits) if digits else None


def read_records(archives: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to), by the index."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, index in zip(batch.column(1), batch.column(2), strict=True):
                view, rows = memoryview(data.as_buffer()), []
                for entry in index.as_py():
                    at = entry["offset"]
                    fields, http, payload = parse(gzip.decompress(view[at : at + entry["length"]]))
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    rows.append(
                        (
                            _number(fields["WARC-Record-ID"]),
                            fields.get("WARC-Target-URI"),
                            int(http["Content-Length"]),
                            digest,
                            fields["WARC-Type"],
                            _number(fields.get("WARC-Refers-To")),
                        )
                    )
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return archives.mapInArrow(
        run,
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    )
