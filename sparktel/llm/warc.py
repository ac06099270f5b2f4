"""WARC archives: writer, monolithic gzip normaliser with sidecar offset index, and indexed reader.

`write_archives` writes pages as WARC/1.1 records, each file one gzip stream.  `normalise` inflates such a stream once,
from its start to its end in bounded memory, writes every record anew as a gzip member of its own, and beside the new
file an index with each member's offset, length and record headers.  `read_records` takes members by the index alone, so
a large file is read by many tasks.  It inflates any member on its own and checks the payload digest.

Files are reached through the file system of the shared folder's scheme.  Only files that a finished task reported in
a written manifest are read, so retried and speculative attempts leave no double records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktel.llm import files
from sparktel.llm.common import fits_broadcast, remove, shuffle_partitions, work_dir, written

PIECE = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = re.compile(r"<urn:x-page:(-?\d+|null)>")
_CLEAN = re.compile(r"[\x00-\x20\x7f<>]")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page: int | None) -> str:
    return f"<urn:x-page:{'null' if page is None else page}>"


def target(url: str | None, page: int | None) -> str:
    """The URL with blanks, controls and angle brackets percent-encoded; the page's own name without one."""
    return _CLEAN.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else page_urn(page)[1:-1]


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str) -> bytes:
    digest = base32_sha1(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not is_revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {page_urn(page)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target(url, page)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        head += [f"WARC-Refers-To: {page_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decide(pages: DataFrame, key: str, body: Column, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """pages with is_revisit and refers_to: of equal payloads the largest key (null the least) is the response.

    Rows that tie on the largest key are all responses.
    """
    payload = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    rows = pages.withColumns({"digest": F.sha1(payload), "bytes": F.octet_length(payload)})
    groups = rows.groupBy("digest", "bytes").agg(F.max(key).alias("best"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = written(pages.sparkSession, groups, "copies")
    if fits_broadcast(groups, 96, broadcast_bytes):
        groups = F.broadcast(groups)
    revisit = F.col("best").isNotNull() & ~F.col(key).eqNullSafe(F.col("best"))
    return rows.join(groups, ["digest", "bytes"], "left").withColumns({"is_revisit": revisit, "refers_to": F.when(revisit, F.col("best"))}).drop("digest", "bytes", "best")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html", date: str = "2024-01-01T00:00:00Z", file_bytes: int = 256 << 20) -> DataFrame:
    """Write a record per row, files of one gzip stream each; the written manifest: path, records."""
    plain = pages.select(pages[key].cast("bigint").alias("page"), pages[url].cast("string").alias("url"), pages[body].cast("string").alias("html"))
    plain = decide(plain, "page", F.col("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = squeeze = path = None
        records = size = 0

        def close() -> pa.RecordBatch:
            out.write(squeeze.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([records], pa.int64())})

        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128).to_pydict()
                for page, link, html, again, old in zip(part["page"], part["url"], part["html"], part["is_revisit"], part["refers_to"], strict=True):
                    if out is None:
                        path = files.join(folder, files.attempt_name("whole", ".warc.gz"))
                        out, squeeze, records, size = files.create(path), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                    raw = record(page, link, (html or "").encode(), old, again, date)
                    out.write(squeeze.compress(raw))
                    records += 1
                    size += len(raw)
                    if size >= file_bytes:
                        yield close()
                        out = None
        if out is not None:
            yield close()

    return written(pages.sparkSession, plain.select("page", "url", "html", "is_revisit", "refers_to").mapInArrow(run, "path string, records bigint"), "warc-manifest")


class Inflated:
    """The inflated bytes of a gzip file, one member or many, read once from its start."""

    def __init__(self, stream):
        self.stream, self.buffer, self.gz = stream, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        raw = self.gz.unconsumed_tail or self.gz.unused_data
        if self.gz.eof:
            raw = self.gz.unused_data or self.stream.read(PIECE)
            if not raw:
                return False
            self.gz = zlib.decompressobj(31)
        elif not raw:
            raw = self.stream.read(PIECE)
            if not raw:
                raise EOFError("the gzip stream is cut off")
        self.buffer += self.gz.decompress(raw, PIECE)
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with mark; b'' at the end of the file."""
        at = 0
        while (i := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer.strip():
                    raise EOFError("the last record is cut off")
                return b""
        out = bytes(self.buffer[: i + len(mark)])
        del self.buffer[: i + len(mark)]
        return out

    def begins(self, mark: bytes) -> bool:
        """Whether mark comes next, or a part of it before the end of the file."""
        while len(self.buffer) < len(mark) and self._more():
            pass
        return self.buffer.startswith(mark[: len(self.buffer)])

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            while not self.buffer:
                if not self._more():
                    raise EOFError("the last record is cut off")
            out = bytes(self.buffer[: min(n, PIECE)])
            del self.buffer[: len(out)]
            n -= len(out)
            yield out

    def skip_blank(self) -> None:
        """Pass the empty lines between records."""
        while True:
            while self.buffer[:1] in (b"\r", b"\n"):
                del self.buffer[:1]
            if self.buffer or not self._more():
                return


def headers(raw: bytes) -> dict[str, str]:
    """Header fields by lower-case name, continuation lines joined; the first line under ''."""
    lines = raw.decode("utf-8", "replace").split("\r\n")
    out, name = {"": lines[0]}, ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out.setdefault(name, value.strip())
    return out


def normalise_file(stream, out, index: Callable[[dict], None]) -> int:
    """Rewrite every record of an inflated-once stream as a gzip member of out; tell each to index; their number."""
    inflated, at, n = Inflated(stream), 0, 0
    while True:
        inflated.skip_blank()
        if not inflated.begins(b"WARC/"):  # a head may have any length, so anything else is refused before its end is sought
            raise ValueError("not a WARC record")
        raw = inflated.until(b"\r\n\r\n")
        if not raw:
            return n
        head = headers(raw)
        if not head[""].startswith("WARC/") or "content-length" not in head:
            raise ValueError("not a WARC record")
        squeeze, start = zlib.compressobj(6, zlib.DEFLATED, 31), at
        body = squeeze.compress(raw)
        out.write(body)
        at += len(body)
        for piece in inflated.pieces(int(head["content-length"])):
            body = squeeze.compress(piece)
            out.write(body)
            at += len(body)
        body = squeeze.compress(b"\r\n\r\n") + squeeze.flush()
        out.write(body)
        at += len(body)
        index({"offset": start, "length": at - start, "type": head.get("warc-type", ""), "id": head.get("warc-record-id", ""), "uri": head.get("warc-target-uri", ""), "date": head.get("warc-date", ""), "digest": head.get("warc-payload-digest", "")})
        n += 1


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """manifest(path) to a written manifest: path, index, records.  The index has a JSON object a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                path = files.join(folder, files.attempt_name("records", ".warc.gz"))
                with files.open_stream(source) as stream, files.create(path) as out, files.create(path + ".idx") as side:
                    n = normalise_file(stream, out, lambda entry, side=side: side.write(json.dumps(entry).encode() + b"\n"))
                yield pa.RecordBatch.from_pydict({"path": [path], "index": [path + ".idx"], "records": pa.array([n], pa.int64())})

    spark = manifest.sparkSession
    rows = manifest.select("path").repartition(shuffle_partitions(spark))
    return written(spark, rows.mapInArrow(run, "path string, index string, records bigint"), "warc-normal")


def entries(manifest: DataFrame) -> DataFrame:
    """Index entries of a normalised manifest: path, offset, length, type, id, uri, date, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["offset", "length", "type", "id", "uri", "date", "digest"]
        for batch in batches:
            for path, side in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with files.open_stream(side) as stream:
                    rows = [json.loads(line) for line in stream.read().splitlines()]
                for lo in range(0, len(rows), 10_000):
                    some = rows[lo : lo + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(some))] + [pa.array([r[c] for r in some], pa.int64() if c in names[:2] else pa.string()) for c in names], ["path", *names])

    return manifest.select("path", "index").repartition(shuffle_partitions(manifest.sparkSession)).mapInArrow(run, "path string, offset bigint, length bigint, type string, id string, uri string, date string, digest string")


def read_member(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record whose gzip member is there."""
    file.seek(offset)
    raw = zlib.decompress(file.read(length), 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = headers(head)
    return fields, rest[: int(fields["content-length"])]


def read_records(found: DataFrame, with_payload: bool = False) -> DataFrame:
    """entries(path, offset, length) to page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload;
    null for revisits).  The payload of a response is checked against its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = name = None
        for batch in batches:
            out: list[tuple] = []
            for path, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if path != name:
                    if file is not None:
                        file.close()
                    file, name = files.open_random(path), path
                head, block = read_member(file, offset, length)
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if (revisit := head["warc-type"] == "revisit") is False and base32_sha1(payload) != digest:
                    raise ValueError(f"{path} at {offset}: the payload isn't the one written")
                page, old = (_PAGE.fullmatch(head.get(h, "")) for h in ("warc-record-id", "warc-refers-to"))
                number = lambda m: int(m[1]) if m and m[1] != "null" else None
                uri = head["warc-target-uri"]
                out.append((number(page), None if uri.startswith("urn:x-page:") else uri, int(headers(http)["content-length"]), digest, head["warc-type"], number(old), None if revisit else payload))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)][: 6 + with_payload], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][: 6 + with_payload])

    rows = found.select("path", "offset", "length").repartition(shuffle_partitions(found.sparkSession)).sortWithinPartitions("path", "offset")
    return rows.mapInArrow(run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Pages to archives, normalised, and read back from them, one row a page.

    A null body is an empty payload; a null url reads back null; a null key is the least of its copies; an empty table
    gives no file and no row; repeated rows are records of their own; no other column is read.
    """
    spark = pages.sparkSession
    whole, normal = work_dir(spark, "warc-whole"), work_dir(spark, "warc")
    manifest = normalise(write_archives(pages, whole, key, url, body), normal)
    remove(spark, whole)
    return read_records(entries(manifest)).withColumnRenamed("page_id", key)


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
b AS (SELECT html, max(page_id) AS best FROM p GROUP BY html),
x AS (SELECT page_id, p.html AS html, best, sha1(p.html) AS h FROM p JOIN b USING (html)),
-- base 32 of 160 bits: eight groups of 20 bits, four letters each
g AS (SELECT page_id, html, best, list_transform(range(0, 8), lambda i: CAST('0x' || substr(h, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)) AS v FROM x)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda q: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(q // 32768 % 32 + 1 AS INTEGER), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(q // 1024 % 32 + 1 AS INTEGER), 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(q // 32 % 32 + 1 AS INTEGER), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(q % 32 + 1 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM g
"""
