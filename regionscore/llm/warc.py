"""WARC archives: a gzip member for each record, written from pages and read back in sequence.

The reader takes an archive's bytes in small pieces, decompresses member after member, frames each record by its
Content-Length and checks block and payload digests; it holds one record at a time. Archives are rows of a table
(`archive`, `data`), so that any store Spark can write holds them; archives in files come in by `archive_files`.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.landing import land
from regionscore.llm.common import quoted

#: Payloads below this size are always written whole.
LEAST_SHARED = 1000
#: An archive is closed when it has this many bytes, and read in pieces of so many.
ARCHIVE_BYTES, PIECE_BYTES = 8 << 20, 64 << 10
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAME = "urn:x-page:"


def sha1_name(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes, date: str, level: int = 6) -> bytes:
    """One record as a gzip member of its own."""
    lines = [("WARC-Type", kind), ("WARC-Date", date), *headers, ("WARC-Block-Digest", sha1_name(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, html: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A page as a response, or as a revisit of an equal payload: then the block is the HTTP header alone."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", f"<{_NAME}{'' if page_id is None else page_id}>")]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", sha1_name(payload))]
    if revisit:
        headers += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<{_NAME}{'' if refers_to is None else refers_to}>")]
    return record("revisit" if revisit else "response", headers, http if revisit else http + payload, date)


class Inflated:
    """The decompressed bytes of an archive, member after member, from pieces of its compressed bytes."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.packer, self.held, self.raw = iter(pieces), None, bytearray(), b""

    def more(self) -> bool:
        """Decompress one more piece; False at the end. A member that breaks off is an error."""
        if not self.raw:
            self.raw = next(self.pieces, b"")
            if not self.raw:
                rest = self.packer.decompress(b"", 4 * PIECE_BYTES) if self.packer is not None else b""
                self.held += rest
                if self.packer is not None and not rest and not self.packer.eof:
                    raise ValueError("the archive ends inside a gzip member")
                return bool(rest)
        if self.packer is None:
            self.packer = zlib.decompressobj(31)
        # Bounded output for each step; what is not used yet stays in `raw`.
        self.held += self.packer.decompress(self.raw, 4 * PIECE_BYTES)
        self.raw = self.packer.unconsumed_tail or self.packer.unused_data
        if self.packer.eof:
            self.packer = None
        return True

    def line(self) -> bytes | None:
        """Up to and with the next line end; None at the end of the archive."""
        start = 0
        while (at := self.held.find(b"\r\n", start)) < 0:
            start = max(len(self.held) - 1, 0)
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends inside a line")
                return None
        out = bytes(self.held[:at])
        del self.held[:at + 2]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes in pieces."""
        while n:
            if not self.held and not self.more():
                raise ValueError("the archive ends inside a block")
            piece = bytes(self.held[:n])
            del self.held[:n]
            n -= len(piece)
            yield piece


@dataclass
class Record:
    """A record: its headers by lower-case name, the HTTP header, the payload, and whether all digests hold."""

    headers: dict[str, str]
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    valid: bool = True


def _fields(lines: Iterable[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _matches(named: str | None, sha1: bytes) -> bool:
    """A digest header agrees, in base 32 or 16; one that is absent or of another kind proves nothing."""
    kind, _, value = (named or "").partition(":")
    return kind.lower() != "sha1" or value.upper() == base64.b32encode(sha1).decode() or value.lower() == sha1.hex()


def records(pieces: Iterable[bytes]) -> Iterator[Record]:
    """All records of an archive in sequence."""
    stream = Inflated(pieces)
    while (version := stream.line()) is not None:
        if not version:
            continue  # the line ends after a block
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        lines = []
        while line := stream.line():
            lines.append(line.decode("utf-8", "replace"))
        headers, whole, block = _fields(lines), hashlib.sha1(), bytearray()
        for piece in stream.take(int(headers["content-length"])):
            whole.update(piece)
            block += piece
        out = Record(headers, valid=_matches(headers.get("warc-block-digest"), whole.digest()))
        out.payload = bytes(block)
        if headers.get("content-type", "").startswith("application/http"):
            end = block.find(b"\r\n\r\n")
            if end >= 0:
                out.http = _fields(block[:end].decode("utf-8", "replace").split("\r\n")[1:])
                out.payload = bytes(block[end + 4:])
        if headers.get("warc-type") != "revisit":
            out.valid &= _matches(headers.get("warc-payload-digest"), hashlib.sha1(out.payload).digest())
        yield out


def roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id, url, html, revisit, refers_to`: of equal payloads of at least 1000 bytes all but the largest id revisit that one.

    NULL html counts as empty. Rows without an id are below every other; rows that repeat the largest id repeat the
    response. Only digests are grouped; the few shared ones are joined back, by broadcast only below Spark's limit.
    """
    own = pages.select(F.col(quoted(id_col)).cast("bigint").alias("page_id"), F.col(quoted(url_col)).cast("string").alias("url"),
                       F.coalesce(F.col(quoted(html_col)).cast("string"), F.lit("")).alias("html"))
    own = own.withColumn("digest", F.when(F.octet_length("html") >= LEAST_SHARED, F.sha1(F.col("html").cast("binary"))))
    shared = own.filter("digest is not null").groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    shared = land(shared.filter("n > 1 and first is not null").select("digest", "first"))
    joined = own.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", **columns: str) -> DataFrame:
    """Archives of all pages (see `roles`): `archive`, `data`; each starts with a warcinfo record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head = record("warcinfo", [("WARC-Record-ID", "<urn:x-archive>"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", date)
        part, number, out = TaskContext.get().partitionId(), 0, bytearray()
        for batch in batches:
            for page in range(batch.num_rows):
                out += b"" if out else head
                out += page_record(*[column[page].as_py() for column in (batch.column(0), batch.column(1), batch.column(2), batch.column(4), batch.column(3))], date)
                if len(out) >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([f"pages-{part:05d}-{number:05d}.warc.gz"]), pa.array([bytes(out)], pa.binary())], ["archive", "data"])
                    number, out = number + 1, bytearray()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([f"pages-{part:05d}-{number:05d}.warc.gz"]), pa.array([bytes(out)], pa.binary())], ["archive", "data"])

    return roles(pages, **columns).mapInArrow(run, "archive string, data binary")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """Archives in files (`*.warc.gz` under `path`) as the table that `read` takes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(path)
    return files.select(F.col("path").alias("archive"), F.col("content").alias("data"))


READ = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("valid", T.BooleanType()), T.StructField("payload", T.BinaryType())])


def _page(named: str | None) -> int | None:
    value = (named or "").strip("<>")
    return int(value[len(_NAME):]) if value.startswith(_NAME) and value[len(_NAME):] else None


def _row(archive: str, r: Record, payloads: bool) -> tuple:
    kind = r.headers.get("warc-type")
    if kind == "revisit":  # what the full payload was stands in the headers
        size, named = r.http.get("content-length"), r.headers.get("warc-payload-digest", "")
        digest = base64.b32decode(named.partition(":")[2]).hex() if named.startswith("sha1:") else None
    else:
        size, digest = len(r.payload), hashlib.sha1(r.payload).hexdigest()
    return (archive, kind, _page(r.headers.get("warc-record-id")), r.headers.get("warc-target-uri"), _page(r.headers.get("warc-refers-to")),
            None if size is None else int(size), digest, r.valid, r.payload if payloads else None)


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives: type, page, target, size and bare SHA-1 of the full payload, and `valid`.

    `valid` is false where a digest does not hold. A damaged gzip member or a cut archive is an error. Payloads of
    revisits are empty; `payloads` False leaves the column NULL. NULL data is an archive without records.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                raw = memoryview(data.as_buffer()) if data.is_valid else memoryview(b"")
                rows, held = [], 0
                for r in records(bytes(raw[a:a + PIECE_BYTES]) for a in range(0, len(raw), PIECE_BYTES)):
                    rows.append(_row(name.as_py(), r, payloads))
                    held += len(r.payload)
                    if len(rows) >= 2000 or held >= ARCHIVE_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return archives.select("archive", "data").mapInArrow(run, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], READ.names)
