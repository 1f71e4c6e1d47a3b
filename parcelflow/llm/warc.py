"""WARC archives: one gzip member a record, read back sequentially with incremental decompression."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, maybe_broadcast, small

#: Bytes of payload after which a new archive begins.
ARCHIVE_BYTES = 4 << 20
#: Compressed bytes that the reader takes at a time.
CHUNK = 1 << 16
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace of RFC 4122
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page}')}>"


def record(kind: str, page: object, url: str | None, payload: bytes, first: object = None) -> bytes:
    """One record as a gzip member; a revisit has the HTTP headers only and names the response's page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    url = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(page)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", url),
        ("X-Page-Id", "" if page is None else str(page)), ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        head += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", record_id(first)), ("X-Refers-To-Page-Id", str(first))]
    raw = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + z.flush()


def members(read) -> Iterator[Iterator[bytes]]:  # noqa: ANN001
    """Decompressed chunks of each gzip member of a stream; read(n) gives its next bytes."""
    state = {"rest": read(CHUNK)}

    def chunks() -> Iterator[bytes]:
        z = zlib.decompressobj(31)
        while not z.eof:
            data = state["rest"] or read(CHUNK)
            state["rest"] = b""
            if not data:
                yield z.flush()
                if not z.eof:
                    raise ValueError("the archive ends within a record")
                break
            yield z.decompress(data, CHUNK)
            while z.unconsumed_tail and not z.eof:
                yield z.decompress(z.unconsumed_tail, CHUNK)
        state["rest"] = z.unused_data

    while state["rest"] or (data := read(CHUNK)):
        state["rest"] = state["rest"] or data
        yield chunks()


class _Framed:
    """Lines and counted bytes from an iterator of chunks."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.held = chunks, bytearray()

    def line(self) -> str:
        while (at := self.held.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("a header ends early")
        out = bytes(self.held[:at])
        del self.held[: at + 2]
        return out.decode("utf-8", "surrogatepass")

    def _more(self) -> bool:
        for c in self.chunks:
            if c:
                self.held += c
                return True
        return False

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("a record is shorter than its Content-Length")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def headers(self) -> dict[str, str]:
        out = {}
        while line := self.line():
            name, _, value = line.partition(":")
            out[name.strip().lower()] = value.strip()
        return out


def read_records(read) -> Iterator[tuple[dict[str, str], bytes]]:  # noqa: ANN001
    """(headers, payload) of each record; framing and digests are checked, and a fault raises ValueError."""
    for chunks in members(read):
        f = _Framed(chunks)
        if not f.line().startswith("WARC/"):
            raise ValueError("no WARC version line")
        head = f.headers()
        block = f.take(int(head["content-length"]))
        if f.take(4) != b"\r\n\r\n" or f._more():
            raise ValueError("a record is longer than its Content-Length")
        if (said := head.get("warc-block-digest")) and said != f"sha1:{sha1(block)}":
            raise ValueError(f"block digest of {head.get('warc-record-id')}")
        payload = block.partition(b"\r\n\r\n")[2] if "application/http" in head.get("content-type", "") else block
        if head.get("warc-type") != "revisit" and (said := head.get("warc-payload-digest")) and said != f"sha1:{sha1(payload)}":
            raise ValueError(f"payload digest of {head.get('warc-record-id')}")
        yield head, payload


def plan(pages: DataFrame, least: int = 0) -> DataFrame:
    """(digest, payload_bytes, first) of payloads that several rows share and that have `least` bytes: the smallest page_id.

    Payloads are told apart by SHA-256, since pages with one SHA-1 and two payloads can be made.  Equal payloads are reduced per task before they move, so one payload of a third of all rows is no
    hot key.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            raw = [t.encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary()), pa.array(list(map(len, raw)), pa.int64())], ["page_id", "digest", "payload_bytes"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).mapInArrow(work, f"page_id {id_type}, digest binary, payload_bytes long")
    return rows.where(f"payload_bytes >= {int(least)}").groupBy("digest", "payload_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")


def write_archives(pages: DataFrame, least: int = 0) -> DataFrame:
    """(archive, content): gzip archives of bounded size with a record for each row of `pages`.

    The archives are rows of a table in the shared folder, so no executor needs a local file.  Of rows
    that share a payload and the smallest page_id, every one is a response.
    """
    first = materialize(plan(pages, least), "payloads")
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.unhex(F.sha2(html.cast("binary"), 256)).alias("digest"))
    rows = keyed.join(maybe_broadcast(first, 48), "digest", "left").select("page_id", "url", "html", "first")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex + ".warc.gz"]), pa.array([b"".join(held)], pa.binary())], ["archive", "content"])

        for b in small(batches):
            for page, url, html, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                again = first is not None and page != first
                held.append(record("revisit" if again else "response", page, url, payload, first))
                size += len(payload)
                if size >= ARCHIVE_BYTES:
                    yield out()
                    held.clear()
                    size = 0
        if held:
            yield out()

    return materialize(rows.mapInArrow(work, "archive string, content binary"), "warc")


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id string, payload_digest, payload, record_type, refers_to string) of each record of (archive, content) rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        for b in small(batches):
            for content in b.column(0).to_pylist():
                rows: list[tuple] = []
                for head, payload in read_records(io.BytesIO(content).read):
                    rows.append((head.get("x-page-id"), head.get("warc-payload-digest", "").removeprefix("sha1:"), payload, head["warc-type"], head.get("x-refers-to-page-id")))
                    if len(rows) == 256:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.binary(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["page_id", "payload_digest", "payload", "record_type", "refers_to"])

    return archives.select("content").mapInArrow(work, "page_id string, payload_digest string, payload binary, record_type string, refers_to string")


def read_files(docs_path: str, spark) -> DataFrame:  # noqa: ANN001
    """The records of .warc.gz files that Spark can list."""
    return read_archives(spark.read.format("binaryFile").load(docs_path).select(F.col("path").alias("archive"), "content"))


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): archives written, then read back.

    A revisit's payload is that of the response it names, whose digest must be its own.  Null html is
    an empty payload; a null page_id gives a response of its own unless a smaller page has its payload;
    repeated rows are records of their own.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = read_archives(write_archives(pages, least))
    rows = rows.select("page_id", F.octet_length("payload").cast("long").alias("n"), "payload_digest", "record_type", "refers_to")
    rows = materialize(rows, "records")
    key = ["payload_digest", "refers_to"]
    whole = rows.where("record_type = 'response'").groupBy("payload_digest", F.col("page_id").alias("refers_to")).agg(F.max("n").alias("size"))
    named = materialize(rows.where("record_type = 'revisit'").select(key).distinct().join(whole, key), "revisited")
    out = rows.join(maybe_broadcast(named, 96), key, "left")
    size = F.when(F.col("record_type") == "revisit", F.col("size")).otherwise(F.col("n"))
    page = F.when(F.col("page_id") != "", F.col("page_id"))
    return out.select(page.cast(kind).alias("page_id"), size.alias("payload_bytes"), "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
