"""WARC files: one gzip member per record, written and read in sequence (operator 3)."""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import ready, store, written

# Fixed values of the format.
WARC_VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
CRLF = b"\r\n"

NAMESPACE = uuid.UUID("5f0c7d0e-6a51-5d0b-9d0f-3f2f6a1f7c11")
DATE = "1970-01-01T00:00:00Z"
CHUNK = 1 << 16
MANIFEST = "path string, records bigint, bytes bigint"
MANIFEST_KIND = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORD = (
    "page_id bigint, url string, record_type string, record_id string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """One for each page, address and payload, so that a revisit knows the id of the record it refers to."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, repr((page_id, url, digest)))}>"


def one_line(value: str) -> str:
    """A header's value may not break its line; control letters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, refers_url: str | None = None, date: str = DATE
) -> bytes:
    """One record as one gzip member. A revisit keeps the HTTP header of its payload but not the payload."""
    revisit = refers_to is not None
    digest = base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        WARC_VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, url, digest)}",
        f"WARC-Date: {date}",
        f"Content-Type: {HTTP_TYPE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {one_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, refers_url, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return packer.compress("\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF) + packer.flush()


class Members:
    """The records of a file in sequence: each gzip member is inflated piece by piece and framed by its content length."""

    def __init__(self, file):
        self.file, self.rest = file, b""

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while self.rest or self._more():
            yield self._record()

    def _more(self) -> bool:
        self.rest += (read := self.file.read(CHUNK))
        return bool(read)

    def _pieces(self) -> Iterator[bytes]:
        """The inflated bytes of one member; what follows it stays in ``rest``."""
        inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
        while not inflate.eof:
            if not self.rest and not self._more():
                raise ValueError("the file ends inside a record")
            data, self.rest = self.rest, b""
            yield inflate.decompress(data)
            self.rest = inflate.unused_data

    def _record(self) -> tuple[dict[str, str], bytes]:
        held = bytearray()
        pieces = self._pieces()
        end = -1
        for piece in pieces:
            held += piece
            end = held.find(b"\r\n\r\n")
            if end >= 0:
                break
        if end < 0:
            raise ValueError("a record without the end of its header")
        header = headers(bytes(held[:end]), WARC_VERSION[:5])
        length = int(header["content-length"])
        block = io.BytesIO()
        block.write(held[end + 4 :])
        for piece in pieces:
            block.write(piece)
        whole = block.getvalue()
        if len(whole) != length + 4 or whole[length:] != CRLF + CRLF:
            raise ValueError(f"a record of {len(whole) - 4} bytes states {length}")
        return header, whole[:length]


def headers(data: bytes, first: str) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with white space goes on the one before."""
    lines = data.decode("utf-8").split("\r\n")
    if not lines[0].startswith(first):
        raise ValueError(f"a header that begins with {lines[0][:20]!r}")
    found: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            found[last] = value.strip()
    return found


def parsed(header: dict[str, str], block: bytes) -> dict:
    """A record's row, after its digests were verified. A revisit's length and digest are those of the payload it leaves out."""
    if header.get("warc-block-digest", "") != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"the block of {header.get('warc-record-id')} does not have its digest")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = headers(head, "HTTP/")
    kind = header["warc-type"]
    size, digest = int(http["content-length"]), header["warc-payload-digest"].removeprefix("sha1:")
    if kind != "revisit" and (size != len(payload) or digest != base32_sha1(payload)):
        raise ValueError(f"the payload of {header.get('warc-record-id')} does not have its digest")
    number = lambda name: int(header[name]) if name in header else None
    return {
        "page_id": number("x-page-id"),
        "url": header.get("warc-target-uri"),
        "record_type": kind,
        "record_id": header["warc-record-id"],
        "refers_to": number("x-refers-to-page-id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if kind == "revisit" else payload.decode("utf-8"),
    }


def plan_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Pages as ``page_id, url, html, refers_to, refers_url``: of equal payloads of at least ``least_bytes`` bytes all but
    the one with the largest page_id refer to it.

    A null html is an empty payload. Payloads of any length are compared whole, by SHA-256. Only digests that occur more than once are
    joined back, and a digest with very many pages is split by the adaptive join, since its other side has one row. Rows
    that share the largest page_id are responses all, and what refers to it means the one with the largest url; so are rows of a group
    without any id. Extra columns are not read.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("sha", F.sha2("html", 256))
    groups = rows.where(F.octet_length("html") >= least_bytes).groupBy("sha")
    groups = groups.agg(F.max(F.struct("page_id", "url")).alias("newest"), F.count("*").alias("n")).where("n > 1 and newest.page_id is not null")
    found = rows.join(groups.select("sha", "newest"), "sha", "left")
    older = F.col("newest").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("newest.page_id")))
    target = F.when(older, F.col("newest"))
    return found.select("page_id", "url", "html", target["page_id"].alias("refers_to"), target["url"].alias("refers_url"))


def write_warc(planned: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Writes one file per task and returns their manifest (``path``, ``records``, ``bytes``).

    A file has the name of its attempt and enters the manifest, a table of its own, when its task has ended, so files of
    lost executors are never read. Records are written one by one, with their whole payloads; no row more than one batch is held.
    Record ids are unique but for rows equal in id, url and payload, which are one record written again. Extra columns are not read.
    """
    ready(planned.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, file, name, records, size = TaskContext.get(), None, "", 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if file is None:
                        system, base = store(folder)
                        system.create_dir(base, recursive=True)
                        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
                        file = system.open_output_stream(f"{base}/{name}", compression=None)
                    data = record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"], row["refers_url"], date)
                    file.write(data)
                    records, size = records + 1, size + len(data)
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": records, "bytes": size}], schema=MANIFEST_KIND)

    return written(planned.select("page_id", "url", "html", "refers_to", "refers_url").mapInArrow(write, MANIFEST), "warc-manifest")


def read_warc(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the files in ``path``, in sequence: ids, type, length, digest and, with ``payloads``, the text.

    Every digest is verified and every record framed by its stated length; a file that breaks either rule fails the job, with
    the record's name. A revisit has no payload of its own (null). No files give no rows.
    """
    ready(manifest.sparkSession)
    names = [c.strip().split(" ")[0] for c in RECORD.split(",")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    kind = pa.schema([(c.strip().split(" ")[0], kinds[c.strip().split(" ")[1]]) for c in RECORD.split(",")])
    if not payloads:
        kind, names = kind.remove(len(names) - 1), names[:-1]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, base = store(path)
                with system.open_input_stream(base, compression=None) as file:
                    out = []
                    for header, block in Members(file):
                        out.append(parsed(header, block))
                        if len(out) == 256:
                            yield pa.RecordBatch.from_pylist(out, schema=kind)
                            out = []
                    yield pa.RecordBatch.from_pylist(out, schema=kind)

    spread = manifest.select("path").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInArrow(read, ", ".join(c.strip() for c in RECORD.split(",")[: len(names)]))
