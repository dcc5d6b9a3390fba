"""WARC derivatives: response records become linked metadata and plain-text conversion records.

For every response record

* a *conversion* record holds the page's plain text.  Its ``WARC-Refers-To`` is the
  response's record id, and target URI and date are the response's;
* a *metadata* record holds ``application/warc-fields``: the HTTP status and headers as
  they came, the response's digests and lengths, and the conversion's record id and
  digest.  Its ``WARC-Refers-To`` is the response's id, its ``WARC-Concurrent-To`` the
  conversion's.

Record ids are name-based UUIDs of the response's id and the record type, so a task
that runs again writes the same record.  Digests are SHA-1 in base 32, recomputed for
responses that state none; a stated one that does not match is kept and marked.

Defined results: a null payload is an empty one; a null URI is left out; a response
without an HTTP header block has status 0 and no headers; payloads of any length are
converted whole; repeated responses give repeated derivatives with the same ids; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tripyard.llm.common import text_steps, to_batch
from tripyard.llm.markup import read_page

VERSION = "WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard's name space for URLs
#: Blocks under these elements are no text of the page's body.
_HEAD = re.compile(r"/head(?:[.#@/]|$)")

Headers = list[tuple[str, str]]


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"


def write_record(headers: Headers, block: bytes) -> bytes:
    """One record, its Content-Length set from the block."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if k.lower() != "content-length"), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(data: bytes) -> Iterator[tuple[Headers, bytes]]:
    """The records of a file (gzip members or plain); a cut-off last record is left out."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        end = data.find(b"\r\n\r\n", at) if at >= 0 else -1
        if end < 0:
            return
        headers: Headers = []
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in (" ", "\t") and headers:  # folded line
                headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.strip())
            else:
                k, _, v = line.partition(":")
                headers.append((k.strip(), v.strip()))
        length = next((int(v) for k, v in headers if k.lower() == "content-length" and v.isdigit()), 0)
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            return
        yield headers, block
        at = end + 4 + length


def value(headers: Headers, name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def http_message(block: bytes) -> tuple[int, Headers, bytes]:
    """(status, headers, payload) of an HTTP response block."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    status = re.match(r"HTTP/\d\S* (\d{3})", lines[0])
    if not mark or status is None:
        return 0, [], block
    return int(status[1]), [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:] if ":" in x)], payload


def plain_text(html: str) -> str:
    """All visible text blocks of a page, one a line."""
    return "\n".join(t for p, t in read_page(html)[0] if not _HEAD.search(p))


def derive(headers: Headers, block: bytes) -> list[tuple[Headers, bytes]]:
    """The conversion and the metadata record of a response record."""
    own = value(headers, "WARC-Record-ID") or record_id(f"{value(headers, 'WARC-Target-URI')} {sha1(block)}")
    status, http, payload = http_message(block)
    charset = re.search(r"charset=([-\w]+)", value(http, "Content-Type") or "", re.IGNORECASE)
    try:
        html = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        html = payload.decode("utf-8", "replace")
    text = plain_text(html).encode()
    carried = [(k, v) for k in ("WARC-Target-URI", "WARC-Date") if (v := value(headers, k)) is not None]
    conversion_id = record_id(f"{own} conversion")
    conversion: Headers = [
        ("WARC-Type", "conversion"), ("WARC-Record-ID", conversion_id), ("WARC-Refers-To", own), *carried,
        ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Block-Digest", sha1(text)),
    ]
    block_digest, payload_digest = sha1(block), sha1(payload)
    fields: Headers = [("http-status", str(status)), *((f"http-header-{k}", v) for k, v in http)]
    for name, real in (("WARC-Block-Digest", block_digest), ("WARC-Payload-Digest", payload_digest)):
        stated = value(headers, name)
        fields.append((f"source-{name}", stated or real))
        if stated and stated != real:
            fields.append((f"source-{name}-mismatch", real))
    fields += [
        ("source-content-length", str(len(block))), ("source-payload-length", str(len(payload))),
        ("conversion-record-id", conversion_id), ("conversion-digest", sha1(text)),
    ]
    body = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    metadata: Headers = [
        ("WARC-Type", "metadata"), ("WARC-Record-ID", record_id(f"{own} metadata")), ("WARC-Refers-To", own),
        ("WARC-Concurrent-To", conversion_id), *carried, ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", sha1(body)),
    ]
    return [(conversion, text), (metadata, body)]


def response_of_page(url: str | None, html: bytes, date: str) -> tuple[Headers, bytes]:
    """A response record for a page that was stored without one."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html) + html
    digest = sha1(block)
    return [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id(f"{url} {digest}")), *([("WARC-Target-URI", url)] if url is not None else []),
        ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"), ("WARC-Block-Digest", digest),
        ("WARC-Payload-Digest", sha1(html)),
    ], block


_SCHEMA_DDL = (
    "record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, "
    "source_block_digest string, source_payload_digest string, block_digest string, n_bytes long, record binary"
)


def derive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Two rows for every page: the derivative's headers as columns and the whole record."""
    schema = pa.schema([
        (key, pa.int64()), *((n, pa.string()) for n in (
            "record_type", "record_id", "refers_to", "concurrent_to", "target_uri", "source_block_digest", "source_payload_digest", "block_digest"
        )), ("n_bytes", pa.int64()), ("record", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_steps(batches, html):
            rows = []
            for k, u, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw, strict=True):
                headers, block = response_of_page(u, body, date)
                for h, b in derive(headers, block):
                    rows.append((
                        k, *(value(h, n) for n in ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Concurrent-To", "WARC-Target-URI")),
                        value(headers, "WARC-Block-Digest"), value(headers, "WARC-Payload-Digest"), value(h, "WARC-Block-Digest"), len(b), write_record(h, b),
                    ))
            yield to_batch(schema, *(list(map(list, zip(*rows, strict=True))) or [[] for _ in schema]))

    return pages.select(pages[key], pages[url], pages[html]).mapInArrow(run, f"{key} long, {_SCHEMA_DDL}")


def derive_files(files: DataFrame) -> DataFrame:
    """Derivatives of the response records in WARC files (rows of the ``binaryFile`` source): (path, record)."""
    schema = pa.schema([("path", pa.string()), ("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                made = [
                    write_record(h, b) for headers, block in read_records(data) if value(headers, "WARC-Type") == "response" for h, b in derive(headers, block)
                ]
                yield to_batch(schema, [path] * len(made), made)

    return files.select("path", "content").mapInArrow(run, "path string, record binary")


def members(records: DataFrame) -> DataFrame:
    """Each record as a gzip member: a WARC file is any concatenation of these."""
    schema = pa.schema([("member", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield to_batch(schema, [gzip.compress(r, mtime=0) for r in batch.column(0).to_pylist()])

    return records.select("record").mapInArrow(run, "member binary")
