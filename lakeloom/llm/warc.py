"""WARC derivatives: response records to linked metadata and conversion records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.html_extract import lines_of
from lakeloom.llm.text import blocks, free

DATE = "1970-01-01T00:00:00Z"
#: Records of a page are named in this space, so that a rerun gives the same identifiers.
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Names of derived records go on from the source record's.
KINDS = ("metadata", "conversion")
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
_LINK = re.compile(r"<a\s[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)

RECORD = ("record_id string, record_type string, target_uri string, date string, refers_to string, content_type string, "
          "block_digest string, payload_digest string, content_length long, record binary")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _clean(value: str) -> str:
    """A header value: no line breaks, so that it cannot start a header of its own."""
    return re.sub(r"[\r\n\0]+", " ", value).strip()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC 1.1 record; records in a row are a WARC file."""
    head = "".join(f"{name}: {_clean(value)}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Header lines in order; a line that begins with white space goes on with the one before."""
    found: list[tuple[str, str]] = []
    for line in re.split(r"\r?\n", head.decode("utf-8", "replace")):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip(), value.strip()))
    return found


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {name.lower(): value for name, value in _fields(head.partition(b"\r\n")[2])}
    size = fields.get("content-length") or "0"
    # a length that is no number leaves the block as it came, but for the end of the record
    return fields, rest[:int(size)] if _DIGITS.fullmatch(size) else rest.removesuffix(b"\r\n\r\n")


_DIGITS = re.compile(r"[0-9]{1,18}")
_HEX = re.compile(rb"[0-9a-fA-F]{1,15}")


def _codings(fields: list[tuple[str, str]], header: str) -> list[str]:
    """Codings of a header in the order they were applied, over all its lines."""
    return [c.strip().lower() for name, value in fields if name.lower() == header for c in value.split(",") if c.strip()]


def _decoded(body: bytes, coding: str) -> bytes:
    """A coding undone; unknown ones leave the bytes as they are."""
    if coding in ("gzip", "x-gzip"):
        return gzip.decompress(body)
    if coding == "deflate":  # with or without a header
        try:
            return zlib.decompress(body)
        except zlib.error:
            return zlib.decompress(body, -zlib.MAX_WBITS)
    return _dechunked(body) if coding == "chunked" else body


def _dechunked(body: bytes) -> bytes:
    """Chunks put together; a size that is no hexadecimal number leaves the body as it came."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        given = body[at:end].partition(b";")[0].strip(b" \t")
        if not _HEX.fullmatch(given):
            return body
        size = int(given, 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out) if out else body


def parse_response(block: bytes) -> tuple[str, list[tuple[str, str]], bytes, bytes]:
    """Status line, header fields, payload as sent, and body after transfer and content codings."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, _, head = head.partition(b"\r\n")
    fields = _fields(head)
    body = payload
    try:  # the last coding first, those of the transfer before those of the content
        for coding in [*reversed(_codings(fields, "transfer-encoding")), *reversed(_codings(fields, "content-encoding"))]:
            body = _decoded(body, coding)
    except (OSError, EOFError, zlib.error):
        pass  # a broken coding leaves the bytes as they came
    return status.decode("utf-8", "replace"), fields, payload, body


def page_of(fields: list[tuple[str, str]], body: bytes) -> str:
    """The body as text, by the charset that the header or else the page names (default UTF-8)."""
    named = next((value.encode() for name, value in fields if name.lower() == "content-type"), b"")
    found = _CHARSET.search(named) or _CHARSET.search(body[:1024])
    try:
        return body.decode(found[1].decode() if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def response_of(page_id: object, url: str | None, page: str | None, date: str = DATE) -> tuple[str, bytes]:
    """Identifier and bytes of the response record of a stored page."""
    body = (page or "").encode()
    name = f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id} {url} {digest(body)}')}>"
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)) + body
    return name, record_bytes([
        ("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", url or ""),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Block-Digest", digest(block)),
        ("WARC-Payload-Digest", digest(body))], block)


def plain_text(page: str) -> str:
    """All visible text, a line for each block."""
    return "\n".join(line.text for line in lines_of(page, whole=True) if line.text)


def derivatives(response: bytes) -> list[dict]:
    """The metadata and the conversion record of one response record.

    Both refer to the response by WARC-Refers-To and repeat its target and date, so they can be
    joined to it and to each other.  The metadata block keeps the HTTP status and header lines
    and the source's digests; the conversion block is the plain text."""
    fields, block = parse_record(response)
    status, http, payload, body = parse_response(block)
    page = page_of(http, body)
    source, uri, date = (fields.get(k, "") for k in ("warc-record-id", "warc-target-uri", "warc-date"))
    payload_digest = fields.get("warc-payload-digest") or digest(payload)
    title = _TITLE.search(page)
    notes = [("fetchStatus", status), *((f"http-{name}", value) for name, value in http),
             ("sourceBlockDigest", fields.get("warc-block-digest") or digest(block)), ("sourcePayloadDigest", payload_digest),
             *([("title", " ".join(title[1].split()))] if title else []),
             *(("outlink", next(filter(None, m), "")) for m in _LINK.findall(page))]
    blocks_made = {"metadata": ("application/warc-fields", "".join(f"{k}: {_clean(v)}\r\n" for k, v in notes).encode()),
                   "conversion": ("text/plain; charset=utf-8", plain_text(page).encode())}
    names = {kind: f"<urn:uuid:{uuid.uuid5(SPACE, f'{source} {kind}')}>" for kind in KINDS}
    made = []
    for kind in KINDS:
        content_type, content = blocks_made[kind]
        headers = [("WARC-Type", kind), ("WARC-Record-ID", names[kind]), ("WARC-Date", date), ("WARC-Target-URI", uri),
                   ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date),
                   ("WARC-Concurrent-To", names[KINDS[1 - KINDS.index(kind)]]), ("Content-Type", content_type),
                   ("WARC-Block-Digest", digest(content))]
        if kind == "conversion":
            headers.append(("WARC-Payload-Digest", payload_digest))
        made.append({"record_id": names[kind], "record_type": kind, "target_uri": uri, "date": date, "refers_to": source,
                     "content_type": content_type, "block_digest": digest(content), "payload_digest": payload_digest,
                     "content_length": len(content), "record": record_bytes(headers, content)})
    return made


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(page_id, record): a response record for each row of ``pages`` (page_id, url, html); null
    html is an empty body, a null url an empty target."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "html"):
                made = [response_of(*row, date)[1] for row in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)]
                yield pa.record_batch([part.column("page_id"), pa.array(made, pa.binary())], ["page_id", "record"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(write, "page_id long, record binary")


def derive(records: DataFrame, record_column: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows (metadata, conversion) for each response record in ``record_column``, with the
    columns of ``keep``.  Records of another type and null records give none; repeated records
    give repeated rows; what cannot be parsed gives empty fields and never stops the job."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, source):
                places, made = [], []
                for at, record in enumerate(part.column(source).to_pylist()):
                    if record and parse_record(record)[0].get("warc-type") == "response":
                        for row in derivatives(record):
                            places.append(at)
                            made.append(row)
                own = [part.column(c).take(pa.array(places, pa.int64())) for c in keep]
                columns = [pa.array([r[n] for r in made], kind) for n, kind in zip(names, kinds, strict=True)]
                yield pa.record_batch([*own, *columns], [*keep, *names])

    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [pa.binary() if n == "record" else pa.int64() if n == "content_length" else pa.string() for n in names]
    source = free([*keep, *names], "source")
    narrow = records.select(*keep, F.col(record_column).cast("binary").alias(source))
    fields = [f"`{name}` {kind}" for name, kind in narrow.select(*keep).dtypes] if keep else []
    return narrow.mapInArrow(build, ", ".join([*fields, RECORD]))
