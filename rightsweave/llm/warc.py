"""Derivatives of WARC responses: a metadata and a plain-text conversion record for each, linked to it.

A response row has record_id, target_uri, date, headers (other named fields of
the record) and block, the HTTP message.  Each derivative refers to the
response by its identifier, URI and date; the metadata record repeats the
source's status line, HTTP headers, record headers and digests, and the
conversion holds the text of an HTML or plain-text payload, chunks and
compression undone (digests and lengths are of the payload as it came).  A
coding that is neither chunked, gzip nor deflate, or content of more than
``LARGEST`` bytes, leaves no conversion, and the metadata says so; a given
payload digest is passed on, with the computed one beside it where they differ.
Identifiers follow from the response's identifier, so that reruns agree.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

CRLF = "\r\n"
#: Elements whose content is not text.
_HIDDEN = ("script", "style", "template", "noscript", "title")
_CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in _HIDDEN}
_TITLE = re.compile(r"<title\b", re.I)
#: Bytes that the content of a payload may have; one that inflates to more has no conversion.
LARGEST = 1 << 28
#: Bytes that are inflated at once.
_STEP = 4096
#: Elements that begin and end a line.
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]"
                    r"|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|tr|ul)"
                    r"\b[^<>]*>", re.I)
_TAG = re.compile(r"<[/!?a-zA-Z][^<>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
#: The line before a chunk: its size, extensions.
_CHUNK = re.compile(rb"[ \t]*([0-9a-fA-F]{1,15})[ \t]*(?:;[^\r\n]*)?\r\n")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def digest(data: bytes) -> str:
    """The labelled digest of WARC: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, payload) of an HTTP message; a block without one is all payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    headers = [(name.strip(), value.strip()) for name, colon, value in (line.partition(":") for line in lines) if colon]
    return first, headers, payload


def _unchunked(data: bytes) -> bytes:
    """The content of a chunked body, as far as it goes; data that is not chunked stays."""
    parts, at = [], 0
    while True:
        size = _CHUNK.match(data, at)
        if not size:
            return b"".join(parts) if parts else data
        n = int(size[1], 16)
        if not n:
            return b"".join(parts)
        parts.append(data[size.end():size.end() + n])
        at = size.end() + n + 2


def _inflated(data: bytes, bits: int, largest: int) -> bytes | None:
    """The members in ``data``, joined, as far as they go; None if they hold more than ``largest`` bytes."""
    parts, room, one = [], largest, zlib.decompressobj(bits)
    try:
        for at in range(0, len(data), _STEP):
            rest = data[at:at + _STEP]
            while rest:
                parts.append(one.decompress(rest, room + 1))
                room -= len(parts[-1])
                if room < 0:
                    return None
                rest = one.unconsumed_tail
                if one.eof:
                    rest, one = one.unused_data, zlib.decompressobj(bits)
    except zlib.error:
        pass
    return b"".join(parts)


def _unzipped(data: bytes, coding: str, largest: int) -> bytes | None:
    """``data`` without its gzip or deflate coding; data in another form stays, None for more than ``largest`` bytes."""
    for bits in (31,) if coding != "deflate" else (15, -15):
        out = _inflated(data, bits, largest)
        if out != b"":
            return out
    return data


def content_of(payload: bytes, http: list[tuple[str, str]], largest: int = LARGEST) -> bytes | None:
    """The payload with transfer and content codings undone, the last applied first.

    None for a coding not known here, and if it inflates to more than ``largest`` bytes.
    """
    for header in ("transfer-encoding", "content-encoding"):
        codings = [c.strip().lower() for n, v in http if n.lower() == header for c in v.split(",")]
        for coding in reversed(codings):
            if coding == "chunked":
                payload = _unchunked(payload)
            elif coding in ("gzip", "x-gzip", "deflate"):
                payload = _unzipped(payload, coding, largest)
                if payload is None:
                    return None
            elif coding not in ("", "identity"):
                return None
    return payload


def _decoded(payload: bytes, content_type: str) -> str:
    charset = re.search(r"charset=[\"']?([\w.:-]+)", content_type, re.I)
    try:
        return payload.decode(charset[1] if charset else "utf-8", "replace")
    except (LookupError, UnicodeDecodeError):
        return payload.decode("utf-8", "replace")


def _shown(page: str, hidden: tuple[str, ...]) -> str:
    """``page`` with a blank for each comment and each element of the names ``hidden``, in linear time.

    What is not closed goes to the end; a tag without its ``>`` is text.
    """
    opening = re.compile(rf"<!--|<({'|'.join(hidden)})\b", re.I)
    parts, at, look = [], 0, 0
    while found := opening.search(page, look):
        if found[0] == "<!--":
            close = page.find("-->", found.end())
            end = close + 3 if close >= 0 else len(page)
        else:
            bracket = page.find(">", found.end())
            if bracket < 0:  # no later tag ends either
                opening = re.compile("<!--")
                look = found.end()
                continue
            closing = _CLOSING[found[1].lower()].search(page, bracket + 1)
            end = closing.end() if closing else len(page)
        parts.append(page[at:found.start()])
        at = look = end
    return " ".join([*parts, page[at:]])


def text_of(page: str) -> str:
    """The text of an HTML page: no markup, scripts or styles, entities resolved, a line per block element."""
    shown = _BREAK.sub("\n", _shown(page, _HIDDEN))
    shown = html.unescape(_TAG.sub("", shown)).replace("\r", "\n")
    return _LINES.sub("\n", _BLANKS.sub(" ", shown)).strip()


def title_of(page: str) -> str:
    """The first title outside comments and other hidden elements; without its end tag it is none."""
    shown = _shown(page, tuple(n for n in _HIDDEN if n != "title"))
    opening = _TITLE.search(shown)
    start = shown.find(">", opening.end()) + 1 if opening else 0
    closing = _CLOSING["title"].search(shown, start) if start else None
    return " ".join(html.unescape(_TAG.sub("", shown[start:closing.start()])).split()) if closing else ""


def _field(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def _uri(value: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, record_id: str, fields: list[tuple[str, str | None]], content_type: str, block: bytes) -> bytes:
    """The bytes of a WARC/1.1 record; fields without a value are left out."""
    named = [("WARC-Type", kind), ("WARC-Record-ID", record_id), *((n, v) for n, v in fields if v),
             ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    head = "WARC/1.1" + CRLF + "".join(f"{n}: {v}{CRLF}" for n, v in named) + CRLF
    return head.encode("utf-8", "replace") + block + b"\r\n\r\n"


def derive(row: dict) -> Iterator[dict]:
    """The metadata record of a response row, then its conversion if the payload is HTML or plain text."""
    source = _field(row["record_id"] or "")
    uri, date = _uri(row["target_uri"] or ""), _field(row["date"] or "")
    given = {n.lower(): _field(v) for n, v in (row["headers"] or {}).items() if v}
    status, http, payload = split_http(row["block"] or b"")
    kinds = [v for n, v in http if n.lower() == "content-type"]
    content_type = kinds[-1] if kinds else "text/html"
    own_digest = digest(payload)
    payload_digest = given.get("warc-payload-digest") or own_digest
    refers = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source),
              ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date)]
    is_html = content_type.lower().startswith(("text/html", "application/xhtml"))
    is_text = is_html or content_type.lower().startswith("text/plain")
    content = content_of(payload, http) if is_text else None
    page = _decoded(content, content_type) if content is not None else None

    def made(kind: str, content_kind: str, block: bytes, more: list[tuple[str, str | None]]) -> dict:
        record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, kind + ' ' + source)}>"
        return {"type": kind, "record_id": record_id, "refers_to": source if row["record_id"] is not None else None, "target_uri": row["target_uri"],
                "content_type": content_kind, "payload_digest": payload_digest, "block_digest": digest(block),
                "length": len(block), "record": record(kind, record_id, refers + more, content_kind, block)}

    lines = [("source-record", source), ("status", status), ("payload-digest", payload_digest),
             ("payload-length", str(len(payload))), ("title", title_of(page) if is_html and page is not None else "")]
    if payload_digest != own_digest:
        lines.append(("computed-payload-digest", own_digest))
    if is_text and page is None:
        lines.append(("conversion", "none"))
    lines += [(f"http-{n}", _field(v)) for n, v in http]
    lines += [(f"source-{n}", v) for n, v in sorted(given.items())]
    fields = "".join(f"{n}: {v}{CRLF}" for n, v in lines if v)
    yield made("metadata", "application/warc-fields", fields.encode("utf-8", "replace"), [])
    if page is not None:
        text = text_of(page) if is_html else page
        yield made("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"),
                   [("WARC-Source-Payload-Digest", payload_digest)])


def derivatives(responses: DataFrame, keys: list[str]) -> DataFrame:
    """Key columns and the derived records of every response: one metadata record, and a conversion for text payloads.

    Null fields and headers are left out of a record, a null block is an empty
    one, and a payload without a content type counts as HTML.  Repeated rows
    give repeated records.  Other columns are ignored; an empty table gives an
    empty result.
    """
    ship(responses.sparkSession)
    names = ["record_id", "target_uri", "date", "headers", "block"]
    kept = responses.select(F.struct(*keys).alias("key"), *names)
    kinds = [pa.string()] * 7 + [pa.int64(), pa.binary()]
    out = ["type", "record_id", "refers_to", "target_uri", "content_type", "payload_digest", "block_digest", "length", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                number, found = [], []
                columns = [part.column(i) for i in range(1, 6)]
                for i in range(part.num_rows):
                    row = {n: c[i].as_py() for n, c in zip(names, columns)}
                    row["headers"] = dict(row["headers"] or ())
                    for made in derive(row):
                        number.append(i)
                        found.append(made)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(number, pa.int32())),
                     *(pa.array([f[n] for f in found], k) for n, k in zip(out, kinds))], ["key", *out])

    schema = f"key {kept.schema['key'].dataType.simpleString()}, " + ", ".join(
        f"{n} {'bigint' if n == 'length' else 'binary' if n == 'record' else 'string'}" for n in out)
    return kept.mapInArrow(run, schema).select("key.*", *out)


def member(data: bytes) -> bytes:
    """A record as a gzip member of its own; members joined together are a .warc.gz file."""
    return gzip.compress(data, mtime=0)


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records in the bytes of a WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(fields["Content-Length"])
        yield fields, data[start:stop]
        at = stop + 4
