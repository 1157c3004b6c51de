"""WARC/1.0 records, and a builder of derivatives: metadata and plain-text conversions that refer to responses."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

_SPACE = uuid.UUID("6f2f8b52-6f0d-5d53-9a44-0a1d2a1f5c11")
DATE = "1970-01-01T00:00:00Z"


def digest(data: bytes) -> str:
    """SHA-1 in base 32, labelled as WARC digests are."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A URN that depends on the parts alone, so that reruns and retried tasks make the same records."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, '|'.join(parts))}>"


@dataclass
class Record:
    """Headers in their order, names as written, and a block of bytes."""

    headers: list[tuple[str, str]]
    block: bytes = b""
    version: str = "WARC/1.0"
    #: What was wrong with a record that was read.
    faults: list[str] = field(default_factory=list)

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.headers if k.lower() == name.lower()), None)

    def to_bytes(self) -> bytes:
        clean = lambda v: re.sub(r"[\r\n]+", " ", v)  # noqa: E731  a line break would end the header
        head = "".join(f"{k}: {clean(v)}\r\n" for k, v in self.headers if k.lower() != "content-length")
        return f"{self.version}\r\n{head}Content-Length: {len(self.block)}\r\n\r\n".encode() + self.block + b"\r\n\r\n"


def written(records, compress: bool = True) -> bytes:
    """A WARC file's bytes; compressed, each record is a gzip member of its own."""
    return b"".join(gzip.compress(r.to_bytes(), 4, mtime=0) if compress else r.to_bytes() for r in records)


def parsed(data: bytes) -> Iterator[Record]:
    """The records of a WARC file, compressed or not. A truncated or garbled end gives a record with faults, never an error.

    Of a compressed file one gzip member is held unzipped at a time, or those
    that one record spans.
    """
    if data[:2] != b"\x1f\x8b":
        yield from _records(data)
        return
    held = b""
    for member in _members(data):
        if held and member.startswith(b"WARC/"):
            yield from _records(held)
            held = b""
        held += member
    yield from _records(held)


def _records(data: bytes) -> Iterator[Record]:
    at = 0
    while at < len(data):
        start = data.find(b"WARC/", at)
        if start < 0:
            return
        end = data.find(b"\r\n\r\n", start)
        if end < 0:
            yield Record([], data[start:], faults=["no end of headers"])
            return
        version, *lines = data[start:end].decode("utf-8", "replace").split("\r\n")
        headers: list[tuple[str, str]] = []
        for line in lines:
            if line[:1] in " \t" and headers:
                headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
            elif ":" in line:
                k, v = line.split(":", 1)
                headers.append((k.strip(), v.strip()))
        rec = Record(headers, version=version)
        size = rec.get("Content-Length")
        if size is None or not size.isdigit():
            rec.faults.append("no content length")
            at = data.find(b"\r\n\r\nWARC/", end)
            at = len(data) if at < 0 else at + 4
            rec.block = data[end + 4 : at].removesuffix(b"\r\n\r\n")
        else:
            rec.block = data[end + 4 : end + 4 + int(size)]
            if len(rec.block) < int(size):
                rec.faults.append("truncated block")
            at = end + 4 + int(size)
        told = rec.get("WARC-Block-Digest")
        if told and told.startswith("sha1:") and told != digest(rec.block):
            rec.faults.append("block digest differs")
        yield rec


def _members(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """Each gzip member unzipped; of a broken one what could be read."""
    at = 0
    while at < len(data):
        unzip, out = zlib.decompressobj(31), []
        try:
            while at < len(data) and not unzip.eof:
                part = data[at : at + step]
                out.append(unzip.decompress(part))
                at += len(part) - len(unzip.unused_data)
        except zlib.error:
            at = len(data)
        yield b"".join(out)


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP message."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep and not block.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("iso-8859-1").split("\r\n")
    return status, [(k.strip(), v.strip()) for k, v in (x.split(":", 1) for x in lines if ":" in x)], body


def unchunked(body: bytes) -> tuple[bytes, list[str]]:
    """A body out of its chunks, and what was wrong with them; a body that holds no chunk at all is left as it is."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return (b"".join(out), ["broken chunk"]) if out else (body, ["no chunks"])
        n = int(size, 16)
        if not n:
            return b"".join(out), []
        out.append(body[end + 2 : end + 2 + n])
        if len(out[-1]) < n:
            return b"".join(out), ["truncated chunk"]
        at = end + 2 + n + 2


def decoded(headers: list[tuple[str, str]], body: bytes) -> tuple[bytes, list[str]]:
    """The body without its transfer and content encodings, outermost first, and what was wrong; an unknown or wrong encoding leaves it as it is."""
    told = lambda name: [x.strip().lower() for k, v in headers if k.lower() == name for x in v.split(",")]
    faults = []
    for encoding in [*reversed(told("transfer-encoding")), *reversed(told("content-encoding"))]:
        if encoding == "chunked":
            body, wrong = unchunked(body)
            faults += wrong
        elif encoding in ("gzip", "x-gzip", "deflate"):
            out, rest = [], body
            for bits in (47, -15):
                unzip = zlib.decompressobj(bits)
                try:
                    # In steps, so that what comes before a fault is kept.
                    for at in range(0, len(rest), 4096):
                        out.append(unzip.decompress(rest[at : at + 4096]))
                    out.append(unzip.flush())
                except zlib.error:
                    if not any(out):
                        continue
                break
            if any(out) or not body:
                body = b"".join(out)
                faults += [] if unzip.eof or not rest else [f"truncated {encoding}"]
            else:
                faults.append(f"not {encoding}")
        elif encoding not in ("", "identity"):
            faults.append(f"unread encoding {encoding}")
    return body, faults


_OPEN = re.compile(r"<(?:(script|style|noscript|template|head)\b[^>]*>|!--)", re.I)
_CLOSE = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "noscript", "template", "head", "title")} | {None: re.compile("-->")}
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|title|blockquote|pre|hr|main|aside)\b[^>]*>", re.I)
_TAG = re.compile(r"<[^>]*>")
_LINK = re.compile(r"<a\b([^>]*)>|</a\s*>", re.I)
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_META = re.compile(r"<meta\b([^>]*)>", re.I)
_ATTR = re.compile(r"(?<![\w:-])([\w:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")


def _parted(source: str) -> tuple[str, str]:
    """What may hold whole tags, and the rest behind the last >: without it each < there would be read to the end."""
    at = source.rfind(">") + 1
    return source[:at], source[at:]


def _shown(source: str) -> str:
    """HTML without what is never shown, a line break for each; elements without an end stay. Each end is looked for once from any place."""
    out, at, ends = [], 0, {}
    for m in _OPEN.finditer(source):
        if m.start() < at:
            continue
        kind = m[1] and m[1].lower()
        if ends.get(kind, 0) is not None and (ends.get(kind) is None or ends[kind].start() < m.end()):
            ends[kind] = _CLOSE[kind].search(source, m.end())
        end = ends[kind]
        if end is not None:
            out += [source[at : m.start()], "\n"]
            at = end.end()
    return "".join([*out, source[at:]])


def plain_text(source: str) -> str:
    """Visible text of HTML: a line a block, blanks folded, entities resolved."""
    tags, rest = _parted(source)
    text = _TAG.sub("", _BREAK.sub("\n", _shown(tags))) + rest
    lines = (" ".join(html.unescape(x).split()) for x in text.split("\n"))
    return "\n".join(x for x in lines if x)


def _attributes(inside: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for k, v in _ATTR.findall(inside):
        out.setdefault(k.lower(), html.unescape(v.strip("\"'")))
    return out


def outline(source: str) -> dict:
    """Title, metas and links of HTML."""
    tags, _ = _parted(source)
    title, head, links, opened = _TITLE.search(tags), None, [], None
    if title and (end := _CLOSE["title"].search(tags, title.end())):
        head = plain_text(tags[title.end() : end.start()])
    for m in _LINK.finditer(tags):
        if m[1] is None:
            if opened:
                links.append({"url": opened[0], "text": plain_text(tags[opened[1] : m.start()]).replace("\n", " ")})
            opened = None
        elif opened is None and "href" in (at := _attributes(m[1])):
            opened = at["href"], m.end()
    metas = [at for m in _META.finditer(tags) if (at := _attributes(m[1]))]
    return {"title": head, "metas": metas, "links": links}


def response_of(url: str | None, source: str | None, key: str, date: str = DATE, headers: list[tuple[str, str]] | None = None) -> Record:
    """An HTTP response record of a page; a null URL or page becomes an empty one."""
    body = (source or "").encode()
    head = headers or [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    block = b"HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body
    return Record([
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url or "", digest(body))), ("WARC-Date", date), ("WARC-Target-URI", url or ""),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)),
    ], block)


def derivatives(response: Record) -> list[Record]:
    """The metadata and the conversion record of a response; none of another type.

    Both refer to the response by its id and keep its URI and date; the metadata
    holds the source record's headers, those of the HTTP message, both digests
    and the page's outline, and names the conversion.
    """
    if (response.get("WARC-Type") or "").lower() != "response":
        return []
    source_id, uri, date = response.get("WARC-Record-ID") or "", response.get("WARC-Target-URI") or "", response.get("WARC-Date") or DATE
    status, headers, body = http_parts(response.block)
    whole, faults = decoded(headers, body)
    charset = next((m[1] for k, v in headers if k.lower() == "content-type" and (m := re.search(r"charset=\"?([\w-]+)", v))), "utf-8")
    try:
        page = whole.decode(charset, "replace")
    except LookupError:
        page = whole.decode("utf-8", "replace")
    text = plain_text(page).encode("utf-8", "replace")
    text_id, meta_id = record_id("conversion", source_id), record_id("metadata", source_id)
    envelope = {
        "source-headers": response.headers, "http-status": status, "http-headers": headers, "payload-length": len(body),
        "payload-digest": response.get("WARC-Payload-Digest") or digest(body), "actual-digest": digest(body),
        "conversion-id": text_id, "faults": response.faults + faults, "outline": outline(page),
    }
    meta = json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace")
    common = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", source_id)]
    return [
        Record([("WARC-Type", "metadata"), ("WARC-Record-ID", meta_id), *common, ("WARC-Concurrent-To", text_id), ("Content-Type", "application/json"), ("WARC-Block-Digest", digest(meta))], meta),
        Record([("WARC-Type", "conversion"), ("WARC-Record-ID", text_id), *common, ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Block-Digest", digest(text)), ("WARC-Source-Payload-Digest", envelope["payload-digest"])], text),
    ]


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(page_id, warc): a compressed WARC response record for every row of ``pages(page_id, url, html)``."""

    def run(batches):
        for batch in batches:
            ids, urls, sources = (batch.column(i).to_pylist() for i in range(3))
            made = [written([response_of(u, h, str(i), date)]) for i, u, h in zip(ids, urls, sources, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["page_id", "warc"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, warc binary")


_COLUMNS = "page_id long, record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, source_payload_digest string, source_headers array<struct<name:string,value:string>>, block string, warc binary"


def derived(sources: DataFrame) -> DataFrame:
    """Two rows, metadata and conversion, for every response in ``sources(page_id, warc)``, ``warc`` one or more records.

    Each row has the record's fields and its own compressed record. Null and
    empty sources, and records of other types, give no rows; a truncated one is
    converted as far as it goes, with its fault in the metadata. Chunked, gzip
    and deflate bodies are decoded for the conversion; digests are those of the
    body as sent. Repeated header names are kept in their order. Rows that
    repeat give equal records, an empty table none, and other columns of
    ``sources``, whatever their names, play no part.
    """

    def run(batches):
        names = [x.split(" ")[0] for x in _COLUMNS.split(", ")]
        for batch in batches:
            rows = []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for source in parsed(data or b""):
                    for r in derivatives(source):
                        payload = source.get("WARC-Payload-Digest")
                        rows.append((key, r.get("WARC-Type"), r.get("WARC-Record-ID"), r.get("WARC-Refers-To"), r.get("WARC-Concurrent-To"), r.get("WARC-Target-URI"), r.get("WARC-Date"), r.get("Content-Type"), len(r.block), r.get("WARC-Block-Digest"), payload, [{"name": k, "value": v} for k, v in source.headers], r.block.decode("utf-8", "replace"), written([r])))
            kinds = [pa.int64(), *[pa.string()] * 7, pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())])), pa.string(), pa.binary()]
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return sources.select(F.col("page_id").cast("long"), "warc").mapInArrow(run, _COLUMNS)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derivatives of all pages, by way of written and parsed response records."""
    return derived(responses(table(spark, sf_dir, "pages")))
