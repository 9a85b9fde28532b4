"""WARC derivatives: linked metadata and plain-text conversion records from response records.

``responses`` writes pages as WARC/1.1 response records, ``parse`` reads
records back and ``derivatives`` turns each response into a metadata record
(links, title and character set of the page, and the source's HTTP headers)
and a conversion record (its plain text). Both carry WARC-Refers-To and
WARC-Refers-To-Target-URI of the response, its WARC-Date and the digest of
its payload; block and payload digests are SHA-1 in base 32 as the format's
users write them. Record ids are name-based UUIDs of the content, so a lost
task makes the same records again. Everything is row by row; nothing moves.

Cases: null html is an empty payload, null url an empty target; a response
whose block is no HTTP message is taken as a payload without headers; chunked,
gzip and deflate payloads are decoded (a broken encoding as far as it goes);
a response that is no page (another status than 200, another type than HTML
or plain text) has a metadata record and no conversion;
records of another type give no derivatives; broken records raise
``ValueError`` in ``parse``; repeated rows each give their records, with the
same ids; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparvane.llm import html_text
from sparvane.llm.common import table

#: Records are dated by the corpus, not by the clock, so that they can be made again.
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)

Headers = list[tuple[str, str]]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(31).join(parts))}>"


def one_line(value: str) -> str:
    """A header value: line ends would begin another header."""
    return re.sub(r"[\r\n]+", " ", value).strip()


def encode(headers: Headers, block: bytes) -> bytes:
    """A record: version, headers, empty line, block and two line ends."""
    lines = ["WARC/1.1", *(f"{k}: {one_line(v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[Headers, bytes]]:
    """The records of a file's bytes, each as its headers (Content-Length included) and its block."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        headers: Headers = []
        for line in data[at:end].decode().split("\r\n")[1:]:
            if line[:1] in (" ", "\t") and headers:  # a folded line
                headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.strip())
                continue
            name, colon, value = line.partition(":")
            if not colon:
                raise ValueError(f"no header: {line!r}")
            headers.append((name, value.strip()))
        length = int(get(headers, "Content-Length") or -1)
        start = end + 4
        if length < 0 or data[start + length : start + length + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where it says")
        out.append((headers, data[start : start + length]))
        at = start + length + 4
    return out


def get(headers: Headers, name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def split_http(block: bytes) -> tuple[list[str], bytes]:
    """Status and header lines, and payload."""
    head, empty, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not empty:
        return [], block
    return head.decode("utf-8", "replace").split("\r\n"), payload


def payload_of(lines: list[str], payload: bytes) -> bytes:
    """The payload as the server meant it: chunks joined, then gzip and deflate undone.

    What does not hold to its encoding is left as it is from there on.
    """
    headers = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
    # content codings are applied before transfer codings, each list in its order
    codings = ",".join(get(headers, name) or "" for name in ("Content-Encoding", "Transfer-Encoding")).lower().split(",")
    for coding in reversed([c.strip() for c in codings]):
        if coding == "chunked":
            payload = _dechunked(payload)
        elif coding in ("gzip", "x-gzip", "deflate"):
            payload = _inflated(payload)
    return payload


def _dechunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        try:
            size = int(data[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:  # no chunk begins here
            return b"".join([*out, data[at:]])
        if size == 0:
            return b"".join(out)
        out.append(data[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
        if at > len(data):
            return b"".join(out)


def _inflated(data: bytes) -> bytes:
    """gzip, zlib or raw deflate, in one or several members; cut short where the data are."""
    out = []
    while data:
        for kind in (47, -15):  # a gzip or zlib head, or none
            engine = zlib.decompressobj(kind)
            try:
                out.append(engine.decompress(data) + engine.flush())
                break
            except zlib.error:
                continue
        else:
            return b"".join(out) if out else data
        data = engine.unused_data
    return b"".join(out)


def is_text(lines: list[str]) -> bool:
    """Whether a response is a page: no HTTP head, or a 200 of HTML, XHTML or plain text (where it says so)."""
    if not lines:
        return True
    status = lines[0].split()[1:2]
    kind = (get([(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])], "Content-Type") or "text/html").split(";")[0].strip().lower()
    return status == ["200"] and kind in ("text/html", "application/xhtml+xml", "text/plain")


def response(page_id: int | None, url: str, page: str) -> bytes:
    payload = page.encode("utf-8", "surrogatepass")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", str(page_id), url, digest(payload))),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return encode(headers, block)


def derive(headers: Headers, block: bytes) -> list[tuple[Headers, bytes]]:
    """Metadata and conversion record of one record, none for other types than response; no conversion of what is no page."""
    if (get(headers, "WARC-Type") or "").lower() != "response":
        return []
    lines, payload = split_http(block)
    payload_digest = get(headers, "WARC-Payload-Digest") or digest(payload)
    payload, page_like = payload_of(lines, payload), is_text(lines)
    source, target, date = get(headers, "WARC-Record-ID") or "", get(headers, "WARC-Target-URI") or "", get(headers, "WARC-Date") or DATE
    charset = CHARSET.search("\n".join(lines)) or CHARSET.search(payload[:1024].decode("ascii", "replace"))
    name = charset[1].lower() if charset else "utf-8"
    try:
        page = payload.decode(name, "replace")
    except (LookupError, ValueError):  # no such character set, or one that decodes nothing
        name, page = "utf-8", payload.decode("utf-8", "replace")
    page = page if page_like else ""
    title = TITLE.search(page)
    meta = [
        *(f"http-header: {one_line(x)}" for x in lines),
        f"charset-detected: {name}",
        f"title: {one_line(html.unescape(title[1])) if title else ''}",
        *(f"outlink: {one_line(html.unescape(''.join(m)))}" for m in LINK.findall(page)),
    ]
    made = [("metadata", "\r\n".join([*meta, ""]), "application/warc-fields")]
    if page_like:
        made.append(("conversion", html_text.extract(page, set()), "text/plain"))
    out = []
    for kind, body, content_type in made:
        data = body.encode("utf-8", "surrogatepass")
        out.append((
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", record_id(kind, source, digest(data))),
                ("WARC-Date", date),
                ("WARC-Target-URI", target),
                ("WARC-Refers-To", source),
                ("WARC-Refers-To-Target-URI", target),
                ("WARC-Refers-To-Date", date),
                ("WARC-Refers-To-Payload-Digest", payload_digest),
                ("WARC-Block-Digest", digest(data)),
                ("Content-Type", content_type),
            ],
            data,
        ))
    return out


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record): each page as the bytes of a response record."""
    schema = pa.schema([("page_id", pa.int64()), ("record", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("page_id").to_pylist()
            for at in range(0, len(ids), 500):
                part = batch.slice(at, 500)
                made = [response(i, u.as_py() or "", h.as_py() or "") for i, u, h in zip(ids[at : at + 500], part.column("url"), part.column("html"), strict=True)]
                yield table({"page_id": ids[at : at + 500], "record": made}, schema)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, record binary")


def files(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record): the records of .warc and .warc.gz files, numbered within their file; a file is read by one task."""
    schema = pa.schema([("page_id", pa.int64()), ("record", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                found = [encode([h for h in headers if h[0].lower() != "content-length"], block) for headers, block in parse(_inflated(data) if data[:2] == b"\x1f\x8b" else data)]
                for at in range(0, len(found), 500):
                    yield table({"page_id": list(range(at, min(at + 500, len(found)))), "record": found[at : at + 500]}, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "page_id long, record binary")


def file_of(records: list[bytes]) -> bytes:
    """The bytes of a .warc.gz file: each record a gzip member of its own, as readers expect."""
    return b"".join(gzip.compress(x, mtime=0) for x in records)


def derivatives(records: DataFrame) -> DataFrame:
    """(page_id, record) -> the derivatives of each response, with their headers as columns and their bytes in ``record``."""
    names = ["warc_type", "record_id", "refers_to", "target_uri", "source_payload_digest", "block_digest"]
    wanted = ["WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Refers-To-Payload-Digest", "WARC-Block-Digest"]
    schema = pa.schema([("page_id", pa.int64()), *((n, pa.string()) for n in names), ("record", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for page_id, data in zip(batch.column("page_id").to_pylist(), batch.column("record"), strict=True):
                for headers, block in parse(data.as_py()):
                    out += [(page_id, *(get(h, w) for w in wanted), encode(h, b)) for h, b in derive(headers, block)]
                if len(out) >= 500:
                    yield table(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)
                    out = []
            if out:
                yield table(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)

    return records.mapInArrow(run, "page_id long, " + ", ".join(f"{n} string" for n in names) + ", record binary")


def digests(pages: DataFrame) -> DataFrame:
    """Derivatives of all pages with the SHA-256 and length of each record in place of its bytes."""
    made = derivatives(responses(pages))
    return made.withColumn("n_bytes", F.length("record").cast("long")).withColumn("record_sha256", F.sha2("record", 256)).drop("record")
