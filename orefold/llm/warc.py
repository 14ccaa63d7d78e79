"""WARC derivatives: responses become linked metadata and plain-text conversion records.

Records are rows (RECORD); ``write`` puts them into files of gzip members, ``read`` takes files of any
WARC records apart again. A derived record refers to its response, keeps the source's headers in its
metadata and carries digests of its own block, and the source's payload digest under a name of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.common import arrow_map, check_columns, schema

RECORD = schema(
    page_id=T.LongType(), record_type=T.StringType(), record_id=T.StringType(), refers_to=T.StringType(),
    target_uri=T.StringType(), warc_date=T.StringType(), content_type=T.StringType(),
    content_length=T.LongType(), block_digest=T.StringType(), payload_digest=T.StringType(),
    extra_headers=T.MapType(T.StringType(), T.StringType()), block=T.BinaryType())
ARROW = pa.schema([
    ("page_id", pa.int64()), *[(n, pa.string()) for n in (
        "record_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type")],
    ("content_length", pa.int64()), ("block_digest", pa.string()), ("payload_digest", pa.string()),
    ("extra_headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())])
#: Record headers by column (fixed by the format).
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "content_type": "Content-Type",
    "content_length": "Content-Length", "block_digest": "WARC-Block-Digest",
    "payload_digest": "WARC-Payload-Digest"}
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|head)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(
    r"<(?:/?(?:p|div|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|main|blockquote|pre|td|th)\b[^>]*"
    r"|br\b[^>]*|hr\b[^>]*)>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*(?:>|\Z)")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(*parts: str) -> str:
    """A record id that depends on its parts only, so a repeated task gives the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def plain_text(page: str) -> str:
    """Visible text of HTML: a line for each block, blanks in a row as one, no empty lines."""
    shown = _TAG.sub("", _BREAK.sub("\n", _HIDDEN.sub(" ", page)))
    lines = (" ".join(line.split()) for line in html.unescape(shown).split("\n"))
    return "\n".join(line for line in lines if line)


def _record(page_id, kind: str, record_id: str, refers_to, uri: str, date: str, content_type: str, block: bytes,
            payload_digest: str | None, extra: dict[str, str]) -> tuple:
    """A row; without a digest of its own the payload is the whole block."""
    whole = digest(block)
    return (page_id, kind, record_id, refers_to, uri, date, content_type, len(block), whole,
            payload_digest or whole, list(extra.items()), block)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(ARROW), ARROW)], schema=ARROW)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for row in batch.to_pylist():
        row["extra_headers"] = dict(row["extra_headers"] or [])
        yield row


def _mapped(df: DataFrame, convert) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                yield _batch(convert(whole.slice(first, 500)))

    return arrow_map(df, run, RECORD)


def responses(pages: DataFrame, warc_date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as response records with an HTTP head.

    Null html is a response without payload; a null url becomes ``urn:page:<page_id>``.
    """
    check_columns(pages, ["page_id", "url", "html"])

    def convert(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for row in batch.to_pylist():
            body = (row["html"] or "").encode("utf-8", "replace")
            uri = row["url"] if row["url"] is not None else f"urn:page:{row['page_id']}"
            head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
                    f"X-Page-Id: {row['page_id']}\r\n\r\n").encode()
            paid = digest(body)
            out.append(_record(row["page_id"], "response", record_urn("response", uri, str(row["page_id"]), paid),
                               None, uri, warc_date, "application/http; msgtype=response", head + body, paid, {}))
        return out

    columns = [F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")]
    return _mapped(pages.select(*columns), convert)


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message; a block without a head is all payload."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = [tuple(p.strip() for p in line.partition(":")[::2]) for line in lines if ":" in line]
    return status, pairs, body


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response record; other records give none.

    Both refer to the response's id. The metadata block (warc-fields) keeps the response's date, record
    and HTTP headers, digests, title and links count; the conversion block is the page's plain text. A
    response without payload has an empty text. Repeated responses give repeated records.
    """
    check_columns(records, RECORD.names)

    def convert(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for row in _rows(batch):
            status, headers, body = split_http(row["block"] or b"")
            kind = dict((k.lower(), v) for k, v in headers).get("content-type", "")
            charset = (re.search(r"charset=[\"']?([\w.-]+)", kind) or [None, "utf-8"])[1]
            try:
                page = body.decode(charset, "replace")
            except LookupError:
                page = body.decode("utf-8", "replace")
            text = plain_text(page).encode()
            title = _TITLE.search(page)
            source, uri, date = row["record_id"], row["target_uri"] or "", row["warc_date"] or ""
            paid = row["payload_digest"] or digest(body)
            conversion = record_urn("conversion", source or "", paid)
            fields = [("sourceRecordId", source), ("sourceTargetURI", uri), ("sourceDate", date),
                      ("sourceBlockDigest", row["block_digest"] or digest(row["block"] or b"")),
                      ("sourcePayloadDigest", paid), ("derivedConversion", conversion), ("httpStatus", status),
                      *[(f"http-{k}", v) for k, v in headers],
                      *[(f"warc-{k}", v) for k, v in sorted(row["extra_headers"].items())],
                      ("title", " ".join(html.unescape(title[1]).split()) if title else ""),
                      ("outlinks", str(len(re.findall(r"<a\s[^>]*href\s*=", page, re.I))))]
            block = "".join(f"{k}: {v if v is not None else ''}\r\n" for k, v in fields).encode("utf-8", "replace")
            of_source = {"WARC-Source-Payload-Digest": paid}
            out.append(_record(row["page_id"], "metadata", record_urn("metadata", source or "", paid), source, uri,
                               date, "application/warc-fields", block, None, of_source))
            out.append(_record(row["page_id"], "conversion", conversion, source, uri, date,
                               "text/plain; charset=utf-8", text, None, of_source))
        return out

    return _mapped(records.where(F.col("record_type") == "response").select(*RECORD.names), convert)


# -- files ------------------------------------------------------------------------------------------


def serialise(row: dict) -> bytes:
    lines = ["WARC/1.1"]
    lines += [f"{name}: {row[column]}" for column, name in HEADERS.items() if row[column] is not None]
    lines += [f"{k}: {v}" for k, v in row["extra_headers"].items()]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + (row["block"] or b"") + b"\r\n\r\n"


def write(records: DataFrame, folder: str) -> int:
    """Writes a gzip file per task, a member per record, below ``folder``; returns the number of records."""
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        number, many = TaskContext.get().partitionId(), 0
        store.create_dir(path, recursive=True)
        new = os.path.join(path, f".{number:06d}-{uuid.uuid4().hex}")
        with store.open_output_stream(new) as stream:
            for batch in batches:
                for row in _rows(batch):
                    stream.write(gzip.compress(serialise(row), 6, mtime=0))
                    many += 1
        store.move(new, os.path.join(path, f"{number:06d}.warc.gz"))
        yield pa.RecordBatch.from_arrays([pa.array([many])], names=["n"])

    return sum(r[0] for r in arrow_map(records.select(*RECORD.names), put, "n bigint").collect())  # one row a file


def _members(content: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of a file, read in pieces, so that what follows a member is not copied for each."""
    held, at = memoryview(content), 0
    while at < len(held):
        member, parts = zlib.decompressobj(31), []
        while not member.eof and at < len(held):
            parts.append(member.decompress(held[at: at + step]))
            at = min(at + step, len(held))
        at -= len(member.unused_data)
        yield b"".join([*parts, member.flush()])


def parse(data: bytes) -> Iterator[tuple]:
    """Records of one file's bytes; known headers become columns, others stay in ``extra_headers``."""
    columns = {name.lower(): column for column, name in HEADERS.items()}
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        found, extra = dict.fromkeys(HEADERS), {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            if name.lower() in columns:
                found[columns[name.lower()]] = value.strip()
            else:
                extra[name] = value.strip()
        size = int(found.pop("content_length") or 0)
        block = data[end + 4: end + 4 + size]
        page = extra.pop("X-Page-Id", None)
        yield (int(page) if page and page.lstrip("-").isdigit() else None, found["record_type"], found["record_id"],
               found["refers_to"], found["target_uri"], found["warc_date"], found["content_type"], len(block),
               found["block_digest"], found["payload_digest"], list(extra.items()), block)
        at = end + 4 + size


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all ``.warc`` and ``.warc.gz`` files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc{,.gz}").load(folder)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for data in _members(content) if content[:2] == b"\x1f\x8b" else [content]:
                    rows.extend(parse(data))
                    if len(rows) >= 500:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    return arrow_map(files.select("content"), convert, RECORD)
