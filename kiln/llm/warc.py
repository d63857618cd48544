"""WARC derivative builder.

``capture`` puts pages into WARC files under the shared folder as responses (a
gzip member for each record, files of at most ``FILE_BYTES`` of records);
``read_warc`` reads such files, a task for each, as rows. ``build_derivatives``
turns every response into two linked records: ``metadata``
(application/warc-fields: status, source headers, title, links) and
``conversion`` (the page's plain text). Both carry the response's identifier as
WARC-Refers-To, its target URI, date and payload digest, and digests of their own
blocks. The work is narrow: a response's derivatives are made and written in the
task that reads it. ``responses``, ``derive`` and ``write_warc`` are the same
steps over rows, for records that come from or go elsewhere.

Record identifiers are name-based UUIDs of what they name, so a task that runs
again, or a second run, makes the same records.

A page with null or empty html is a response without payload: its conversion
is empty. A null URL stays null and its record has no target URI. Repeated pages
are responses each, with the same identifier. Html is read as UTF-8. A head ends
where its elements do, closed or not; a comment or script that doesn't close runs
to the end, any other unclosed markup is text. A very long page is one record and is held
in memory by itself. Records of other types pass ``derive`` by. An empty table gives
no files and no rows. ``page_id``, ``url`` and ``html`` are read only; columns of other names do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import saved
from kiln.llm.files import open_file, write_whole
from kiln.session import scratch_dir

DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 64 << 20
LEVEL = 1
RECORD = "id string, type string, headers map<string,string>, block binary"
_FILE = "file string, n long, bytes long"
_BATCH_BYTES = 4 << 20


# ---------------------------------------------------------------- records
_URL_SPACE = uuid.NAMESPACE_URL.bytes


def record_id(*name: object) -> str:
    """A version 5 UUID of the name, as a URN."""
    h = bytearray(hashlib.sha1(_URL_SPACE + "\0".join(map(str, name)).encode(), usedforsecurity=False).digest()[:16])
    h[6] = h[6] & 0x0F | 0x50
    h[8] = h[8] & 0x3F | 0x80
    x = h.hex()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}>"


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_bytes(rid: str, kind: str, headers: dict[str, str], block: bytes) -> bytes:
    fields = "".join([f"{k}: {_one_line(v)}\r\n" for k, v in headers.items()])
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n{fields}Content-Length: {len(block)}\r\n\r\n"
    return b"".join((head.encode(), block, b"\r\n\r\n"))


def _one_line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value) if "\n" in value or "\r" in value else value


def parse_record(data: bytes) -> tuple[str, str, dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(fields.pop("Content-Length"))]
    return fields.pop("WARC-Record-ID"), fields.pop("WARC-Type"), fields, block


def http_parts(block: bytes) -> tuple[int, list[tuple[str, str]], bytes]:
    """Status, headers and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    status = re.match(r"HTTP/\S+ (\d+)", lines[0])
    return int(status[1]) if status else 0, [tuple(x.split(": ", 1)) for x in lines[1:] if ": " in x], payload


# ---------------------------------------------------------------- plain text
#: A head holds only these; anything else ends it, whether it is closed or not.
_HEAD = (r"<head\b[^>]*>(?:\s+|<!--.*?-->|<(?:meta|link|base)\b[^>]*>|<title\b[^>]*>.*?</title\s*>"
         r"|<(?P<of_head>script|style|noscript|template)\b[^>]*>.*?</(?P=of_head)\s*>)*+(?:</head\s*>)?")
_DROP = re.compile(r"(?is)<!--.*?(?:-->|\Z)|" + _HEAD + r"|<(?P<name>script|style|noscript|template|svg)\b[^>]*>.*?(?:</(?P=name)\s*>|\Z)|<![a-z][^>]*>")
_BLOCK = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|main|aside|blockquote|pre|hr|dl|dt|dd|form|figure|option|title|body|html)\b[^>]*>")
_TAG = re.compile(r"(?s)</?[a-zA-Z][^>]*>")
_TITLE = re.compile(r"(?is)<title[^>]*>(.*?)</title>")
_LINK = re.compile(r"""(?is)<a\b[^>]*?(?<![\w-])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")


def plain_text(page: str) -> str:
    """Text of a page: no scripts, styles, comments or tags; blocks on lines of their own, blanks folded."""
    text = _TAG.sub("", _BLOCK.sub("\n", _DROP.sub("", page)))
    lines = (" ".join(line.split()) for line in entities.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def title(page: str) -> str:
    found = _TITLE.search(page)
    return " ".join(entities.unescape(found[1]).split()) if found else ""


def links(page: str) -> list[str]:
    return [entities.unescape(a or b or c) for a, b, c in _LINK.findall(page)]


def derivatives(rid: str, headers: dict[str, str], block: bytes) -> list[tuple[str, str, dict[str, str], bytes]]:
    """The metadata and conversion records of a response."""
    status, source, payload = http_parts(block)
    page = payload.decode("utf-8", "replace")
    shared = {k: headers[k] for k in ("WARC-Target-URI", "WARC-Date") if k in headers} | {"WARC-Refers-To": rid}
    payload_digest = headers.get("WARC-Payload-Digest") or digest(payload)
    meta_id, text_id = record_id("metadata", rid), record_id("conversion", rid)
    fields = [("status", str(status)), *((f"source-{k.lower()}", v) for k, v in source), ("source-payload-digest", payload_digest),
              ("title", title(page)), ("conversion", text_id), *(("outlink", x) for x in links(page))]
    meta = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields).encode()
    text = plain_text(page).encode("utf-8", "replace")
    return [
        (meta_id, "metadata", shared | {"Content-Type": "application/warc-fields", "WARC-Block-Digest": digest(meta)}, meta),
        (text_id, "conversion", shared | {"Content-Type": "text/plain; charset=utf-8", "WARC-Source-Payload-Digest": payload_digest,
                                          "WARC-Block-Digest": digest(text)}, text)]


# ---------------------------------------------------------------- Spark jobs
def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
         pa.array([list(r[2].items()) for r in rows], pa.map_(pa.string(), pa.string())), pa.array([r[3] for r in rows], pa.binary())],
        names=["id", "type", "headers", "block"])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in ("id", "type", "headers", "block")))


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))


def _response(page_id: object, url: str | None, page: str | None, date: str) -> tuple:
    payload = (page or "").encode("utf-8", "surrogatepass")
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
             f"X-Page-Id: {'' if page_id is None else page_id}\r\n\r\n").encode() + payload
    payload_digest = digest(payload)
    headers = {"WARC-Date": date, "Content-Type": "application/http; msgtype=response",
               "WARC-Payload-Digest": payload_digest, "WARC-Block-Digest": digest(block)}
    if url is not None:
        headers["WARC-Target-URI"] = url
    return record_id("response", page_id, url, payload_digest), "response", headers, block


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """``pages`` (page_id, url, html) as response records, with the headers a crawler would have kept."""
    return pages.select("page_id", "url", "html").mapInArrow(
        lambda batches: _batches(_response(*p, date) for p in _pages(batches)), RECORD)


def capture(pages: DataFrame, folder: str, date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``write_warc(responses(pages))`` without taking the records out of the task between."""
    return _files(pages.select("page_id", "url", "html").mapInArrow(
        lambda batches: _written((_response(*p, date) for p in _pages(batches)), folder, file_bytes), _FILE))


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the responses among ``records``."""
    return records.mapInArrow(lambda batches: _batches(_derived(r for b in batches for r in _rows(b))), RECORD)


def _derived(records: Iterator[tuple]) -> Iterator[tuple]:
    for rid, kind, headers, block in records:
        if kind == "response":
            yield from derivatives(rid, dict(headers), block)


def _batches(records: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Records in batches of about ``_BATCH_BYTES``."""
    out, size = [], 0
    for r in records:
        out.append(r)
        size += len(r[3])
        if size > _BATCH_BYTES:
            yield _batch(out)
            out, size = [], 0
    yield _batch(out)


def _written(records: Iterator[tuple], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Write a task's records; a row for each file."""
    task = TaskContext.get()
    row, seq = next(records, None), 0
    while row is not None:
        name, n = f"part-{task.partitionId():06d}-{seq:04d}.warc.gz", 0

        def fill(out):
            nonlocal row, n
            plain = 0
            while row is not None and plain < file_bytes:
                data = record_bytes(row[0], row[1], dict(row[2]), row[3])
                out.write(zlib.compress(data, LEVEL, wbits=31))
                plain, n, row = plain + len(data), n + 1, next(records, None)

        size = write_whole(folder, name, str(task.taskAttemptId()), fill)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([size])], names=["file", "n", "bytes"])
        seq += 1


def _files(written: DataFrame) -> DataFrame:
    return saved(written, "warc-files")


def write_warc(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write records as .warc.gz files; returns ``file, n, bytes``, a row for each file."""
    return _files(records.mapInArrow(lambda batches: _written((r for b in batches for r in _rows(b)), folder, file_bytes), _FILE))


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple]:
    for batch in batches:
        for name in batch.column("file").to_pylist():
            with open_file(folder, name) as file:
                yield from map(parse_record, members(file))


def _each_file(files: DataFrame) -> DataFrame:
    return files.select("file").repartition(max(1, files.count()))


def read_warc(files: DataFrame, folder: str) -> DataFrame:
    """Records of the files named by ``file``, a member of a file at a time."""
    return _each_file(files).mapInArrow(lambda batches: _batches(_read(batches, folder)), RECORD)


def members(file, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, each decompressed by itself."""
    gz, out, data = zlib.decompressobj(31), [], b""
    while data or (data := file.read(size)):
        out.append(gz.decompress(data))
        data = gz.unused_data
        if gz.eof:
            yield b"".join(out)
            gz, out = zlib.decompressobj(31), []
        elif not data:
            data = file.read(size)
            if not data:
                raise ValueError("the file ends inside a record")


def build_derivatives(spark: SparkSession, files: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> tuple[DataFrame, str]:
    """Derivative files of the source files; returns their list and their folder."""
    out = scratch_dir(spark, "warc-derivatives")
    written = _each_file(files).mapInArrow(lambda batches: _written(_derived(_read(batches, folder)), out, file_bytes), _FILE)
    return _files(written), out


def _field(block: Column, name: str) -> Column:
    """The first value of a field of a metadata block; values have no line breaks."""
    return F.regexp_extract(block, rf"(?:\A|\r\n){name}: ([^\r]*)", 1)


def digests(derived: DataFrame) -> DataFrame:
    """A row for each pair of derivative records, from the read files alone: identifiers, digests and sizes.

    One pass over the records and one partial aggregate by the response they
    refer to. Repeated pages have equal records: each field's maximum is its
    value, and the pair comes back as often as the page was there.
    """
    fields = F.col("block").cast("string")
    h, meta, text = F.col("headers"), F.col("type") == "metadata", F.col("type") == "conversion"
    rows = derived.where(meta | text).select(
        h["WARC-Refers-To"].alias("refers_to"), h["WARC-Target-URI"].alias("url"), meta.alias("meta"),
        F.when(meta, F.col("id")).alias("metadata_id"), F.when(meta, h["WARC-Block-Digest"]).alias("metadata_digest"),
        F.when(text, F.col("id")).alias("conversion_id"), F.when(text, h["WARC-Block-Digest"]).alias("text_digest"),
        F.when(text, h["WARC-Source-Payload-Digest"]).alias("payload_digest"),
        F.when(text, F.length(F.col("block").cast("string"))).cast("long").alias("text_chars"),
        F.when(meta, F.nullif(_field(fields, "source-x-page-id"), F.lit(""))).alias("page_id"),
        F.when(meta, _field(fields, "title")).alias("title"),
        F.when(meta, F.regexp_count(fields, F.lit(r"\r\noutlink: "))).cast("long").alias("n_links"))
    names = [c for c in rows.columns if c not in ("refers_to", "meta")]
    pairs = rows.groupBy("refers_to").agg(F.count_if("meta").alias("n"), *(F.max(c).alias(c) for c in names))
    return pairs.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(
        F.col("page_id").cast("long").alias("page_id"), "url", "refers_to", "metadata_id", "conversion_id", "payload_digest",
        "metadata_digest", "text_digest", "text_chars", "n_links", "title")
