"""WARC derivatives: response records become linked metadata and plain-text conversion records (operator 2).

A response gives a ``metadata`` record (application/json: the source's WARC headers, HTTP status and headers, title and
links) and a ``conversion`` record (text/plain). Both name the response in WARC-Refers-To, keep its target URI and date,
and carry digests of their own block and payload; the conversion also names its metadata record as concurrent. Record
ids are name-based on the response's id, so a repeated task makes equal records.

Header names are read whatever their case, folded lines are joined, and a header that repeats keeps all its values, in
order (a list in the JSON). The body is read without its chunks and decompressed (gzip, deflate); a body of another or a
broken coding gives what could be read. A payload digest may be of the body with its chunks or without them.

Files hold one gzip member per record. They are read as streams, record by record, so no task holds a file. Writers use
a name of the attempt and then rename. Defined results: null html is an empty page and a null url the empty target;
repeated pages give records with ids of their own (by file and place); digests that do not fit their block are reported
in ``sound``, not dropped; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import scratch_path, ship, slices, table
from tidegate.llm.token_files import open_store

DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public name space for URLs
_READ = 1 << 18
_SILENT = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)|<title\b[^>]*>.*?(?:</title\s*>|\Z)")
_BREAK = re.compile(r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*>")
_TAG = re.compile(r"</?[a-zA-Z][^>]*(?:>|\Z)|<![^>]*>|<\?[^>]*>")
_LINK = re.compile(r"""(?i)<(?:a|link|img|iframe|area|source)\b[^>]*?\b(?:href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_TITLE = re.compile(r"(?is)<title\b[^>]*>(.*?)(?:</title\s*>|\Z)")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join(names))}>"


def record(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member without a time stamp, so equal records are equal bytes."""
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Headers(list):
    """Pairs of name and value in order; names are the same whatever their case."""

    @classmethod
    def read(cls, lines: list[str]) -> Headers:
        out = cls()
        for line in lines:
            if line[:1] in (" ", "\t") and out:
                out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}".strip())
            elif ":" in line:
                name, value = line.split(":", 1)
                out.append((name.strip(), value.strip()))
        return out

    def get(self, name: str, default: str = "") -> str:
        return next((v for k, v in self if k.lower() == name.lower()), default)

    def as_json(self) -> dict:
        """Each name as it was first written, with its value or the list of its values."""
        values: dict[str, list[str]] = {}
        names: dict[str, str] = {}
        for k, v in self:
            values.setdefault(names.setdefault(k.lower(), k), []).append(v)
        return {k: v[0] if len(v) == 1 else v for k, v in values.items()}


def response(name: str, url: str, page: str, date: str = DATE) -> bytes:
    payload = page.encode("utf-8")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    headers = {
        "WARC-Type": "response",
        "WARC-Target-URI": re.sub(r"[\r\n]+", " ", url),
        "WARC-Date": date,
        "WARC-Record-ID": record_id("response", name, url),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": digest(payload),
        "WARC-Block-Digest": digest(block),
    }
    return record(headers, block)


def unchunked(body: bytes) -> bytes:
    """The body without its chunk lines, as far as they can be read."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            break
        if not size:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


def decompressed(body: bytes, coding: str) -> bytes:
    kind = coding.strip().lower()
    if kind not in ("gzip", "x-gzip", "deflate"):
        return body if kind in ("", "identity") else b""
    for bits in (47, -15) if kind == "deflate" else (47,):
        z = zlib.decompressobj(bits)
        out = []
        try:
            for at in range(0, len(body), _READ):  # what stands before a fault is kept
                out.append(z.decompress(body[at : at + _READ]))
        except zlib.error:
            if not any(out):
                continue
        return b"".join(out)
    return b""


def _bytes_of(source) -> Iterator[bytes]:
    """Plain bytes of a stream of gzip members, or of an uncompressed one."""
    start = source.read(_READ)
    if start[:2] != b"\x1f\x8b":
        while start:
            yield start
            start = source.read(_READ)
        return
    z = zlib.decompressobj(31)
    while start:
        yield z.decompress(start)
        start = z.unused_data if z.eof else b""
        if z.eof:
            z = zlib.decompressobj(31)
        if not start:
            start = source.read(_READ)


def read_records(source) -> Iterator[tuple[Headers, bytes]]:
    """(headers, block) of each record; a cut last record raises ValueError."""
    pieces, held = _bytes_of(source), bytearray()

    def need(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        while need(2) and held[:2] == b"\r\n":
            del held[:2]
        if not need(1):
            return
        size = len(held)
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not need(size + 1):
                raise ValueError("a record's headers are cut")
            size = len(held)
        lines = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
        del held[: end + 4]
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = Headers.read(lines[1:])
        length = int(headers.get("Content-Length", "0"))
        if not need(length):
            raise ValueError("a record's block is cut")
        yield headers, bytes(held[:length])
        del held[:length]


def plain_text(page: str) -> str:
    text = _TAG.sub("", _BREAK.sub("\n", _SILENT.sub(" ", page).replace("\n", " ").replace("\r", " ")))
    lines = (" ".join(x.split()) for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def derive(headers: Headers, block: bytes) -> dict:
    """The metadata and conversion records of a response, and what they say."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *rest = head.decode("latin-1").split("\r\n")
    http = Headers.read(rest)
    body, whole = payload, {digest(payload)}
    if "chunked" in http.get("Transfer-Encoding").lower():
        body = unchunked(payload)
        whole.add(digest(body))
    for coding in reversed(http.get("Content-Encoding").split(",")):
        body = decompressed(body, coding)
    kind = http.get("Content-Type")
    charset = re.search(r"charset=[\"']?([\w-]+)", kind, re.I)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    source, target, date = headers.get("WARC-Record-ID"), headers.get("WARC-Target-URI"), headers.get("WARC-Date")
    sound = headers.get("WARC-Payload-Digest", digest(payload)) in whole and headers.get("WARC-Block-Digest", digest(block)) == digest(block)
    title = _TITLE.search(page)
    title = " ".join(html.unescape(title[1]).split()) if title else ""
    links = [html.unescape("".join(x)) for x in _LINK.findall(_SILENT.sub(" ", page))]
    code = status.split(" ")[1] if status.startswith("HTTP/") and " " in status else ""
    about = {"Envelope": {"WARC-Header-Metadata": headers.as_json(), "HTTP-Response-Metadata": {"Status": code, "Headers": http.as_json()}, "HTML-Metadata": {"Title": title, "Links": links}}}
    about_block = json.dumps(about, ensure_ascii=False).encode("utf-8")
    text = plain_text(page)
    text_block = text.encode("utf-8")
    metadata_id, conversion_id = record_id("metadata", source), record_id("conversion", source)
    shared = {"WARC-Target-URI": target, "WARC-Date": date, "WARC-Refers-To": source}
    metadata = {"WARC-Type": "metadata", **shared, "WARC-Record-ID": metadata_id, "Content-Type": "application/json", "WARC-Block-Digest": digest(about_block)}
    conversion = {"WARC-Type": "conversion", **shared, "WARC-Concurrent-To": metadata_id, "WARC-Record-ID": conversion_id, "Content-Type": "text/plain", "WARC-Block-Digest": digest(text_block), "WARC-Source-Payload-Digest": digest(payload)}
    return {
        "refers_to": source, "target_uri": target, "warc_date": date, "source_digest": digest(payload), "sound": sound, "http_status": int(code) if code.isdigit() else None,
        "content_type": kind, "metadata_id": metadata_id, "metadata_digest": metadata["WARC-Block-Digest"], "n_links": len(links), "title": title,
        "conversion_id": conversion_id, "conversion_digest": conversion["WARC-Block-Digest"], "text": text, "records": record(metadata, about_block), "conversion": record(conversion, text_block),
    }


SCHEMA = (
    "refers_to string, target_uri string, warc_date string, source_digest string, sound boolean, http_status int, content_type string, metadata_id string, "
    "metadata_digest string, n_links int, title string, conversion_id string, conversion_digest string, text string"
)


def write_responses(pages: DataFrame, folder: str) -> DataFrame:
    """One WARC file per partition of (page_id, url, html); the list of files (path, n_records)."""
    ship(pages.sparkSession)
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = open_store(folder)
        name, out, n = f"{root}/responses-{TaskContext.get().partitionId():06d}.warc.gz", None, 0
        attempt = f"{name}.{uuid.uuid4().hex}"
        for batch in slices(batches):
            for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Written by our own code, one gzip member a record: the store must not compress again.
                out = out or store.open_output_stream(attempt, compression=None)
                out.write(member(response(f"{page_id} {name.rpartition('/')[2]} {n}", url or "", page or "")))
                n += 1
        if out:
            out.close()
            store.move(attempt, name)
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": pa.array([n], pa.int64())})

    taken = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), F.col("html").cast("string"))
    return table(taken.mapInArrow(run, "path string, n_records long"), "warc-files")


def derivatives(files: DataFrame, folder: str, write_to: str | None = None) -> DataFrame:
    """A row for each response of ``files`` (path), with its derivatives' ids, digests and text.

    With ``write_to``, both records of each response are also written there, one file per input file.
    """
    ship(files.sparkSession)
    if write_to:
        store, root = open_store(write_to)
        store.create_dir(root, recursive=True)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = {"sound": pa.bool_(), "http_status": pa.int32(), "n_links": pa.int32()}
    schema = pa.schema([(x, kinds.get(x, pa.string())) for x in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size, out = [], 0, None
                if write_to:
                    target, root = open_store(write_to)
                    name = f"{root}/derived-{path.rpartition('/')[2]}"
                    attempt = f"{name}.{uuid.uuid4().hex}"
                    out = target.open_output_stream(attempt, compression=None)
                with store.open_input_stream(path, compression=None) as source:
                    for headers, block in read_records(source):
                        if headers.get("WARC-Type").lower() != "response":
                            continue
                        made = derive(headers, block)
                        for x in (made.pop("records"), made.pop("conversion")):
                            if out:
                                out.write(member(x))
                        rows.append(made)
                        size += len(block)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if out:
                    out.close()
                    target.move(attempt, name)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, files.count())
    return files.select("path").repartition(n, "path").mapInArrow(run, SCHEMA)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC responses, their derivatives written as WARC files, and a row for each response."""
    folder = scratch_path(spark, "warc")
    files = write_responses(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return derivatives(files, folder, f"{folder}/derived")
