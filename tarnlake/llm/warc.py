"""WARC archives with an index: written from pages, read back by byte ranges.

The index comes first: every record's archive, offset, length, URL and payload digest. Records are chosen on
the index, which is small; the chosen ones are sorted by place, and neighbours in an archive are fetched in
one read. An archive is a file of gzip members, one per record, so any record can be read by itself.

Pages with equal payloads are stored once: the one with the smallest id as a `response`, the others as
`revisit` records that name it and hold no payload. Archives get unique names, so a task that runs twice
leaves at worst a file that no index names. Digests are checked when a payload is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tarnlake.llm.common import arrow_map, staged, work_path

ARCHIVE_BYTES = 1 << 28       # an archive is closed once it is this large
RANGE_BYTES = 1 << 23         # most bytes fetched by one read, unless one record is larger
TASK_BYTES = 1 << 27          # archive bytes a task reads at most, roughly
GAP_BYTES = 1 << 16           # unwanted bytes worth reading over
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ["archive", "offset", "length", "url", "payload_digest", "record_type", "page_id"]
_READ = [("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())]


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: str) -> str:
    return f"<urn:page:{page_id}>"


def _safe(value: str) -> str:
    """A header value on one line: blanks and control characters as percent escapes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def _response_id(page_id: str, own: str) -> str:
    """Record id of the response for a page's payload: it follows from both, so that revisits can name it wherever they are written."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{_urn(page_id)} sha1:{own}')}>"


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, is_response: bool) -> tuple[bytes, str]:
    """One compressed record, and the digest of its payload. A revisit keeps the HTTP head, which tells the payload's size, and names the
    response's record and its page."""
    own = digest(payload)
    known = is_response and page_id is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if is_response else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if is_response else 'revisit'}", f"WARC-Record-ID: {_response_id(page_id, own) if known else f'<urn:uuid:{uuid.uuid4()}>'}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{own}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {_urn(page_id)}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    if not is_response:
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        if refers_to is not None:
            head += [f"WARC-Refers-To: {_response_id(refers_to, own)}", f"WARC-Refers-To-Page: {_urn(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush(), own


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, first_id, is_response in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    data, own = record(page_id, url, html.encode(), first_id, is_response)
                    out.write(data)
                    rows.append((name, at, len(data), url, own, "response" if is_response else "revisit", page_id))
                    at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows) if rows else [[]] * len(INDEX),
                    [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4])], INDEX)
        finally:
            if out is not None:
                out.close()
    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Write a record per row of `pages` (page_id, url, html); gives the folder and the index, a stored table.

    Payload is the html in UTF-8; null counts as empty. Payloads of fewer than `min_bytes` bytes are all responses. Rows that share the smallest
    id of a payload are all responses; rows without an id revisit it, or are responses where no row has one.
    Null URLs have no header. Other columns are not read. An empty table gives an empty index.

    Rows meet by digest to learn the first id of their payload. A payload that very many pages share makes a
    large group; it is aggregated before the shuffle, and as the ids are a stored table, the join is one that Spark splits.
    """
    folder = folder or work_path(pages.sparkSession, "warc")
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    firsts = staged(keyed.groupBy("sha").agg(F.min("page_id").alias("first_id")), "warc-firsts")
    is_response = F.col("page_id").eqNullSafe(F.col("first_id")) | (F.octet_length("html") < min_bytes)
    rows = keyed.join(firsts, "sha").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html", F.col("first_id").cast("string").alias("first_id"),
        is_response.alias("is_response"))
    text = {"offset": LongType(), "length": LongType()}
    schema = StructType([StructField(c, text.get(c, StringType())) for c in INDEX])
    return folder, staged(arrow_map(rows, _writer(folder, archive_bytes), schema), "warc-index")


def parse(member: bytes) -> dict:
    """One record as a dictionary; raises if it is damaged or its payload does not fit its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    own, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest(payload) != own):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")

    def page(name: str) -> str | None:
        return fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else None

    return {"page_id": page("WARC-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": own,
            "record_type": kind, "refers_to": page("WARC-Refers-To-Page"), "payload": payload if kind == "response" else None}


def ranges(rows: Iterator[tuple[str, int, int]], range_bytes: int, gap_bytes: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(archive, start, end, records) of the reads for records sorted by place. A record named twice is read once and given twice."""
    now: tuple | None = None
    for archive, offset, length in rows:
        end = offset + length
        if now and now[0] == archive and offset <= now[2] + gap_bytes and max(end, now[2]) - now[1] <= range_bytes:
            now[3].append((offset, length))
            now = (archive, now[1], max(end, now[2]), now[3])
            continue
        if now:
            yield now
        now = (archive, offset, end, [(offset, length)])
    if now:
        yield now


def _reader(folder: str, with_payload: bool, range_bytes: int, gap_bytes: int):
    fields = [f for f in _READ if with_payload or f[0] != "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(folder)
        places = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        opened, name = None, ""
        for archive, start, end, records in ranges(places, range_bytes, gap_bytes):
            if archive != name:
                if opened is not None:
                    opened.close()
                opened, name = system.open_input_file(f"{base}/{archive}"), archive
            data = opened.read_at(end - start, start)
            got = [parse(data[o - start:o - start + n]) for o, n in records]
            yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in got], t) for f, t in fields], [f for f, _ in fields])
        if opened is not None:
            opened.close()
    return run


def read_records(folder: str, chosen: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES,
                 gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records of the chosen index rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Ids are text. Index rows are dealt out by archive and stretch of at most `range_bytes`, so the work spreads
    evenly however few archives there are, and over as many tasks as the archives' bytes ask for, not the index's: their sum is looked up when this
    is called. A revisit's payload is null; that of the page it refers to is the same.
    """
    total = chosen.agg(F.sum("length")).first()[0] or 0
    wide = 4 * chosen.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-total // TASK_BYTES), min(wide, total >> 20))
    stretch = max(1, min(range_bytes, total // (4 * tasks)))
    places = (
        chosen.select("archive", "offset", "length")
        .repartition(tasks, F.col("archive"), F.expr(f"offset div {stretch}L"))
        .sortWithinPartitions("archive", "offset"))
    kinds = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    schema = ", ".join(f"{n} {kinds[t]}" for n, t in _READ if with_payload or n != "payload")
    return arrow_map(places, _reader(folder, with_payload, range_bytes, gap_bytes), schema)
