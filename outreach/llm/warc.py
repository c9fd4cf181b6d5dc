"""WARC archives of pages, written index first and read by coalesced byte ranges.

Each task writes gzip members, one per record, to archive files of its own in a folder
that all executors share, and returns one index row per record: file, offset, length, url,
payload digest. Only the index says what belongs to the archive, so files that a failed or
repeated task left behind are never read. Reading starts from index rows: they are dealt
by file and range, sorted, neighbouring ranges are joined to one read, and each record is
checked against its digest.

Equal payloads are stored once: the page with the largest id is a response, the others
are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import rows_of
from outreach.sources.staging import stage

FILE_BYTES = 1 << 30
RANGE_BYTES = 8 << 20  # most that one read fetches, a longer record aside
GAP_BYTES = 64 << 10  # bytes between records worth reading over
LEAST_BYTES = 0  # smaller payloads are stored as they are
DATE = "2000-01-01T00:00:00Z"
_SPACE = uuid.UUID("9d0f6d0a-7f3c-5c61-9a0b-2f2d2a6b8f11")

_INDEX = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
          "file string, offset long, length long")
_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
])


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{payload_digest}')}>"


def _header_value(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit holds no payload."""
    own = digest(payload)
    revisit = refers_to is not None
    body = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, own)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{own}", f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(body)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to, own)}", f"X-Refers-To-Page: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(headers["Content-Length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def _zip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, out, offset = "", None, 0
        try:
            for batch in rows_of(batches, 500):
                rows = []
                columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")]
                for page_id, url, payload, refers_to in zip(*columns):
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        info = _zip(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                                    % (str(uuid.uuid4()).encode(), date.encode()))
                        out.write(info)
                        offset = len(info)
                    data = _zip(record(page_id, url, payload, refers_to, date))
                    out.write(data)
                    kind = "response" if refers_to is None else "revisit"
                    rows.append((page_id, url, kind, refers_to, len(payload), digest(payload), name, offset, len(data)))
                    offset += len(data)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
        finally:
            if out is not None:
                out.close()

    return run


def repeats(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, sha, refers_to of the rows whose payload another page stores."""
    keys = pages.where(F.octet_length("payload") >= least_bytes).select("page_id", F.sha1("payload").alias("sha"))
    stored = keys.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    later = keys.join(stored.select("sha", "refers_to"), "sha")
    return later.where(F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))).distinct()


def write_archive(pages: DataFrame, path: str, *, least_bytes: int = LEAST_BYTES, date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) below `path` and return the index, which is
    written there too as parquet.

    Null html is an empty payload. Rows without page_id are stored, as revisits where a
    page with an id has their payload. Rows that repeat the id that is stored are
    responses of their own. Further columns are ignored. No pages give an empty index.
    """
    spark = pages.sparkSession
    root = path if "://" in path or path.startswith("/") else f"/{path}"
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    again = stage(repeats(rows, least_bytes)).withColumnsRenamed({"page_id": "_page", "sha": "_sha"})
    marked = rows.join(again, rows["page_id"].eqNullSafe(again["_page"]) & (F.sha1("payload") == again["_sha"]), "left")
    fs, folder = pyarrow.fs.FileSystem.from_uri(root)
    fs.create_dir(f"{folder}/data", recursive=True)
    written = marked.select("page_id", "url", "payload", "refers_to").mapInArrow(_writer(f"{root}/data", date, file_bytes), _INDEX)
    written.write.parquet(f"{root}/index")
    return spark.read.schema(written.schema).parquet(f"{root}/index")


def _reader(folder: str, range_bytes: int, gap_bytes: int):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def ranges(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        """Rows whose records one read fetches together."""
        own: list[tuple] = []
        for row in rows:
            if own and (row[0] != own[0][0] or row[1] > own[-1][1] + own[-1][2] + gap_bytes or row[1] + row[2] - own[0][1] > range_bytes):
                yield own
                own = []
            own.append(row)
        if own:
            yield own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, source = None, None

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length", "payload_digest")])

        for own in ranges(rows()):
            if own[0][0] != name:
                if source is not None:
                    source.close()
                name = own[0][0]
                source = fs.open_input_file(f"{root}/{name}")
            start = own[0][1]
            data = source.read_at(own[-1][1] + own[-1][2] - start, start)
            out = []
            for _, offset, length, wanted in own:
                headers, payload = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                kind, said = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if said != wanted or (kind == "response" and digest(payload) != said):
                    raise ValueError(f"damaged record in {name} at {offset}")
                page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                out.append((int(page) if page else None, headers.get("WARC-Target-URI"), kind, int(refers) if refers else None,
                            int(headers["X-Payload-Length"]), said, payload if kind == "response" else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if source is not None:
            source.close()

    return run


def read_records(selected: DataFrame, path: str, *, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records that rows of an index name: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, payload (null for revisits). A damaged record is an error."""
    root = path if "://" in path or path.startswith("/") else f"/{path}"
    near = F.floor(F.col("offset") / range_bytes)
    dealt = selected.select("file", "offset", "length", "payload_digest").repartition(F.col("file"), near).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(
        _reader(f"{root}/data", range_bytes, gap_bytes),
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary",
    )
