"""WARC archives as seekable Zstandard bundles, and reading records back by their index.

A bundle is a row of Zstandard frames, each of some whole records, and a skippable frame with
the seek table: the compressed and the full size of each frame. The index leads from a record's
identifier to the bundle, the frame's number and the record's place in the unpacked frame, so one
record costs the reading of the table and of one frame.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import fresh_folder, settle, text_bytes

#: Bytes of payload from which equal ones are stored once.
MIN_SHARED = 1000
#: Bytes of records after which a frame, and of frames after which a bundle, is closed.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
LEVEL = 3
#: No date is known of a page; all records carry this one.
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")

_INDEX = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("bundle", pa.string()),
        ("frame", pa.int32()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
#: Bytes of records that a task reads back, about.
READ_BYTES = 1 << 25

_INDEX_DDL = (
    "record_id string, page_id bigint, bundle string, frame int, offset bigint, length bigint"
)
_RECORDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
_RECORDS_DDL = (
    "record_id string, page_id bigint, url string, record_type string, refers_to bigint,"
    " payload_bytes bigint, payload_digest string, payload binary"
)


def record_id(page_id: int | None) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}"


def record(
    page_id: int | None,
    url: str | None,
    payload: bytes | None,
    size: int,
    digest: str,
    refers_to: int | None,
) -> bytes:
    """One WARC record: a response with its payload, or a revisit of ``refers_to`` without."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http + (payload or b"") if refers_to is None else http
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{record_id(page_id)}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = re.sub(
            "[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url
        )
    if page_id is not None:
        fields["Page-ID"] = str(page_id)
    if refers_to is not None:
        fields["WARC-Refers-To"] = f"<{record_id(refers_to)}>"
        fields["WARC-Profile"] = PROFILE
        fields["Refers-To-Page-ID"] = str(refers_to)
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record says; the size and digest of a response come from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(fields[name]) if name in fields else None
    found = {
        "record_id": fields["WARC-Record-ID"].strip("<>"),
        "page_id": number("Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("Refers-To-Page-ID"),
    }
    if found["record_type"] == "response":
        return found | {
            "payload_bytes": len(payload),
            "payload_digest": hashlib.sha1(payload).hexdigest(),
            "payload": payload,
        }
    return found | {
        "payload_bytes": int(re.search(rb"\r\nContent-Length: (\d+)", http)[1]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": None,
    }


class Bundle:
    """A bundle being written to ``path`` of a file system."""

    def __init__(self, files: pa.fs.FileSystem, path: str):
        self.path = path
        self.out = files.open_output_stream(path, compression=None)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.records = bytearray()
        self.written = 0

    def add(self, raw: bytes) -> tuple[int, int]:
        """Take a record; its frame's number and its offset there."""
        place = len(self.frames), len(self.records)
        self.records += raw
        if len(self.records) >= FRAME_BYTES:
            self.close_frame()
        return place

    def close_frame(self) -> None:
        if self.records:
            packed = self.pack.compress(bytes(self.records))
            self.out.write(packed)
            self.written += len(packed)
            self.frames.append((len(packed), len(self.records)))
            self.records.clear()

    def close(self) -> None:
        self.close_frame()
        body = b"".join(ENTRY.pack(*frame) for frame in self.frames)
        body += FOOTER.pack(len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


def seek_table(bundle: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(place, compressed size, full size) of each frame, from the footer of a bundle."""
    end = bundle.size()
    count, _, magic = FOOTER.unpack(bundle.read_at(FOOTER.size, end - FOOTER.size))
    if magic != SEEKABLE:
        raise ValueError("the file has no seek table")
    size = count * ENTRY.size
    table = bundle.read_at(size, end - FOOTER.size - size)
    found, place = [], 0
    for packed, full in ENTRY.iter_unpack(table):
        found.append((place, packed, full))
        place += packed
    return found


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        bundle = None
        for batch in batches:
            rows = []
            for page_id, url, payload, size, digest, refers_to in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if bundle is None:  # a name that a second try of this task does not use again
                    bundle = Bundle(files, f"{root}/{uuid.uuid4().hex}.warc.zst")
                raw = record(page_id, url, payload, size, digest, refers_to)
                frame, offset = bundle.add(raw)
                name = bundle.path.rpartition("/")[2]
                rows.append((record_id(page_id), page_id, name, frame, offset, len(raw)))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            columns = list(zip(*rows, strict=True)) or [[] for _ in _INDEX]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _INDEX, strict=True)], schema=_INDEX
            )
        if bundle is not None:
            bundle.close()

    return write


def write_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write a record of each row to bundles in ``folder``; their index.

    ``folder`` is a URI that all machines share and that pyarrow can write. Of rows with equal
    payloads of at least ``MIN_SHARED`` bytes, those with the largest id are responses, the
    others revisit it; so rows repeated as a whole are alike. A null payload is empty, a row
    without an id is a response. An empty table writes no bundle. Each task writes bundles of
    its own under new names; the index is settled before it is returned, so a task that is run
    again leaves at most a file that nothing refers to.
    """
    whole = pages.select(
        F.col(id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        text_bytes(html).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    shared = F.octet_length("payload") >= MIN_SHARED
    latest = (
        whole.filter(shared)
        .groupBy("digest")
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("same"), "latest")
    )
    joined = whole.join(latest, F.col("digest") == F.col("same"), "left")
    refers_to = F.when(F.col("page_id") < F.col("latest"), F.col("latest"))
    records = joined.select(
        "page_id",
        "url",
        F.when(refers_to.isNull(), F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("size"),
        "digest",
        refers_to.alias("refers_to"),
    )
    return settle(records.mapInArrow(_write(folder), _INDEX_DDL))


def _read(folder: str, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        name = source = table = unpacked = at = None
        for batch in batches:
            rows, held = [], 0
            for bundle, frame, offset, length in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if bundle != name:
                    name, at = bundle, None
                    source = files.open_input_file(f"{root}/{bundle}")
                    table = seek_table(source)
                if frame != at:
                    place, packed, full = table[frame]
                    raw = source.read_at(packed, place)
                    at, unpacked = frame, unpack.decompress(raw, max_output_size=full)
                    if len(unpacked) != full:
                        raise ValueError(f"{bundle}: frame {frame} is broken")
                found = parse(unpacked[offset : offset + length])
                if not with_payload:
                    found["payload"] = None
                rows.append(found)
                held += length
                if with_payload and held >= 1 << 24:
                    yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    return read


def read_archives(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name: a row each, revisits without payload.

    Frames are dealt out, so each is unpacked once and a large bundle is read by many tasks; how
    many, the bytes of the records decide.
    """
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    places = (
        index.select("bundle", "frame", "offset", "length")
        .repartition(max(1, -(-size // READ_BYTES)), "bundle", "frame")
        .sortWithinPartitions("bundle", "frame", "offset")
    )
    return places.mapInArrow(_read(folder, with_payload), _RECORDS_DDL)


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read from archives.

    They are written to a new folder below the shared one.
    """
    folder = fresh_folder(pages.sparkSession, "warc")
    if ":" not in folder:
        folder = f"file://{folder}"
    records = read_archives(write_archives(pages, folder), folder, with_payload=False)
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


#: What ``round_trip`` must read back, for engines without Spark.
SQL = f"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest
  FROM pages
),
latest AS (
  SELECT digest, max(page_id) AS latest FROM payloads WHERE n >= {MIN_SHARED} GROUP BY digest
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id < latest AND n >= {MIN_SHARED} THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN page_id < latest AND n >= {MIN_SHARED} THEN latest END AS refers_to
FROM payloads LEFT JOIN latest USING (digest)
"""
