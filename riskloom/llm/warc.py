"""Web archives as seekable Zstandard bundles.

Every row becomes a WARC record. A task groups its records into frames that
are compressed on their own and ends each file with a seek table in a frame
that decoders skip, so a bundle is both one Zstandard stream and a random-access
file. An index maps record identifiers to file, frame and offset inside the
frame. Of records with equal payloads one is a response and the others revisits
that name it. Files get a fresh name in each attempt of a task and count only
if the index names them, so a lost executor leaves no half bundle behind.

Files are written and read below the shared folder by Arrow's file systems
(local, HDFS, object stores); input rows are read by Spark.
"""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import scratch_path

FRAME_BYTES = 256 << 10  # of records, before compression; a longer record is a frame of its own
BUNDLE_BYTES = 64 << 20  # of compressed frames in a file
LEVEL = 3
MOST_TASKS = 4096  # that read bundles; beyond it a task reads several
DATE = "1970-01-01T00:00:00Z"  # pages carry no time

# The seek table's frame and footer, and the profile of a revisit.
SKIPPABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, page_id bigint, file string, frame int, offset bigint, length bigint"


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"warc-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def record(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone, which keeps the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))  # a header is one line
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, start: int) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n", start)
    lines = data[start:end].decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:]), end + 4


def records(frame: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC headers, HTTP headers, payload) of every record of a decompressed frame."""
    at = 0
    while at < len(frame):
        head, start = _headers(frame, at)
        end = start + int(head["Content-Length"])
        http, body = _headers(frame, start)
        if frame[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record {head['WARC-Record-ID']} does not end where its header says")
        yield head, http, frame[body:end]
        at = end + 4


def _dealt(rows: DataFrame, label: str) -> DataFrame:
    """Small rows that stand for large reads, dealt one to a task; Spark would put them together by their own size."""
    rows = _written(rows, label)
    return rows.repartition(min(MOST_TASKS, max(1, rows.count())))


class Bundle:
    """A file in the making: frames, then the seek table."""

    def __init__(self, folder: str, level: int):
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        where, path = filesystem(folder)
        where.create_dir(path, recursive=True)
        self.out = where.open_output_stream(f"{path}/{self.name}", compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.held, self.length, self.written, self.level = [], 0, 0, level

    def add(self, data: bytes, frame_bytes: int) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.length and self.length + len(data) > frame_bytes:
            self.flush()
        at = len(self.sizes), self.length
        self.held.append(data)
        self.length += len(data)
        return at

    def flush(self) -> None:
        packed = zstandard.ZstdCompressor(level=self.level).compress(b"".join(self.held))
        self.out.write(packed)
        self.sizes.append((len(packed), self.length))
        self.written += len(packed)
        self.held, self.length = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class Reader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, path: str):
        where, inner = filesystem(path)
        self.file = where.open_input_file(inner)
        size = self.file.size()
        frames, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != FOOTER_MAGIC:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(8 * frames, size - 9 - 8 * frames)
        self.sizes = list(struct.iter_unpack("<II", table))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, number: int) -> bytes:
        packed, whole = self.sizes[number]
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, self.starts[number]), max_output_size=whole)
        if len(data) != whole:
            raise ValueError(f"frame {number} is shorter than the seek table says")
        return data

    def close(self) -> None:
        self.file.close()


def with_originals(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, html, sha, refers, own) per row; ``refers``: a revisit, whose response is page ``own``.

    Only digests and ids are grouped; rows that repeat page, address and payload
    are counted, and one of them can be the response.
    """
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha2("html", 256))
    thin = rows.where(F.octet_length("html") >= least).groupBy("sha", "page_id", "url").agg(F.count("*").alias("copies"))
    entry = F.struct("page_id", "url", "copies")
    repeated = thin.groupBy("sha").agg(F.max(entry).alias("own"), F.sum("copies").alias("rows")).where("rows > 1")
    # measured by the optimizer, which broadcasts it when it is small
    originals = _written(repeated.select("sha", F.col("own.page_id").alias("own"), F.col("own.url").alias("own_url"), F.col("own.copies").alias("copies")), "originals")
    found = rows.join(originals, "sha", "left")
    chosen = F.col("page_id").eqNullSafe(F.col("own")) & F.col("url").eqNullSafe(F.col("own_url"))
    plain = found.where(F.col("copies").isNull() | ~chosen | (F.col("copies") == 1)).select(
        "page_id", "url", "html", "sha", (F.col("copies").isNotNull() & ~chosen).alias("refers"), "own"
    )
    equal = found.where(chosen & (F.col("copies") > 1)).groupBy("sha", "page_id", "url", "own").agg(
        F.first("html").alias("html"), F.count("*").alias("copies")
    )
    dealt = equal.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select(
        "page_id", "url", "html", "sha", (F.col("copy") > 1).alias("refers"), "own"
    )
    return plain.unionByName(dealt)


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL,
) -> DataFrame:
    """Write the rows as bundles below ``folder``; returns the index (record_id, page_id, file, frame, offset, length).

    The index is written beside the bundles and lists every record. Payloads are
    the texts in UTF-8, a null one is empty. Of equal payloads of at least
    ``least`` bytes the row with the largest key is the response (a null key
    only if all are null; of rows that repeat the key one), the others revisit
    it. Null keys and addresses are kept as absent headers. Further columns are
    not read; an empty table gives an empty index.
    """
    marked = with_originals(pages, key, url, html, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = None, []

        def ended() -> pa.RecordBatch:
            bundle.close()
            columns = list(zip(*rows))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            names = ["record_id", "page_id", "file", "frame", "offset", "length"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "html", "refers", "own", "sha"))
            for page, address, text, refers, own, sha in zip(*columns):
                payload, page_id = text.as_py().encode(), page.as_py()
                digest = payload_digest(payload)
                bundle = bundle or Bundle(folder, level)
                # responses to equal payloads that are too short to be revisited, and revisits, are told apart by their place
                place = "" if own.is_valid and not refers.as_py() else f":{bundle.name[:32]}-{len(rows)}"
                name = f"urn:page:{'' if page_id is None else page_id}:{sha.as_py()[:32]}{place}"
                original = f"urn:page:{'' if own.as_py() is None else own.as_py()}:{sha.as_py()[:32]}" if refers.as_py() else None
                data = record(name, page_id, address.as_py(), payload, digest, original)
                frame, offset = bundle.add(data, frame_bytes)
                rows.append((name, page_id, bundle.name, frame, offset, len(data)))
                if bundle.written >= bundle_bytes:
                    yield ended()
                    bundle, rows = None, []
        if bundle:
            yield ended()

    index = marked.mapInArrow(run, INDEX)
    index.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _fields(head: dict[str, str], http: dict[str, str], payload: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (a page), of a record as read."""
    kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"])
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"record {head['WARC-Record-ID']} does not hold the payload of its digest")
    refers = head["WARC-Refers-To"].split(":")[2] if kind == "revisit" else ""
    return int(head["Page-ID"]) if "Page-ID" in head else None, size, digest, kind, int(refers) if refers else None


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the indexed bundles: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Bundles are dealt over tasks and read frame by frame; responses are held
    against their digests. Bundles that the index does not name are not read.
    """
    bundles = _dealt(index.groupBy("file").agg(F.count("*").alias("records")), "bundles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for name, expected in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                reader, seen = Reader(f"{folder}/{name}"), 0
                for number in range(len(reader.sizes)):
                    rows = [_fields(*r) for r in records(reader.frame(number))]
                    seen += len(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                reader.close()
                if seen != expected:
                    raise ValueError(f"{name} holds {seen} records, the index lists {expected}")

    return bundles.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def fetch(wanted: DataFrame, folder: str) -> DataFrame:
    """``wanted`` index rows with ``page_id``, ``record_type`` and ``payload`` of each (null for a revisit), by seeking.

    Each frame that holds wanted records is read once; others are not touched.
    """
    # at most a frame's records meet
    frames = _dealt(wanted.groupBy("file", "frame").agg(F.collect_list("offset").alias("offsets")), "frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, number, offsets in zip(*(batch.column(c).to_pylist() for c in ("file", "frame", "offsets"))):
                reader = Reader(f"{folder}/{name}")
                data = reader.frame(number)
                reader.close()
                rows = []
                for offset in offsets:
                    head, _, payload = next(records(memoryview(data)[offset:].tobytes()))
                    kind = head["WARC-Type"]
                    rows.append((head["WARC-Record-ID"].strip("<>"), int(head["Page-ID"]) if "Page-ID" in head else None,
                                 kind, payload if kind == "response" else None))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.binary()]
                names = ["record_id", "page_id", "record_type", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return frames.mapInArrow(run, "record_id string, page_id bigint, record_type string, payload binary")


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """The pages written as archives below the shared folder and read back from there; see ``write_archives``."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, key, url, html, least), folder)
