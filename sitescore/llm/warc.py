"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with some whole records,
and a footer in a skippable frame: the seek table, with the compressed and the
plain size of every frame. A record is addressed by bundle, frame and its offset
in the plain frame; reading it touches the footer and that one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescore.llm.kit import kept
from sitescore.session import scratch_path, spread

# fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
ENTRY, FOOTER = struct.Struct("<II"), struct.Struct("<IBI")
# fixed values of the record format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

INDEX = "page_id long, record_id string, bundle string, frame int, offset long, length long"
RECORDS = "page_id long, record_id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, bundle string, frame int, offset long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{sha}>"


def page_of(identifier: str) -> int | None:
    number = identifier.split(":")[2]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None, date: str) -> tuple[str, bytes]:
    """A response with the payload, or a revisit that names the record with an equal one."""
    sha = digest(payload)
    name = record_id(page_id, sha)
    http = HTTP.format(len(payload)).encode()
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, sha)}"]
    head += [f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return name, VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Named fields, block and end of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    return fields, data[stop + 4 : stop + 4 + size], stop + 4 + size + 4


class Bundle:
    """Collects records into frames; ``close`` appends the seek table."""

    def __init__(self, sink, frame_bytes: int, level: int):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.table: list[tuple[int, int]] = []
        self.open, self.size, self.written = [], 0, 0

    def add(self, data: bytes) -> tuple[int, int]:
        if self.size and self.size + len(data) > self.frame_bytes:
            self._flush()
        place = (len(self.table), self.size)
        self.open.append(data)
        self.size += len(data)
        return place

    def _flush(self) -> None:
        packed = self.packer.compress(b"".join(self.open))
        self.sink.write(packed)
        self.written += len(packed)
        self.table.append((len(packed), self.size))
        self.open, self.size = [], 0

    def close(self) -> None:
        if self.open:
            self._flush()
        entries = b"".join(ENTRY.pack(*x) for x in self.table)
        body = entries + FOOTER.pack(len(self.table), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.sink.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer of an open file."""
    end = source.size()
    source.seek(end - FOOTER.size)
    frames, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = ENTRY.size + (4 if flags & 0x80 else 0)
    source.seek(end - FOOTER.size - frames * width)
    raw = source.read(frames * width)
    table, start = [], 0
    for n in range(frames):
        packed, plain = ENTRY.unpack_from(raw, n * width)
        table.append((start, packed, plain))
        start += packed
    return table


def read_frame(source, table: list[tuple[int, int, int]], frame: int) -> bytes:
    start, packed, plain = table[frame]
    source.seek(start)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=max(1, plain))


def read_record(bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its address."""
    files, path = fs.FileSystem.from_uri(bundle)
    with files.open_input_file(path) as source:
        fields, block, _ = parse(read_frame(source, seek_table(source), frame), offset)
    return fields, block


def write_archives(pages: DataFrame, folder: str, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 26, level: int = 3, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every (page_id, url, html) row under ``folder``; returns where each is.

    ``folder`` is a URI that all executors reach. Of rows with equal payloads (a
    null html is empty) the one with the smallest page_id is the response, and
    the others revisit it; rows that repeat that id with that payload are
    responses too. A null id is no smallest one unless there is no other. Each
    task writes bundles of its own; those of failed attempts are in no index.
    """
    folder = folder if "://" in folder else folder.replace("file:", "", 1) if folder.startswith("file:") else folder
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    ids = rows.select("page_id", "sha")
    first = ids.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("held")).where("held > 1")
    first = kept(first.select("sha", "refers_to"), "payloads")
    again = ids.join(first, "sha").where("not (page_id <=> refers_to)").distinct()
    again = kept(again.select(F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), "refers_to"), "revisits")
    rows = rows.join(again, rows["page_id"].eqNullSafe(again["r_id"]) & (rows["sha"] == again["r_sha"]), "left")
    rows = rows.select("page_id", "url", F.col("html").cast("binary").alias("html"), F.col("r_sha").isNotNull().alias("revisit"), "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        context = TaskContext.get()
        bundle, name, number = None, "", 0
        for batch in batches:
            out = []
            for page_id, url, html, revisit, refers_to in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "revisit", "refers_to"))):
                if bundle is None or bundle.written > bundle_bytes:
                    if bundle is not None:
                        bundle.close()
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number}.warc.zst"
                    bundle, number = Bundle(files.open_output_stream(f"{path}/{name}", compression=None), frame_bytes, level), number + 1
                identifier, data = record(page_id, url, html, revisit, refers_to, date)
                out.append((page_id, identifier, f"{folder}/{name}", *bundle.add(data), len(data)))
            columns = list(zip(*out)) or [[]] * 6
            types = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["page_id", "record_id", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()

    return kept(rows.mapInArrow(write, INDEX), "warc-index")


def read_archives(bundles: DataFrame) -> DataFrame:
    """All records of the (bundle) files, frame by frame.

    A response's digest is computed from its payload and must equal the one in
    its header; a revisit has no payload here, its size and digest are those
    that its header states.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch["bundle"].to_pylist():
                files, path = fs.FileSystem.from_uri(bundle)
                with files.open_input_file(path) as source:
                    table = seek_table(source)
                    for frame in range(len(table)):
                        yield _records(read_frame(source, table, frame), bundle, frame)

    return spread(bundles.select("bundle").distinct(), "bundle").mapInArrow(read, RECORDS)


def _records(data: bytes, bundle: str, frame: int) -> pa.RecordBatch:
    out, at = [], 0
    while at < len(data):
        fields, block, end = parse(data, at)
        http, _, payload = block.partition(b"\r\n\r\n")
        sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and digest(payload) != sha:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        size = int(http.rsplit(b"Content-Length: ", 1)[1])
        name = fields["WARC-Record-ID"]
        refers_to = page_of(fields["WARC-Refers-To"]) if revisit else None
        out.append((page_of(name), name, fields.get("WARC-Target-URI"), fields["WARC-Type"], None if revisit else payload, size, sha, refers_to, bundle, frame, at))
        at = end
    types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
    names = ["page_id", "record_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "bundle", "frame", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages to archives and read them back; by default under the shared folder."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder))
