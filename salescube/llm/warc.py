"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of whole WARC records,
and at its end a seek table in a skippable frame: the compressed and plain size
of every frame, their number and a magic number, as in Zstandard's public
seekable format. The index maps a record's identifier to its bundle, its frame
and its offset in the frame, so one record costs one range read and one frame.

Tasks write bundles into a shared folder through pyarrow's file systems under a
name of their own attempt; the index, stored once, names the files that count,
so a lost executor's or a repeated attempt's files are never read.
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
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescube.llm.common import scratch_path, small, stored

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
READ_FRAMES = 64         # frames that a reading task opens, 16 MiB of plain records
MIN_REVISIT_BYTES = 100
DATE = "2000-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    digits = record[len("<urn:page:"):-1] if record else ""
    return int(digits) if digits else None


def _header_value(value: str | None) -> str:
    """Control characters and non-ASCII as percent escapes: a header stays one line."""
    return re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value or "")


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with the payload, or a revisit that has headers only."""
    revisit = refers_to is not None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header_value(url)),
        ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()),
        ("X-Payload-Bytes", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if revisit:
        headers[2:2] = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def read_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, where the next record begins)."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    payload = data[data.index(b"\r\n\r\n", begin) + 4:end]
    return headers, payload, end + 4


class BundleWriter:
    """Writes frames one after the other and the seek table at the close."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.pending: list[bytes] = []
        self.filled = 0
        self.frames: list[tuple[int, int]] = []
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in it). A record larger than a frame's size has a frame of its own."""
        if self.pending and self.filled + len(record) > self.frame_bytes:
            self.flush()
        place = len(self.frames), self.filled
        self.pending.append(record)
        self.filled += len(record)
        return place

    def flush(self) -> None:
        if self.pending:
            frame = zstandard.ZstdCompressor(level=3).compress(b"".join(self.pending))
            self.out.write(frame)
            self.frames.append((len(frame), self.filled))
            self.written += len(frame)
            self.pending, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


def read_seek_table(f) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame of an open bundle."""
    size = f.size()
    f.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * count)
    sizes = list(struct.iter_unpack("<II", f.read(8 * count)))
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def _open_fs(folder: str):
    """The file system of a folder and the folder's path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), folder
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def _payload_digest(min_bytes: int) -> Column:
    """SHA-256 of a payload of at least so many bytes, else null."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    return F.when(F.octet_length(html) >= min_bytes, F.sha2(html, 256))


def first_copies(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(copy_id, copy_digest, refers_to) of the payloads that an earlier page id has.

    Only digests and ids are shuffled; a payload that a third of all pages share
    is one row after the partial aggregate, and skew splits the join.
    """
    digests = pages.select("page_id", _payload_digest(min_bytes).alias("digest")).where("digest is not null")
    digests = stored(digests, "digests")
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    return (digests.join(firsts, "digest").where("page_id > refers_to")
            .select(F.col("page_id").alias("copy_id"), F.col("digest").alias("copy_digest"), "refers_to").distinct())


INDEX = "page_id long, bundle string, frame int, start long, packed long, plain long, offset long"


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record for each row of pages (page_id long, url, html) and return the stored index.

    Null html and url are empty. Of equal payloads of at least 100 bytes the
    smallest page id is the response and larger ids revisit it; rows with a null
    id and rows that repeat an id are responses of their own if no smaller id
    has the payload. Other columns are not read. An empty table writes nothing.
    """
    rows = pages.select("page_id", "url", "html")
    # Rows that repeat an id may differ in payload, so a copy is known by both.
    digested = rows.withColumn("digest", _payload_digest(MIN_REVISIT_BYTES))
    same = (F.col("page_id") == F.col("copy_id")) & (F.col("digest") == F.col("copy_digest"))
    joined = digested.join(first_copies(rows), same, "left").select(*rows.columns, "refers_to")

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_fs(folder)
        fs.create_dir(base, recursive=True)
        writer, places, name = None, [], ""

        def close() -> pa.RecordBatch:
            writer.close()
            starts = [0]
            for packed, _ in writer.frames:
                starts.append(starts[-1] + packed)
            cols = list(zip(*[(i, name, f, starts[f], *writer.frames[f], o) for i, f, o in places]))
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["page_id", "bundle", "frame", "start", "packed", "plain", "offset"])

        for batch in small(frames, "html"):
            for page, url, html, refers in zip(*[batch.column(c) for c in ("page_id", "url", "html", "refers_to")]):
                if writer is None:
                    name, places = f"pages-{uuid.uuid4().hex}.warc.zst", []
                    writer = BundleWriter(fs.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                record = write_record(page.as_py(), url.as_py(), (html.as_py() or "").encode(), refers.as_py())
                places.append((page.as_py(), *writer.add(record)))
                if writer.written >= bundle_bytes:
                    yield close()
                    writer = None
        if writer is not None:
            yield close()

    return stored(joined.mapInArrow(write, INDEX), "warc-index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, read through their seek tables.

    Returns (page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to). A response's size and digest are taken from its payload; a
    revisit has them in its headers.
    """
    def frames_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_fs(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_file(f"{base}/{name}") as f:
                    table = read_seek_table(f)
                cols = list(zip(*[(name, *row) for row in table])) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                    ["bundle", "start", "packed", "plain"])

    # A row stands for a whole frame: tasks go by frames, not by the rows' few bytes.
    held = index.agg(F.count_distinct("bundle", "start")).first()[0]
    frames = (index.select("bundle").distinct().mapInArrow(
        frames_of, "bundle string, start long, packed long, plain long")
        .repartition(max(1, -(-held // READ_FRAMES)), "bundle", "start"))
    return frames.mapInArrow(lambda b: _read_frames(b, folder, None), RECORD)


def read_pages(index: DataFrame, folder: str, page_ids: DataFrame) -> DataFrame:
    """The records of chosen page ids: one range read for each frame that holds some."""
    chosen = (index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi")
              .groupBy("bundle", "start", "packed", "plain").agg(F.sort_array(F.collect_list("offset")).alias("offsets")))
    return chosen.mapInArrow(lambda b: _read_frames(b, folder, "offsets"), RECORD)


RECORD = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long")


def _read_frames(batches: Iterator[pa.RecordBatch], folder: str, offsets: str | None) -> Iterator[pa.RecordBatch]:
    fs, base = _open_fs(folder)
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in RECORD.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            with fs.open_input_file(f"{base}/{row['bundle']}") as f:
                f.seek(row["start"])
                data = zstandard.ZstdDecompressor().decompress(f.read(row["packed"]), max_output_size=row["plain"])
            out, at, wanted = [], 0, iter(row[offsets] if offsets else ())
            while at < len(data):
                if offsets and (at := next(wanted, len(data))) == len(data):
                    break
                headers, payload, after = read_record(data, at)
                at = after
                revisit = headers["WARC-Type"] == "revisit"
                out.append((page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], payload,
                            int(headers["X-Payload-Bytes"]) if revisit else len(payload),
                            headers["WARC-Payload-Digest"].removeprefix("sha256:") if revisit
                            else hashlib.sha256(payload).hexdigest(),
                            headers["WARC-Type"], page_of(headers.get("WARC-Refers-To"))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_bundles(pages, folder)
    return read_bundles(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
