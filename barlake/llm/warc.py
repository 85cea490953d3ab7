"""WARC archives in seekable Zstandard.

A task writes one archive. Consecutive records are grouped into frames of about ``FRAME_BYTES``; every frame is an
independent Zstandard frame, and the archive ends with the seek table of the public seekable format (a skippable frame
with the two sizes of each frame), so plain Zstandard readers can read the whole file. The index maps each record to
its archive, its frame and its offset inside the frame: one record costs one frame.

Payloads that repeat are stored once. Among equal payloads of at least ``REVISIT_BYTES`` bytes the record with the
largest page_id is the response and the others are revisits of it; smaller payloads are always stored. Repeated rows
with the response's page_id are responses too. A null html is the empty payload, a null page_id sorts below all
others, a null url leaves the target out. An empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.common import join_hot, published, scratch_dir, stored, sub_batches

FRAME_BYTES, REVISIT_BYTES = 1 << 20, 1000
WARC_DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id bigint, file string, frame int, frame_at bigint, frame_size bigint, record_at bigint, record_size bigint"
RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "payload binary"
)


# Which record holds a payload.


def plan_records(pages: DataFrame, min_bytes: int = REVISIT_BYTES, max_rows: int = 500_000) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type and refers_to of every page."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    )
    large = F.octet_length("payload") >= min_bytes
    # Small payloads get a key of their own kind, which no group has.
    keyed = rows.withColumn("_key", F.when(large, F.sha2("payload", 256)))
    groups = stored(
        keyed.where(large).groupBy("_key").agg(F.max("page_id").alias("_response"), F.count("*").alias("_rows"))
        .where("_rows > 1"),
        "warc-groups",
    )
    total = pages.count()
    met = join_hot(
        keyed.withColumn("_key", F.coalesce("_key", F.concat(F.lit("-"), F.xxhash64("page_id").cast("string")))),
        groups, "_key", "_rows", total, ["page_id"], max_rows=max_rows,
    )
    revisit = F.col("_rows").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_response"))
    return met.select(
        "page_id", "url", "payload", F.sha1("payload").alias("payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_response")).alias("refers_to"),
    )


# Writing.


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record_bytes(row: dict) -> bytes:
    """One WARC record; the block is an HTTP response, without its payload in a revisit."""
    payload, revisit = row["payload"], row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    sha = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_name(row['page_id'])}",
        f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(row['refers_to'])}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *frame) for frame in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def write_archives(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES) -> None:
    """Archives in ``folder/data``, the index of all records in ``folder/index``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in sub_batches(batches, 64) for row in batch.to_pylist())
        row = next(rows, None)
        if row is None:
            return
        name = f"part-{TaskContext.get().partitionId():06d}.warc.zst"
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        index, frames, at = [], [], 0
        with published(f"{folder}/data", name) as out:
            while row is not None:
                parts, places, size = [], [], 0
                while row is not None and (size < frame_bytes or not parts):
                    record = record_bytes(row)
                    parts.append(record)
                    places.append((row["page_id"], size, len(record)))
                    size, row = size + len(record), next(rows, None)
                packed = packer.compress(b"".join(parts))
                out.write(packed)
                index += [(page, name, len(frames), at, len(packed), start, length) for page, start, length in places]
                frames.append((len(packed), size))
                at += len(packed)
            out.write(seek_table(frames))
        kinds = [pa.int64(), pa.string(), pa.int32()] + [pa.int64()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(zip(*index, strict=True), kinds, strict=True)],
            names=[c.split()[0] for c in INDEX.split(", ")],
        )

    records.select("page_id", "url", "payload", "payload_digest", "record_type", "refers_to").mapInArrow(
        write, INDEX
    ).write.parquet(f"{folder}/index")


# Reading.


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Offset, packed size and plain size of every frame, from the end of the archive."""
    end = file.size()
    file.seek(end - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the archive")
    entry = 12 if flags & 0x80 else 8
    file.seek(end - 9 - count * entry)
    table, frames, at = file.read(count * entry), [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        frames.append((at, packed, plain))
        at += packed
    return frames


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that starts at ``at``, and where the next one starts."""
    body = data.index(b"\r\n\r\n", at) + 4
    lines = data[at : body - 4].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines[1:])
    end = body + int(head["Content-Length"])
    http_end = data.index(b"\r\n\r\n", body) + 4
    http = dict(line.split(": ", 1) for line in data[body : http_end - 4].decode().split("\r\n")[1:])
    revisit = head["WARC-Type"] == "revisit"

    def page(name: str) -> int | None:
        value = head[name].removeprefix("<urn:x-page:").removesuffix(">")
        return None if value == "none" else int(value)

    payload = None if revisit else data[http_end:end]
    declared = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if payload is not None and (len(payload) != int(http["Content-Length"]) or hashlib.sha1(payload).hexdigest() != declared):
        raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
    record = {
        "page_id": page("WARC-Record-ID"), "url": head.get("WARC-Target-URI"), "record_type": head["WARC-Type"],
        "refers_to": page("WARC-Refers-To") if revisit else None, "payload_bytes": int(http["Content-Length"]),
        "payload_digest": declared, "payload": payload,
    }
    return record, end + 4


def _record_batch(records: list[dict]) -> pa.RecordBatch:
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )
    return pa.RecordBatch.from_pylist(records, schema=schema)


def archive_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Every frame of every archive, read from the archives' own seek tables."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(f"{folder}/data")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_file(f"{root}/{name}") as file:
                    frames = read_seek_table(file)
                yield pa.RecordBatch.from_pylist(
                    [{"file": name, "at": a, "size": s, "plain": p} for a, s, p in frames],
                    schema=pa.schema([("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("plain", pa.int64())]),
                )

    names = spark.read.schema(INDEX).parquet(f"{folder}/index").select("file").distinct()
    return names.mapInArrow(tables, "file string, at bigint, size bigint, plain bigint")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records. Frames, not archives, are spread over the tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(f"{folder}/data")
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as file:
                    data = opener.decompress(file.read_at(row["size"], row["at"]))
                if len(data) != row["plain"]:
                    raise ValueError(f"frame at {row['at']} of {row['file']} is damaged")
                at, records = 0, []
                while at < len(data):
                    record, at = parse_record(data, at)
                    records.append(record)
                yield _record_batch(records)

    frames = stored(archive_frames(spark, folder), "warc-frames")
    tasks = max(spark.sparkContext.defaultParallelism, frames.count() // 32)
    return frames.repartition(tasks, "file", "at").mapInArrow(read, RECORDS)


def fetch_records(spark: SparkSession, folder: str, page_ids: DataFrame) -> DataFrame:
    """The records of some pages: only the frames that hold them are read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(f"{folder}/data")
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as file:
                    data = opener.decompress(file.read_at(row["frame_size"], row["frame_at"]))
                yield _record_batch([parse_record(data, row["record_at"])[0]])

    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    return index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi").mapInArrow(read, RECORDS)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write archives of all pages to the shared folder and read every record back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    write_archives(plan_records(pages), folder)
    return read_archives(pages.sparkSession, folder)


def record_digests(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
