"""Token-id files in canonical, length-limited Huffman code.

Ids are counted over the whole corpus, which gives one code for all files. Documents are range-partitioned by doc_id
and their ids are gathered into blocks of about ``BLOCK_IDS`` ids. A block is decodable by itself: it carries its
documents, and the bit offset of every ``CHECKPOINT``-th id, so a reader can start at any checkpoint. The decoder
starts at all of them at once and looks up one id per lane and step in a table over the longest code.

File: magic, code lengths (zlib), blocks, block index, index length, magic; numbers are little-endian, the bit stream
is big-endian. Null and empty texts are documents with the end id only. Repeated rows are kept, ordered by text within
a doc_id; a null doc_id comes first. An empty table gives no file and no row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barlake.llm.common import bounded, published, scratch_dir, sub_batches, text_batches, texts_of
from barlake.llm.tokens import word_encoder

MAGIC = b"BLHUF\x01\r\n"
BLOCK_IDS, CHECKPOINT, MAX_BITS, END_ID = 1 << 17, 128, 16, 2
BLOCKS = "part bigint, block bigint, in_part bigint, n_docs bigint, n_ids bigint, docs binary, ids binary"
INDEX = "file string, at bigint, size bigint, start bigint, n_docs bigint, n_ids bigint"
DECODED = "doc_id bigint, start bigint, ids binary"
DOC = np.dtype([("known", "<u1"), ("doc_id", "<i8"), ("n", "<u4")])
HEAD = "<QIQQ"  # start, documents, ids, bits


# The code.


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge; ids that never occur get 0."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids need codes of more than {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    leaf_marks, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        leaf_marks.append(order < len(leaves))
        merged = both[order]
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    take, depth = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for marks in reversed(leaf_marks):
        taken = int(marks[:take].sum())
        depth[:taken] += 1
        take = 2 * (take - taken)
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        if size := int(lengths[symbol]):
            code <<= size - last
            codes[symbol], last = code, size
            code += 1
    return codes


@lru_cache(maxsize=4)
def _decode_table(packed: bytes, max_bits: int) -> np.ndarray:
    """Id and, in the lowest five bits, code length for every value of the next ``max_bits`` bits."""
    lengths = np.frombuffer(zlib.decompress(packed), np.uint8)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(codes[used] << (max_bits - lengths[used].astype(np.uint64)), kind="stable")]
    spans = np.int64(1) << (max_bits - lengths[used].astype(np.int64))
    symbols, sizes = np.zeros(1 << max_bits, np.uint32), np.ones(1 << max_bits, np.uint8)
    filled = int(spans.sum())
    symbols[:filled], sizes[:filled] = np.repeat(used, spans), np.repeat(lengths[used], spans)
    return symbols << 5 | sizes


def encode_ids(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """The bit stream, the bit offset of every ``CHECKPOINT``-th id, and the number of bits."""
    size, code = lengths[ids].astype(np.int64), codes[ids]
    ends = np.cumsum(size)
    at, bits = ends - size, int(ends[-1])
    word, over = at >> 6, (at & 63) + size - 64
    shift = np.abs(over).astype(np.uint64)
    high = np.where(over > 0, code >> shift, code << shift)
    words = np.zeros((bits >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words[word[first]] = np.bitwise_or.reduceat(high, first)
    crossing = np.flatnonzero(over > 0)
    words[word[crossing] + 1] |= code[crossing] << (np.uint64(64) - shift[crossing])
    return words.astype(">u8").tobytes()[: (bits + 7) // 8], at[::CHECKPOINT], bits


def decode_ids(stream: bytes, checkpoints: np.ndarray, count: int, packed: bytes, max_bits: int) -> np.ndarray:
    """All ids of a block: one lane per checkpoint, one id per lane and step."""
    table = _decode_table(packed, max_bits)
    data = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    bits = np.uint32 if len(stream) < 1 << 29 else np.uint64
    out, at = np.zeros((CHECKPOINT, len(checkpoints)), np.uint32), checkpoints.astype(bits)
    last = count - (len(checkpoints) - 1) * CHECKPOINT
    limit, room, mask = bits(8 * len(stream)), bits(24 - max_bits), bits((1 << max_bits) - 1)
    for step in range(CHECKPOINT):
        if step == last:
            at = at[:-1]
        entry = table[window[np.minimum(at, limit) >> 3] >> room - (at & 7) & mask]
        out[step, : len(at)] = entry
        at = at + (entry & 31)
    out >>= 5
    return out.T.reshape(-1)[:count]


# Writing.


def document_blocks(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Ids of whole documents in ascending doc_id order, gathered into numbered blocks per range partition."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, "<u2")
        if encoder.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        end = np.array([end_id], "<u2").tobytes()
        part, block, in_part, held, ids, size = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def row():
            nonlocal block, in_part, held, ids, size
            described = np.array(held, DOC).tobytes()
            values = [part, block, in_part, len(held), size, described, b"".join(ids)]
            kinds = [pa.int64()] * 5 + [pa.binary()] * 2
            batch = pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")]
            )
            block, in_part, held, ids, size = block + 1, in_part + size, [], [], 0
            return batch

        for batch in text_batches(batches):
            for doc_id, own in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                count = len(own) // 2 + 1
                if held and size + count > block_ids:
                    yield row()
                held.append((doc_id is not None, doc_id or 0, count))
                ids += (own, end)
                size += count
        if held:
            yield row()

    ordered = texts_of(docs).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    return ordered.mapInArrow(gather, BLOCKS)


def id_counts(blocks: DataFrame) -> np.ndarray:
    """Occurrences of every id; the answer has at most 65,536 rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["id", "n"])

    counts = np.zeros(1 << 16, np.int64)
    for row in blocks.select("ids").mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    return counts


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the corpus to ``folder/data`` and the block index to ``folder/index``."""
    spark = docs.sparkSession
    document_blocks(docs, tokenizer, end_id, block_ids).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    lengths = code_lengths(id_counts(blocks))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the write above, so this window stays small.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")
    )
    parts = F.broadcast(parts) if bounded(parts) else parts
    _write(blocks.join(parts, "part"), f"{folder}/data", lengths).write.parquet(f"{folder}/index")


def _write(blocks: DataFrame, folder: str, lengths: np.ndarray) -> DataFrame:
    packed = zlib.compress(lengths.tobytes(), 9)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        rows = (row for batch in sub_batches(batches, 8) for row in batch.to_pylist())
        row = next(rows, None)
        while row:
            name, index = f"part-{row['part']:06d}-{row['block']:08d}.huf", []
            with published(folder, name) as out:
                out.write(MAGIC + struct.pack("<BI", MAX_BITS, len(packed)) + packed)
                at, expected = len(MAGIC) + 5 + len(packed), (row["part"], row["block"])
                while row and (row["part"], row["block"]) == expected:
                    stream, checkpoints, bits = encode_ids(np.frombuffer(row["ids"], "<u2"), codes, lengths)
                    start = row["part_start"] + row["in_part"]
                    block = struct.pack(HEAD, start, row["n_docs"], row["n_ids"], bits) + row["docs"]
                    block += checkpoints.astype("<u8").tobytes() + stream
                    out.write(block)
                    index.append((name, at, len(block), start, row["n_docs"], row["n_ids"]))
                    at, expected, row = at + len(block), (row["part"], row["block"] + 1), next(rows, None)
                footer = b"".join(struct.pack("<QQQ", *entry[1:4]) for entry in index)
                out.write(footer + struct.pack("<Q", len(index)) + MAGIC)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if i == 0 else pa.int64()) for i, v in enumerate(zip(*index, strict=True))],
                names=[c.split()[0] for c in INDEX.split(", ")],
            )

    ordered = blocks.select("part", "block", "in_part", "part_start", "n_docs", "n_ids", "docs", "ids")
    return ordered.sortWithinPartitions("part", "block").mapInArrow(write, INDEX)


# Reading.


def read_block(fs: pafs.FileSystem, path: str, at: int, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """First position, documents and ids of one block."""
    with fs.open_input_file(path) as file:
        prefix = file.read(len(MAGIC) + 5)
        max_bits, table = struct.unpack("<BI", prefix[len(MAGIC) :])
        if prefix[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is not a token file")
        packed = file.read(table)
        file.seek(at)
        block = file.read(size)
    start, n_docs, n_ids, _ = struct.unpack_from(HEAD, block)
    docs = np.frombuffer(block, DOC, n_docs, struct.calcsize(HEAD))
    lanes, place = -(-n_ids // CHECKPOINT), struct.calcsize(HEAD) + n_docs * DOC.itemsize
    checkpoints = np.frombuffer(block, "<u8", lanes, place)
    return start, docs, decode_ids(block[place + 8 * lanes :], checkpoints, n_ids, packed, max_bits)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files, with its global start and its ids as little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(f"{folder}/data")
        for batch in batches:
            for row in batch.to_pylist():
                start, docs, ids = read_block(fs, f"{root}/{row['file']}", row["at"], row["size"])
                ends = np.cumsum(docs["n"].astype(np.int64))
                raw, starts = ids.astype("<u4").tobytes(), ends - docs["n"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs["doc_id"], pa.int64(), mask=docs["known"] == 0),
                        pa.array(starts + start, pa.int64()),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    index = spark.read.schema(INDEX).parquet(f"{folder}/index").select("file", "at", "size")
    tasks = max(spark.sparkContext.defaultParallelism, index.count() // 16)
    return index.repartition(tasks, "file", "at").mapInArrow(read, DECODED)


def id_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def coded_roundtrip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files to the shared folder and read every document back."""
    folder = scratch_dir(docs.sparkSession, "huffman")
    write_files(docs, folder, tokenizer, end_id)
    return read_files(docs.sparkSession, folder)
