"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two, the longest first: as many pieces of the
maximal length as fit, then one piece per set bit of the rest. Pieces of one length form a bucket. A piece is a
sequence of its own, so no sequence crosses documents and none is padded; a trainer draws each batch from one bucket.

The cut follows from the document alone, so packing needs no shuffle. ``sequence_id`` holds the bucket, the task and
a counter; it orders sequences by bucket, and a repeated task gives the same ids.

Empty and null texts are documents with the end id only. Repeated rows are packed once each; a null doc_id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from barlake.llm.common import text_batches, texts_of
from barlake.llm.tokens import CACHED, release_memory, word_encoder

LIMIT = 4096
END_ID = 2
# Bytes of text that are encoded at once, for each word and piece a worker may keep.
TEXT_PER_NAME = 7
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, bucket int, sequence_id bigint, "
    "offset bigint"
)
# Bits of a sequence id, from the top: 4 for the bucket, 24 for the task, 35 for the counter.
TASK_SHIFT, BUCKET_SHIFT = 35, 59


def piece_lengths(tokens: int, limit: int = LIMIT) -> list[int]:
    """Powers of two that sum to ``tokens``, none above ``limit`` (itself a power of two), longest first."""
    whole, rest = divmod(tokens, limit)
    return [limit] * whole + [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, limit: int = LIMIT, cached: tuple[int, int] = CACHED
) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit integers.

    ``cached`` bounds the words and pieces a worker keeps; fewer cost time and change no id.
    """
    if limit < 1 or limit & (limit - 1) or limit > 1 << 15:
        raise ValueError("limit must be a power of two up to 32768")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        encoder = word_encoder(tokenizer, cached=cached)
        end = np.array([end_id], "<u4").tobytes()
        task, counter = TaskContext.get().partitionId(), 0
        for batch in text_batches(batches, size=TEXT_PER_NAME * sum(cached)):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                ids += end
                total, start = len(ids) // 4, 0
                for length in piece_lengths(total, limit):
                    bucket = length.bit_length() - 1
                    sequence = bucket << BUCKET_SHIFT | task << TASK_SHIFT | counter
                    rows.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], total, bucket, sequence, 0))
                    start, counter = start + length, counter + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values, kind)
                    for values, kind in zip(zip(*rows, strict=True), _ARROW, strict=True)
                ],
                names=_NAMES,
            )

    return texts_of(docs).mapInArrow(pack, PIECES)


_NAMES = [part.split()[0] for part in PIECES.split(", ")]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """One folder per piece length; Spark splits buckets that are large and joins those that are small."""
    pieces.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)


def read_bucket(spark, folder: str, bucket: int) -> DataFrame:
    """The sequences of length ``2 ** bucket``; only their folder is read."""
    return spark.read.parquet(folder).where(F.col("bucket") == bucket)
