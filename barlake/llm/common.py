"""Tables, hot-key joins and shared files for the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.operators.chunks import BROADCAST_BYTES, fits_broadcast
from barlake.session import scratch_dir, stored

HOT_SLOTS = 1000
BROADCAST_ROWS = 500_000

__all__ = [
    "bounded", "id_text_bucket", "join_hot", "named_table", "published", "scratch_dir", "stored", "sub_batches",
    "text_batches", "texts_of",
]


def named_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text only (a null text is empty), so no other column of the input can clash."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def id_text_bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def bounded(frame: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame is measured to fit a broadcast."""
    return fits_broadcast(frame, max_rows, BROADCAST_BYTES)


def join_hot(
    large: DataFrame, small: DataFrame, key: str, rows: str, total: int, spread: Sequence[str],
    slots: int = HOT_SLOTS, max_rows: int = BROADCAST_ROWS, counted: int | None = None,
) -> DataFrame:
    """Left join of ``large`` with ``small`` (one row per key), safe for keys that hold a large part of ``large``.

    ``rows`` names the column of ``small`` with the number of rows of ``large`` that carry the key. A small table
    measured to fit is broadcast; ``counted`` is the number of its rows if the caller knows it and they are a few numbers. Otherwise only the keys with more than ``total / slots`` rows are broadcast, of
    which there are at most ``slots``; the rest is joined by shuffle, where rows that already met their hot key and
    rows without a key are spread by ``spread``.
    """
    if bounded(small, max_rows) if counted is None else counted <= max_rows:
        return large.join(F.broadcast(small), key, "left")
    values = [c for c in small.columns if c != key]
    heavy = F.col(rows) > F.lit(total / slots)
    hot = small.where(heavy).select(key, *[F.col(c).alias(f"_hot_{c}") for c in values])
    # A row without a key, which nothing meets, keeps the plan the same whether or not there are hot keys.
    nobody = [F.lit(None).cast(field.dataType).alias(field.name) for field in hot.schema.fields]
    hot = hot.unionByName(large.sparkSession.range(1).select(*nobody))
    cold = small.where(~heavy).withColumn("_spread", F.lit(0).cast("bigint"))
    met = F.col(f"_hot_{rows}").isNotNull() | F.col(key).isNull()
    joined = (
        large.join(F.broadcast(hot), key, "left")
        .withColumn("_spread", F.when(met, 1 + F.pmod(F.xxhash64(*spread), F.lit(99_991))).otherwise(F.lit(0)).cast("bigint"))
        .join(cold, [key, "_spread"], "left")
    )
    return joined.select(
        *large.columns, *[F.coalesce(f"_hot_{c}", c).alias(c) for c in values]
    )


def sub_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller pieces of the incoming batches, which bounds what a task holds besides its input."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_batches(batches: Iterator[pa.RecordBatch], column: int = 1, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Pieces of the incoming batches with about ``size`` bytes of text each, or a single longer text."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, end - at)
            at = end


@contextmanager
def published(folder: str, name: str):
    """A file that appears under its final name only once it is complete; a repeated task replaces it."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    waiting, final = f"{root}/.{name}.{uuid.uuid4().hex}", f"{root}/{name}"
    try:
        with fs.open_output_stream(waiting) as out:
            yield out
    except BaseException:
        fs.delete_file(waiting)
        raise
    if fs.get_file_info(final).type != pafs.FileType.NotFound:
        fs.delete_file(final)
    fs.move(waiting, final)
