"""Whitening of embeddings: blockwise QR, Householder bidiagonalisation, dqds and twisted factorisations.

A vector entry c becomes the integer x = floor(1024 c) + 100000. Sums are exact integers. Every task reduces its centred rows
block by block to a triangular R, and R's are combined in a tree of bounded fan-in, so no covariance is ever formed and
nothing is held whole. The one R that is left has as many rows as the vectors have dimensions; its singular values and
directions (``bidiagonal``) are those of all centred rows.

Rows are dropped if the vector is null or holds null or non-finite entries, or entries whose x exceeds 2^40, and if its length
is not the one most rows have (of several such, the longest). Directions without spread (eigenvalue at most 1e-12 of the
largest) cannot be whitened and give no rows; nor do empty tables, single rows or vectors without entries. A deviation that
does not fit in 64 bits is null. Repeated rows and ids and null ids are rows like others. Other columns are not read. A
direction's sign is such that its largest entry is positive.

The R of d dimensions takes 8 d^2 bytes; one is brought to the driver, at most ``BLOCK_BYTES`` of them meet in a task.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barlake.llm.bidiagonal import right_singular
from barlake.llm.common import stored

COMPONENTS = 8
# Scale and offset of the integer form of an entry.
SCALE, OFFSET = 1024, 100_000
LARGEST = 2.0**40
BLOCK_BYTES = 1 << 25
NO_SPREAD = 1e-12
_OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer matrix of the usable vectors of each length."""
    offsets = np.asarray(lists.offsets)
    flat = lists.values
    raw = flat.to_numpy(zero_copy_only=False).astype(float)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * raw)
    bad = np.concatenate([[0], np.cumsum(~(np.abs(scaled) <= LARGEST))])
    length = np.diff(offsets)
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False) & (length > 0)
    for d in np.unique(length[usable]):
        rows = np.flatnonzero(usable & (length == d))
        yield rows, scaled[offsets[rows][:, None] + np.arange(d)].astype(np.int64) + OFFSET


def _of_length(lists: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    for rows, x in _matrices(lists):
        if x.shape[1] == d:
            return rows, x
    return np.zeros(0, np.int64), np.zeros((0, d), np.int64)


def fit_sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums by dimension, of the length most rows have."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for rows, x in _matrices(batch.column(0)):
                held = sums.setdefault(x.shape[1], [0, np.zeros(x.shape[1], np.int64)])
                held[0] += len(rows)
                held[1] += x.sum(axis=0)
        for d, (n, total) in sums.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array(np.full(d, d)), "at": pa.array(np.arange(d)), "n": pa.array(np.full(d, n)), "total": pa.array(total)})

    parts = vectors.mapInArrow(add, "d bigint, at bigint, n bigint, total bigint")
    added = stored(parts.groupBy("d", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "whiten-sums")
    most = added.where("at = 0").orderBy(F.desc("n"), F.desc("d")).select("d", "n").first()
    if most is None:
        return 0, np.zeros(0, np.int64)
    totals = added.where(F.col("d") == most.d).orderBy("at").select("total").collect()
    return most.n, np.array([row.total for row in totals], np.int64)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, rounded once."""
    return (n * x - sums) / n


def combined(parts: DataFrame, merge: Callable[[list[bytes]], bytes], size: int) -> bytes | None:
    """``merge`` of all ``part`` values, a few at a time, in a tree. Each is ``size`` bytes; null if there are none."""
    fan_in = max(2, BLOCK_BYTES // max(size, 1))
    numbered = stored(parts.select(F.monotonically_increasing_id().alias("slot"), "part"), "whiten-parts")
    count = numbered.count()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            for part in batch.column(0).to_pylist():
                held.append(part)
                if len(held) >= fan_in:
                    held = [merge(held)]
        if held:
            yield pa.RecordBatch.from_pydict({"part": pa.array([merge(held)], pa.binary())})

    while count > 1:
        groups = -(-count // fan_in)
        dealt = numbered.repartition(groups, "slot") if groups > 1 else numbered.coalesce(1)
        merged_parts = dealt.select("part").mapInArrow(merged, "part binary")
        numbered = stored(merged_parts.select(F.monotonically_increasing_id().alias("slot"), "part"), "whiten-parts")
        count = numbered.count()
    last = numbered.select("part").first()
    return bytes(last.part) if last else None


def triangular(vectors: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of a QR factorisation of all centred rows."""
    d = len(sums)

    def reduced(rows: list[np.ndarray]) -> np.ndarray:
        r = np.linalg.qr(np.concatenate(rows), mode="r")
        return np.concatenate([r, np.zeros((d - len(r), d))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, any_rows = np.zeros((d, d)), False
        block = max(d, BLOCK_BYTES // (8 * d))
        for batch in batches:
            _, x = _of_length(batch.column(0), d)
            for low in range(0, len(x), block):
                r, any_rows = reduced([r, _centred(x[low : low + block], n, sums)]), True
        if any_rows:
            yield pa.RecordBatch.from_pydict({"part": pa.array([r.tobytes()], pa.binary())})

    def merge(parts: list[bytes]) -> bytes:
        return reduced([np.frombuffer(part).reshape(d, d) for part in parts]).tobytes()

    whole = combined(vectors.mapInArrow(partial, "part binary"), merge, 8 * d * d)
    return np.frombuffer(whole).reshape(d, d)


def directions(r: np.ndarray, n: int, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest eigenvalues of the covariance, their unit eigenvectors as columns, and its trace."""
    squares, vectors = right_singular(r, components)
    values = squares[: vectors.shape[1]] / n
    spread = values > NO_SPREAD * max(squares[0] / n, 0.0)
    values, vectors = values[spread], vectors[:, spread]
    if len(values):
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors, squares.sum() / n


def _whitened(x: np.ndarray, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return _centred(x, n, sums) @ vectors / np.sqrt(values)


def identity_error(vectors: DataFrame, n: int, sums: np.ndarray, values: np.ndarray, columns: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, from moments centred in each task."""
    d, k = len(sums), len(values)

    def packed(count: int, mean: np.ndarray, moments: np.ndarray) -> bytes:
        return struct.pack("<q", count) + mean.tobytes() + moments.tobytes()

    def unpacked(part: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        return struct.unpack_from("<q", part)[0], np.frombuffer(part, float, k, 8), np.frombuffer(part, float, k * k, 8 + 8 * k).reshape(k, k)

    def together(one: tuple, other: tuple) -> tuple:
        count, apart = one[0] + other[0], other[1] - one[1]
        return count, one[1] + apart * (other[0] / count), one[2] + other[2] + np.outer(apart, apart) * (one[0] * other[0] / count)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            _, x = _of_length(batch.column(0), d)
            if len(x):
                w = _whitened(x, n, sums, values, columns)
                mean = w.mean(axis=0)
                own = (len(w), mean, (w - mean).T @ (w - mean))
                state = own if state is None else together(state, own)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([packed(*state)], pa.binary())})

    def merge(parts: list[bytes]) -> bytes:
        state = unpacked(parts[0])
        for part in parts[1:]:
            state = together(state, unpacked(part))
        return packed(*state)

    count, _, moments = unpacked(combined(vectors.mapInArrow(partial, "part binary"), merge, 8 * (1 + k + k * k)))
    return float(np.abs(moments / count - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sum of (n x - sums)^2 of each row, None beyond 64 bits."""
    apart = n * x - sums
    if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
        return (apart * apart).sum(axis=1).tolist()
    exact = (sum(v * v for v in row) for row in apart.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def whitened_rows(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each usable row and component."""
    id_type = table.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, {_OUT}"
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = rows.select("embedding")
    n, sums = fit_sums(vectors)
    values = np.zeros(0)
    if n:
        r = triangular(vectors, n, sums)
        values, columns, trace = directions(r, n, components)
    if not len(values):
        return table.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, n, sums, values, columns)
    explained, k = values / trace, len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _of_length(batch.column(1), len(sums))
            if not len(at):
                continue
            each = np.repeat(np.arange(len(at)), k)
            columns_out = [
                batch.column(0).take(pa.array(at[each])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(each), n)),
                pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                pa.array(_whitened(x, n, sums, values, columns).ravel()),
                pa.array(np.tile(explained, len(at))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns_out, names=["vec_id", *[c.split()[0] for c in _OUT.split(", ")]])

    return rows.mapInArrow(project, schema)
