"""Byte-level BPE over a rank file, with a segment tree per piece.

Text is split by the tokenizer's pattern and each match is merged by itself. The leaves of the tree are the byte
positions; a leaf holds the rank of the pair that starts at the live token there, a node the leftmost minimum of its
leaves. A merge takes the root, joins the pair, and updates three leaves: the merged token's own, its left neighbour's
and the leaf of the token that vanished, each in a logarithmic number of steps.

A worker merges each distinct match once and keeps its ids in a bounded cache. Whole texts are encoded; null is
empty. Repeated rows give repeated results, and an empty table gives no row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barlake.llm.common import sub_batches, texts_of

CACHED_PIECES = 800_000
ENCODED = "doc_id bigint, n_tokens bigint, ids binary, decoded binary"
# White space and "no white space" as the tokenizer's own regex engine defines them: the Unicode White_Space property.
SPACES = r"\t-\r \x85\xa0  -     　"
NO_RANK = 1 << 31


def piece_pattern(pattern: str):
    """The tokenizer's pattern with white space spelled out."""
    import regex

    return regex.compile(
        pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
    )


class MergeTree:
    """Merges one piece of text by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def merge(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        size = 1 << max(0, n - 1).bit_length()
        end = list(range(1, n + 1))  # of the live token that starts at a position
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank = self.ranks.get
        tree = [NO_RANK] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = rank(piece[i : i + 2], NO_RANK)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: int) -> None:
            node = size + i
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while (best := tree[1]) < NO_RANK:
            node = 1
            while node < size:
                node = 2 * node if tree[2 * node] == best else 2 * node + 1
            i = node - size
            gone = after[i]
            end[i], after[i] = end[gone], after[gone]
            if after[i] < n:
                before[after[i]] = i
            put(gone, NO_RANK)
            put(i, rank(piece[i : end[after[i]]], NO_RANK) if after[i] < n else NO_RANK)
            left = before[i]
            if left >= 0:
                put(left, rank(piece[left : end[i]], NO_RANK))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : end[i]]])
            i = after[i]
        return ids


class ByteEncoder:
    """Ids of whole texts, and bytes of ids."""

    def __init__(self, path: str, pattern: str, cached_pieces: int = CACHED_PIECES):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tree, self.pattern, self.cached_pieces = MergeTree(ranks), piece_pattern(pattern), cached_pieces
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.cache = self._fresh()

    def _fresh(self) -> dict[str, bytes]:
        merge = self.tree.merge

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                ids = self[piece] = np.array(merge(piece.encode()), "<u4").tobytes()
                return ids

        return Pieces()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.cache) > self.cached_pieces:
            self.cache = self._fresh()
        return b"".join(map(self.cache.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and the bytes they decode to. Both files' contents go no further than the task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(ranks, pattern)
        for batch in sub_batches(batches):
            ids = [encoder.encode(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                    pa.array(map(encoder.decode, ids), pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return texts_of(docs).mapInArrow(encode, ENCODED)


def encoding_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
