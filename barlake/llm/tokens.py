"""Token ids of the word tokenizer's file, one distinct word at a time.

The tokenizer lower-cases, drops white space and never merges across the pieces its pattern finds, so a text's ids are the
ids of its pieces joined. A batch is split, its words are told apart, looked up and replaced by ids in Arrow; Python sees new
words only. A worker keeps the ids of words and of pieces in bounded caches, which are Arrow arrays too. New pieces of a batch are encoded as one
text, separated by spaces, by the file's model alone, since they are lower-cased and cut already; its tokens tell where a piece
ends. The pattern is applied here only to words of plain Latin characters; all other words go to the whole tokenizer as they are,
and the offsets of their tokens tell the words apart. A cache that is full becomes the old one, from which words that come again
move on; the encoder outlives the task, so a worker's next task finds its words known.
"""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words and pieces that a generation of the caches holds; the small ones are for executors that hold other stages' memory too.
CACHED, CACHED_FEW, AT_ONCE = (350_000, 250_000), (50_000, 35_000), 4096
# Long words fill a generation sooner: bytes that it holds, and that of one batch.
CACHED_BYTES = 1 << 25
# The pieces of the tokenizer's pattern, for text that is lower-cased already, and the ends of lines.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n"
PLAIN, PRINTED = "^[!-~¡-ɏ]*$", "^[!-~]*$"
# The same pieces where all is printable ASCII.
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\n]+|\n")
SPECIAL = "<|"
# The characters that stand for bytes in the file: those that print are themselves, the others follow from 256 on.
SHOWN = np.arange(256, dtype="<u2")
_hidden = [byte for byte in range(256) if not (33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174)]
SHOWN[_hidden] = 256 + np.arange(len(_hidden))
SHOWN[32] = 32


def _cut(ids: np.ndarray | pa.Buffer, edges: np.ndarray) -> pa.Array:
    """What lies between the edges, in bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(ids)])


def _joined(ids: pa.Array, codes: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The ids that the codes stand for, one after the other, and where each begins and the last ends."""
    taken = ids.take(codes)
    _, edges, raw = taken.buffers()
    return raw or pa.py_buffer(b""), np.frombuffer(edges, np.int64, len(taken) + 1)


def _places(names: pa.Array, known: pa.Array) -> pa.Array:
    """Where each of the distinct names is among the known ones, or null; the shorter side is hashed."""
    if len(known) <= len(names):
        return pc.index_in(names, value_set=known)
    met = pc.index_in(known, value_set=names)
    places = np.full(len(names), -1, np.int32)
    places[met.drop_null().to_numpy()] = np.flatnonzero(met.is_valid().to_numpy(zero_copy_only=False))
    return pa.array(places, mask=places < 0)


class Known:
    """Distinct names and the ids they stand for."""

    def __init__(self, names: Sequence[str] = (), ids: Sequence[bytes] = ()):
        self.names, self.ids = pa.array(names, pa.string()), pa.array(ids, pa.large_binary())

    def __len__(self) -> int:
        return len(self.names)

    def full(self, limit: int) -> bool:
        return len(self) > limit or self.names.nbytes + self.ids.nbytes > CACHED_BYTES

    def look_up(self, names: pa.Array, old: Known, learn: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """Ids of distinct names; those that are new move on from the old ones or are learnt."""
        at = _places(names, self.names)
        if at.null_count:
            is_new, held = at.is_null(), len(self)
            new = names.filter(is_new)
            before = _places(new, old.names)
            ids = old.ids.take(before)
            if before.null_count:
                unknown = before.is_null()
                ids = pc.replace_with_mask(ids, unknown, learn(new.filter(unknown)))
            self.names, self.ids = pa.concat_arrays([self.names, new]), pa.concat_arrays([self.ids, ids])
            at = pc.replace_with_mask(at, is_new, pa.array(np.arange(held, len(self), dtype=np.int32)))
        return self.ids.take(at)


class WordEncoder:
    """Ids of whole texts as little-endian unsigned integers of ``dtype``."""

    def __init__(self, path: str, dtype: str = "<u4", cached: tuple[int, int] = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.cached_words, self.cached_pieces = cached
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.find = regex.compile(PIECE).findall
        self.words, self.old_words = Known([""], [b""]), Known()
        self.pieces, self.old_pieces = Known(["\n"], [b""]), Known()

    def _learn_pieces(self, pieces: pa.Array) -> pa.Array:
        shown = SHOWN[np.frombuffer(" ".join(_listed(pieces)).encode(), np.uint8)].tobytes().decode("utf-16-le")
        encoding = self.model.encode_batch_fast([shown], add_special_tokens=False)[0]
        ids = np.array(encoding.ids, self.dtype)
        edges = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(edges) != len(pieces) + 1:
            raise ValueError("the tokenizer splits pieces")
        return _cut(ids, edges * self.dtype.itemsize)

    def _learn_whole(self, words: pa.Array) -> pa.Array:
        texts = _listed(words)
        starts = np.cumsum([0] + [len(text) + 1 for text in texts[:-1]])
        encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        owners = np.searchsorted(starts, np.array([a for a, _ in encoding.offsets], np.int64), "right") - 1
        ids = np.array(encoding.ids, self.dtype)
        return _cut(ids, np.searchsorted(owners, np.arange(len(words) + 1)) * self.dtype.itemsize)

    def _learn_lines(self, words: pa.Array, find: Callable[[str], list[str]]) -> pa.Array:
        """Words of plain characters, cut into pieces as one text with a word on each line."""
        cut = pa.array([*find("\n".join(_listed(words)).lower()), "\n"], pa.string()).dictionary_encode()
        if self.pieces.full(self.cached_pieces):
            self.pieces, self.old_pieces = Known(["\n"], [b""]), self.pieces
        raw, edges = _joined(self.pieces.look_up(cut.dictionary, self.old_pieces, _in_turn(self._learn_pieces)), cut.indices)
        ends = edges[np.flatnonzero(cut.indices.to_numpy() == cut.dictionary.index("\n").as_py())]
        if len(ends) != len(words):
            raise ValueError("a word spans lines")
        return _cut(raw, np.concatenate([[0], ends]))

    def _learn(self, words: pa.Array) -> pa.Array:
        plain, printed, special = (
            found.to_numpy(zero_copy_only=False)
            for found in (
                pc.match_substring_regex(words, PLAIN), pc.match_substring_regex(words, PRINTED), pc.match_substring(words, SPECIAL)
            )
        )
        ids, order = [], []
        for group, learn in (
            (printed & ~special, lambda own: self._learn_lines(own, ASCII_PIECE.findall)),
            (plain & ~printed & ~special, lambda own: self._learn_lines(own, self.find)),
            (~plain | special, _in_turn(self._learn_whole)),
        ):
            if group.any():
                order.append(np.flatnonzero(group))
                ids.append(learn(words.take(pa.array(order[-1]))))
        return pa.concat_arrays(ids).take(pa.array(np.argsort(np.concatenate(order))))

    def encode(self, texts: Iterable[str] | pa.Array) -> list[bytes]:
        split = pc.ascii_split_whitespace(texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        if self.words.full(self.cached_words):
            self.words, self.old_words = Known([""], [b""]), self.words
        words = split.flatten().dictionary_encode()
        raw, edges = _joined(self.words.look_up(words.dictionary, self.old_words, self._learn), words.indices)
        ends, ids = edges[split.offsets.to_numpy()].tolist(), memoryview(raw)
        return [bytes(ids[a:b]) for a, b in pairwise(ends)]


def _listed(names: pa.Array) -> list[str]:
    return names.to_numpy(zero_copy_only=False).tolist()


def _in_turn(learn: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    """The same for any number of names, ``AT_ONCE`` at a time."""
    return lambda names: pa.concat_arrays([learn(names.slice(at, AT_ONCE)) for at in range(0, len(names), AT_ONCE)])


@lru_cache(maxsize=2)
def word_encoder(path: str, dtype: str = "<u4", cached: tuple[int, int] = CACHED) -> WordEncoder:
    """The worker's own encoder."""
    return WordEncoder(path, dtype, cached)


def release_encoder() -> None:
    """Called by work that needs no encoder: Spark reuses Python workers, and one that packed before still holds its caches."""
    word_encoder.cache_clear()
    release_memory()


def release_memory() -> None:
    """Give back to the system what a reused worker's earlier tasks have freed; Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
