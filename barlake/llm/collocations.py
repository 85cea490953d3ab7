"""Phrases of two to five words that occur together more often than their parts suggest, mined by the SON scheme.

Documents are dealt into ``SHARDS`` shards by a hash of id and text. A shard is mined completely, level by level, at the
support that its share of a language's words leaves: a phrase that occurs ``support`` times in all has to reach that in at
least one shard. The phrases frequent in any shard are candidates, and a last pass counts every candidate over all documents
exactly. The number of shards does not depend on the input, so neither does the local support; a shard is not held by one
task but counted by all of them, so its size is not bounded by memory.

Words are counted first, then pairs of words that are frequent in the shard, then all longer phrases of frequent pairs.
Tasks know what is frequent from a bitmap of at most ``2 ** MAX_BITS`` bits, written as a small table; a bit set by another
phrase costs work, never a result. Before the last pass phrases are 64-bit hashes, whose collisions can only add candidates;
the last pass counts the phrases themselves.

Null texts are empty; a null language is ``und``. Repeated rows count as often as they occur. Texts of any length are read
whole; empty ones and empty tables have no phrases. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.llm.common import join_hot, scratch_dir, stored, sub_batches
from barlake.llm.jaccard import mixed
from barlake.operators.chunks import join_parameters

LONGEST, SUPPORT, TOP = 5, 100, 2000
# Lengths that one pass counts. Few longer phrases consist of frequent pairs, so they share a pass.
LEVELS = ((1,), (2,), tuple(range(3, LONGEST + 1)))
SHARDS = 8
MAX_BITS = 28
FLUSH_WORDS = 1 << 20
NO_LANGUAGE = "und"
# Characters that end a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
# No UTF-8 text contains this byte.
_BREAK = b"\xff"
_PIECES = bytes.maketrans(PIECE_ENDS, _BREAK * len(PIECE_ENDS))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_GRAMS = "lang string, shard int, gram bigint, n bigint"


def tokens_of(text: str) -> list[bytes]:
    """Lower-cased words, with a break between pieces."""
    return text.encode().lower().translate(_PIECES).replace(_BREAK, b" \xff ").split()


class Vocabulary(dict):
    """Numbers of words as they appear, with their hashes; the break is number 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self.words, self.hashes = [_BREAK], [0]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


def shard_salt(shard: int) -> np.uint64:
    """Sets the bits of a shard apart; shard -1 stands for all of them together."""
    return mixed(np.array([shard + 2], np.uint64) * _STEP)[0]


def gram_hashes(ids: np.ndarray, hashes: np.ndarray, lang: str) -> Iterator[np.ndarray]:
    """For each length the hashes of the phrases that start at each word."""
    words = mixed(hashes[ids] + np.uint64(xxhash.xxh3_64_intdigest(lang.encode())))
    grams = words
    yield grams
    for length in range(2, LONGEST + 1):
        grams = mixed(grams[: max(len(ids) - length + 1, 0)] * _STEP + words[length - 1 :])
        yield grams


def whole_phrases(ids: np.ndarray, length: int) -> np.ndarray:
    """Which positions start ``length`` words without a break among them."""
    breaks = np.concatenate([[0], np.cumsum(ids == 0)])
    return breaks[length:] == breaks[:-length] if len(ids) >= length else np.zeros(0, bool)


# Bitmaps of frequent phrases.


@dataclass(frozen=True)
class Bitmap:
    """A set of hashes as rows (word, bits) of a table in the shared folder."""

    path: str
    bits: int

    def marks(self, grams: np.ndarray, shard: int) -> np.ndarray:
        at = (grams ^ shard_salt(shard)) & np.uint64((1 << self.bits) - 1)
        return (_bitmap_words(self)[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


@lru_cache(maxsize=2)
def _bitmap_words(bitmap: Bitmap) -> np.ndarray:
    words = np.zeros(1 << (bitmap.bits - 6), np.uint64)
    fs, root = pafs.FileSystem.from_uri(bitmap.path)
    for batch in pads.dataset(root, format="parquet", filesystem=fs).to_batches(columns=["word", "bits"], batch_readahead=1, fragment_readahead=1):
        words[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return words


def bitmap_of(grams: DataFrame, rows: int) -> Bitmap:
    """Bits of the hashes ``gram`` in ``shard``; sixteen bits a row, unless that exceeds the largest bitmap."""
    bits = min(MAX_BITS, max(12, (16 * rows).bit_length()))
    salts = np.array([shard_salt(shard) for shard in range(-1, SHARDS)]).view(np.int64).tolist()
    salt = F.get(F.array(*map(F.lit, salts)), F.col("shard") + 1)
    at = F.col("gram").bitwiseXOR(salt).bitwiseAND(F.lit((1 << bits) - 1))
    words = grams.select(F.shiftrightunsigned(at, 6).alias("word"), F.expr("1L").alias("one"), at.bitwiseAND(F.lit(63)).cast("int").alias("at"))
    path = f"{scratch_dir(grams.sparkSession, 'phrase-bits')}/table"
    words.groupBy("word").agg(F.expr("bit_or(shiftleft(one, at))").alias("bits")).write.parquet(path)
    return Bitmap(path, bits)


# Counting.


def _sharded(docs: DataFrame) -> DataFrame:
    shard = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(SHARDS)).cast("int")
    return docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), shard.alias("shard"), F.coalesce("text", F.lit("")).alias("text"))


def _parts_of(batches: Iterator[pa.RecordBatch], per_shard: bool) -> Iterator[tuple[Vocabulary, dict[tuple[str, int], np.ndarray]]]:
    """Numbered words by language and shard, in parts of about ``FLUSH_WORDS`` words and whole documents."""
    known, parts, held = Vocabulary(), defaultdict(list), 0
    number, end = known.__getitem__, np.zeros(1, np.int32)
    for batch in sub_batches(batches):
        for lang, shard, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            words = tokens_of(text)
            parts[lang, shard if per_shard else -1] += [np.fromiter(map(number, words), np.int32, len(words)), end]
            held += len(words)
            if held >= FLUSH_WORDS:
                yield known, {key: np.concatenate(ids) for key, ids in parts.items()}
                known, parts, held = Vocabulary(), defaultdict(list), 0
                number = known.__getitem__
    if parts:
        yield known, {key: np.concatenate(ids) for key, ids in parts.items()}


def shard_counts(docs: DataFrame, lengths: Sequence[int], shorter: Bitmap | None) -> DataFrame:
    """How often phrases of these lengths occur in each shard, if all their parts in ``shorter``, one word less than the
    first length, may be frequent there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, parts in _parts_of(batches, per_shard=True):
            hashes = np.array(known.hashes, np.uint64)
            for (lang, shard), ids in parts.items():
                possible = np.ones(len(ids) + 1, bool)
                for size, grams in enumerate(gram_hashes(ids, hashes, lang), 1):
                    if size > lengths[-1] or not len(grams):
                        break
                    if size < lengths[0]:
                        possible = shorter.marks(grams, shard) if size == lengths[0] - 1 else possible
                        continue
                    possible = possible[:-1] & possible[1:]
                    found, n = np.unique(grams[possible & whole_phrases(ids, size)], return_counts=True)
                    if len(found):
                        yield pa.RecordBatch.from_arrays(
                            [_repeated(lang, len(found)), pa.array(np.full(len(found), shard, np.int32)), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                            names=["lang", "shard", "gram", "n"],
                        )

    return docs.mapInArrow(count, _GRAMS).groupBy("lang", "shard", "gram").agg(F.sum("n").alias("n"))


def _repeated(text: str, count: int) -> pa.Array:
    return pa.DictionaryArray.from_arrays(pa.array(np.zeros(count, np.int32)), pa.array([text])).cast(pa.string())


def local_supports(words: DataFrame, support: int) -> DataFrame:
    """What ``support`` occurrences in all come to in the share of each shard, rounded up."""
    own = words.groupBy("lang", "shard").agg(F.sum("n").alias("own"))
    total = own.groupBy("lang").agg(F.sum("own").alias("total"))
    need = F.expr(f"(cast({support} as decimal(10)) * own + total - 1) div total")
    return stored(own.join(total, "lang").select("lang", "shard", "own", "total", need.alias("need")), "phrase-supports")


def frequent_phrases(docs: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to five words with at least ``support`` occurrences in their language, and each language's words.

    lang, phrase (words joined by spaces), size and f; and lang, total.
    """
    rows = _sharded(docs)
    words = stored(shard_counts(rows, LEVELS[0], None), "phrase-words")
    supports = local_supports(words, support)
    candidates, shorter = [], None
    for lengths in LEVELS:
        counts = words if lengths == LEVELS[0] else shard_counts(rows, lengths, shorter)
        local = join_parameters(counts, supports.select("lang", "shard", "need"), ["lang", "shard"], spread=["gram"]).where("n >= need")
        local = stored(local.select("shard", "gram"), "phrase-local")
        found = local.count()
        if not found:
            break
        candidates.append(local)
        if lengths != LEVELS[-1]:
            shorter = bitmap_of(local, found)
    totals = supports.select("lang", "total").distinct()
    if not candidates:
        return docs.sparkSession.createDataFrame([], "lang string, phrase string, size int, f bigint"), totals
    union = candidates[0]
    for other in candidates[1:]:
        union = union.unionByName(other)
    union = stored(union.select("gram").distinct().withColumn("shard", F.lit(-1)), "phrase-candidates")
    return stored(exact_counts(rows, bitmap_of(union, union.count())).where(F.col("f") >= support), "phrase-frequent"), totals


def exact_counts(docs: DataFrame, candidates: Bitmap) -> DataFrame:
    """Occurrences over all documents of the phrases whose hash may be a candidate, by the phrase itself."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, parts in _parts_of(batches, per_shard=False):
            hashes = np.array(known.hashes, np.uint64)
            for (lang, _), ids in parts.items():
                possible = np.ones(len(ids) + 1, bool)
                for size, grams in enumerate(gram_hashes(ids, hashes, lang), 1):
                    if not len(grams):
                        break
                    # A phrase is as frequent as its parts at most, so those of a candidate are candidates too.
                    possible = possible[:-1] & possible[1:]
                    at = np.flatnonzero(possible & whole_phrases(ids, size))
                    at = at[candidates.marks(grams[at], -1)]
                    possible = np.zeros(len(grams), bool)
                    possible[at] = True
                    found, first, n = np.unique(grams[at], return_index=True, return_counts=True)
                    if len(found):
                        starts = at[first].tolist()
                        spelled = [b" ".join([known.words[i] for i in ids[s : s + size].tolist()]) for s in starts]
                        yield pa.RecordBatch.from_arrays(
                            [_repeated(lang, len(found)), pa.array(spelled, pa.binary()).cast(pa.string()), pa.array(np.full(len(found), size, np.int32)), pa.array(n.astype(np.int64))],
                            names=["lang", "phrase", "size", "n"],
                        )

    counted = docs.mapInArrow(count, "lang string, phrase string, size int, n bigint")
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f"))


# Scores.


def _part(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def cut_scores(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Every frequent phrase of two words or more with its lowest-scoring cut: lang, phrase, size, a, l, r, n and score."""
    counts = frequent.select(F.struct("lang", "phrase").alias("part"), F.col("f").alias("part_f"))
    phrases = frequent.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = stored(
        cuts.select("lang", "phrase", "size", "a", "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")),
        "phrase-cuts",
    )
    total = cuts.count()
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.withColumn("part", F.struct("lang", F.col(side).alias("phrase")))
        # Many phrases may share a part, so its cuts are counted and hot parts are met apart.
        shared = cuts.groupBy("part").agg(F.count("*").alias("cuts")).join(counts, "part")
        cuts = join_hot(cuts, shared, "part", "cuts", total, ["phrase"]).withColumnRenamed("part_f", name).drop("cuts", "part")
    exact = join_parameters(cuts, totals, ["lang"], spread=["phrase"]).withColumn(
        "score",
        F.expr("((cast(1000 as decimal(4)) * cast(a as decimal(15))) * cast(total as decimal(16))) div (cast(l as decimal(18)) * cast(r as decimal(18)))"),
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return exact.groupBy("lang", "phrase", "size", "a").agg(lowest, F.max("total").alias("n")).select(
        "lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def not_inside(phrases: DataFrame) -> DataFrame:
    """Phrases without a longer phrase around them that is as frequent.

    If any longer one is, so is each phrase between the two, so one word more on either side is enough to look at.
    """
    words = F.split("phrase", " ")
    around = phrases.where("size > 2").select("lang", "a", F.col("size"), words.alias("words"))
    inner = around.select("lang", "a", F.explode(F.array(_part(F.lit(1), F.col("size") - 1), _part(F.lit(2), F.col("size") - 1))).alias("phrase"))
    outer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_outer"))
    return phrases.join(outer, ["lang", "phrase"], "left").where("_outer IS NULL OR _outer < a").drop("_outer")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's ``top`` phrases by their weakest cut."""
    frequent, totals = frequent_phrases(docs, support)
    scored = stored(cut_scores(frequent, totals), "phrase-scores")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = not_inside(scored).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
