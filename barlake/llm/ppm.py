"""Language-model scores by prediction by partial matching over bytes.

A text is its words, A-Z lower-cased, joined by single spaces and closed by a line feed. A first pass counts word hashes of
the training documents and byte strings of ``ORDER + 1`` bytes of all documents, in training and in all; Spark sums both, and
shorter strings follow from longer ones. Nothing is pruned.

A byte is coded in its longest known context: seen there, with probability (count - 1/2) / total; otherwise an escape,
which has half a count of each kept symbol and all counts of the others, leads to the context shortened by a byte, where
the symbols of the longer context are excluded. Each distinct
string is scored once: strings are dealt by the last ``SHARED`` bytes of their context, so a task holds all that is known of
its longer contexts, and the levels up to ``SHARED`` bytes, at most 2 ** 24 strings, are broadcast.

Scores of strings with more than ``1 / KEPT`` of all bytes, fewer than ``KEPT``, go to the workers, which look up whole arrays
of byte positions and keep the results of frequent strings in a table; the rest is joined by shuffle, where by construction
none is hot.

The base score needs the exact count of every word. Words with at least ``1 / FREQUENT`` of all tokens, at most
``FREQUENT`` of them, go to the workers; the rest is joined by shuffle, where by construction none is hot.

Null and empty texts are the end token alone. Repeated rows are scored alike, each counted in training. Without training
rows every byte has probability 1/256 and the base is 1 (score 0). An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from barlake.llm.common import id_text_bucket, stored, sub_batches, texts_of

ORDER, KEPT, FREQUENT, FOLDS = 5, 1 << 22, 1 << 20, 10
WORD, STRING = 1, 0
END_HASH = -1
CACHED_WORDS, HELD_WORDS, HELD_STRINGS, SLICE = 200_000, 200_000, 2_000_000, 1 << 21
SLOT_BITS = 20
PAD = b"\n" * ORDER
SHARED, GROUPED = 2, 1 << 19


class WordHashes(dict):
    """64-bit hashes of words, kept while the cache is small."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word) >> 1
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value
        return value


def byte_strings(streams: list[bytes], order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of the streams: the stream each byte belongs to, and the byte with its ``order`` predecessors."""
    for first, at, chunk in _slices(streams):
        data = np.frombuffer(b"".join(chunk), np.uint8)
        lengths = np.array([len(c) for c in chunk])
        value = data[order:].astype(np.uint64)
        for back in range(1, order + 1):
            value |= data[order - back : len(data) - back].astype(np.uint64) << np.uint64(8 * back)
        real = np.ones(len(data), bool)
        starts = np.cumsum(lengths) - lengths
        real[(starts[:, None] + np.arange(order)).ravel()] = False
        owner = np.repeat(np.arange(first, first + len(chunk)), lengths - order)
        yield owner, value[real[order:]]


def _slices(streams: list[bytes]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Streams with their leading context, several short ones or a part of a long one at a time."""
    first, chunk, size = 0, [], 0
    for i, stream in enumerate(streams):
        if len(stream) > SLICE:
            if chunk:
                yield first, 0, chunk
            padded = PAD + stream
            for at in range(0, len(stream), SLICE):
                yield i, at, [padded[at : at + SLICE + ORDER]]
            first, chunk, size = i + 1, [], 0
            continue
        chunk.append(PAD + stream)
        size += len(stream)
        if size > SLICE:
            yield first, 0, chunk
            first, chunk, size = i + 1, [], 0
    if chunk:
        yield first, 0, chunk


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    both, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(both, kind="stable")
    both, n = both[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    return both[first], np.add.reduceat(n, first) if len(both) else n


def corpus_counts(docs: DataFrame) -> DataFrame:
    """kind, key, n and m: occurrences of every word hash in the training rows, and of every byte string in them and in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, words, held = WordHashes(), {}, 0
        keys: tuple[list, list] = ([], [])  # training rows, held-out rows
        counts: tuple[list, list] = ([], [])

        def rows(kind: int, key, n, m) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), kind, np.int8)), *(pa.array(np.asarray(x, np.int64)) for x in (key, n, m))],
                names=["kind", "key", "n", "m"],
            )

        def string_rows(out: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return rows(STRING, key, np.zeros(len(n), np.int64) if out else n, n)

        for batch in sub_batches(batches):
            split = [text.encode().lower().split() for text in batch.column(0).to_pylist()]
            held_out = batch.column(1).to_pylist()
            learnt = [ws for ws, out in zip(split, held_out, strict=True) if not out]
            values = np.fromiter((hashes[w] for ws in learnt for w in ws), np.int64)
            for value, n in zip(*(x.tolist() for x in np.unique(values, return_counts=True)), strict=True):
                words[value] = words.get(value, 0) + n
            if learnt:
                words[END_HASH] = words.get(END_HASH, 0) + len(learnt)
            for out, part in ((0, learnt), (1, [ws for ws, out in zip(split, held_out, strict=True) if out])):
                for _, strings in byte_strings([b" ".join(ws) + b"\n" for ws in part]):
                    unique, n = np.unique(strings, return_counts=True)
                    keys[out].append(unique)
                    counts[out].append(n)
                    held += len(unique)
            if held > HELD_STRINGS:
                held = 0
                for out in (0, 1):
                    if keys[out]:
                        merged = _summed(keys[out], counts[out])
                        keys[out][:], counts[out][:] = [merged[0]], [merged[1]]
                        held += len(merged[0])
                if held > HELD_STRINGS // 2:
                    for out in (0, 1):
                        if keys[out]:
                            yield string_rows(out, keys[out].pop(), counts[out].pop())
                    held = 0
            if len(words) > HELD_WORDS:
                yield rows(WORD, list(words), list(words.values()), list(words.values()))
                words = {}
        if words:
            yield rows(WORD, list(words), list(words.values()), list(words.values()))
        for out in (0, 1):
            if keys[out]:
                yield string_rows(out, *_summed(keys[out], counts[out]))

    found = docs.select("text", "held_out").mapInArrow(count, "kind tinyint, key bigint, n bigint, m bigint")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


class Trie:
    """Contexts of 0 to ``ORDER`` bytes with the symbols that follow them, as sorted arrays per order.

    ``total`` counts every occurrence of a context, also those followed by symbols that were not given. ``base`` has the
    levels that precede those of ``strings``.
    """

    def __init__(self, strings: list[tuple[np.ndarray, np.ndarray]], base: Trie | None = None):
        self.orders: list[dict[str, np.ndarray]] = list(base.orders) if base else []
        for order, (keys, counts) in enumerate(strings, len(self.orders)):
            sort = np.argsort(keys)
            keys, counts = keys[sort].astype(np.uint64), counts[sort].astype(np.float64)
            contexts, first, owner = np.unique(keys >> np.uint64(8), return_index=True, return_inverse=True)
            total = kept = np.add.reduceat(counts, first) if len(keys) else counts
            if order and len(keys):
                shorter = self.orders[-1]
                at = np.minimum(np.searchsorted(shorter["keys"], contexts), len(shorter["keys"]) - 1)
                total = np.maximum(kept, np.where(shorter["keys"][at] == contexts, shorter["counts"][at], 0.0))
            kinds = np.bincount(owner, minlength=len(contexts)).astype(np.float64)
            level = {
                "keys": keys, "counts": counts, "log": np.log10(counts - 0.5), "contexts": contexts, "owner": owner,
                "total": total, "kept": kept, "kinds": kinds,
            }
            level["whole"], level["escape"] = self._coding(total, kept, kinds)
            if order:
                self._exclude(level, self.orders[-1], first, order)
            self.orders.append(level)

    @staticmethod
    def _coding(total: np.ndarray, kept: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of a context's divisor and of its escape; half a count of each symbol goes to the escape."""
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = np.log10(total)
            left = total - kept + 0.5 * kinds
            return whole, np.where((left > 0) & (total > 0), np.log10(left) - whole, 0.0)

    def _exclude(self, level: dict, shorter: dict, first: np.ndarray, order: int) -> None:
        """What a context leaves of its suffix once its own symbols are excluded there."""
        below = np.searchsorted(shorter["keys"], level["keys"] & np.uint64((1 << 8 * order) - 1))
        taken = np.add.reduceat(shorter["counts"][below], first) if len(below) else level["total"]
        suffix = shorter["owner"][below[first]] if len(below) else first
        level["rest"], level["rest_escape"] = self._coding(
            shorter["total"][suffix] - taken, shorter["kept"][suffix] - taken, shorter["kinds"][suffix] - level["kinds"]
        )

    def log10(self, strings: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each string after the others."""
        out = np.zeros(len(strings))
        open_, longer = np.arange(len(strings)), np.full(len(strings), -1)
        for order in range(len(self.orders) - 1, -1, -1):
            level = self.orders[order]
            above = self.orders[order + 1] if order + 1 < len(self.orders) else None
            if not len(level["keys"]) or not len(open_):
                continue
            keys = strings[open_] & np.uint64((1 << 8 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(level["keys"], keys), len(level["keys"]) - 1)
            hit, came = level["keys"][at] == keys, longer >= 0
            divisor = level["whole"][level["owner"][at]]
            if above is not None and len(above["keys"]):
                divisor = np.where(came, above["rest"][longer], divisor)
            out[open_[hit]] += (level["log"][at] - divisor)[hit]
            open_, keys, longer, came = open_[~hit], keys[~hit], longer[~hit], came[~hit]
            context = keys >> np.uint64(8)
            place = np.minimum(np.searchsorted(level["contexts"], context), len(level["contexts"]) - 1)
            known = level["contexts"][place] == context
            step = np.where(known, level["escape"][place], 0.0)
            if above is not None and len(above["keys"]):
                step = np.where(came, above["rest_escape"][longer], step)
            out[open_] += step
            longer = np.where(known, place, -1)
        unseen = 256 - len(self.orders[0]["keys"])
        out[open_] -= np.log10(max(unseen, 1))
        return out


class CachedScores:
    """Scores of the byte strings in a sorted table (NaN for others), with a table of those met last."""

    def __init__(self, known: np.ndarray, scores: np.ndarray):
        self.known, self.scores = known, scores
        self.keys = np.full(1 << SLOT_BITS, np.uint64(2**64 - 1))
        self.values = np.zeros(1 << SLOT_BITS)

    def __call__(self, strings: np.ndarray) -> np.ndarray:
        slots = (strings * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)
        out = self.values[slots]
        missed = np.flatnonzero(self.keys[slots] != strings)
        if len(missed):
            wanted = strings[missed]
            if len(self.known):
                at = np.minimum(np.searchsorted(self.known, wanted), len(self.known) - 1)
                fresh = np.where(self.known[at] == wanted, self.scores[at], np.nan)
            else:
                fresh = np.full(len(wanted), np.nan)
            out[missed] = fresh
            self.keys[slots[missed]] = wanted
            # Of strings that share a slot the last one stays, in both arrays.
            self.values[slots[missed]] = fresh
        return out


def _shortened(keys: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    return _summed([keys & np.uint64((1 << 8 * (order + 1)) - 1)], [counts])


def shared_levels(counts: DataFrame) -> Trie:
    """The levels of contexts up to ``SHARED`` bytes; at most 2 ** 24 strings reach the driver."""
    short = F.col("key").bitwiseAND(F.lit((1 << 8 * (SHARED + 1)) - 1)).alias("key")
    table = counts.where((F.col("kind") == STRING) & (F.col("n") > 0)).groupBy(short).agg(F.sum("n").alias("n")).toArrow()
    keys, n = table.column(0).to_numpy().astype(np.uint64), table.column(1).to_numpy()
    return Trie([_shortened(keys, n, order) for order in range(SHARED + 1)])


def string_scores(counts: DataFrame) -> DataFrame:
    """key, m and score (log10 probability of the last byte) of every distinct string of the documents."""
    base = counts.sparkSession.sparkContext.broadcast(shared_levels(counts))
    group = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (SHARED + 1)) - 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scored(keys: np.ndarray, n: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
            learnt = n > 0
            trie = Trie([_shortened(keys[learnt], n[learnt], order) for order in range(SHARED + 1, ORDER + 1)], base.value)
            scores = trie.log10(keys)
            for at in range(0, len(keys), 10_000):
                part = slice(at, at + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part].astype(np.int64)), pa.array(m[part]), pa.array(scores[part])], names=["key", "m", "score"]
                )

        held, rows, enough = [], 0, GROUPED
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy() for i in range(3)))
            rows += batch.num_rows
            if rows < enough:
                continue
            keys, n, m = (np.concatenate(c) for c in zip(*held, strict=True))
            # Whole groups only: the last one may go on.
            groups = keys >> 8 & (1 << 8 * (SHARED + 1)) - 1
            cut = int(np.searchsorted(groups, groups[-1]))
            if cut:
                yield from scored(keys[:cut].astype(np.uint64), n[:cut], m[:cut])
            held, rows = [(keys[cut:], n[cut:], m[cut:])], len(keys) - cut
            enough = GROUPED + rows
        if rows:
            keys, n, m = (np.concatenate(c) for c in zip(*held, strict=True))
            yield from scored(keys.astype(np.uint64), n, m)

    strings = counts.where(F.col("kind") == STRING).select("key", "n", "m")
    dealt = strings.withColumn("_group", group).repartition("_group").sortWithinPartitions("_group").drop("_group")
    return dealt.mapInArrow(score, "key bigint, m bigint, score double")


def score_documents(docs: DataFrame, folds: int = FOLDS, frequent: int = FREQUENT, kept: int = KEPT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    rows = texts_of(docs).withColumn("held_out", id_text_bucket(F.col("doc_id"), folds) == 0)
    counts = stored(corpus_counts(rows), "ppm-counts")
    strings = stored(string_scores(counts), "ppm-strings")
    often = F.col("m") > F.lit((strings.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]) / kept)
    common = strings.where(often).select("key", "score").toArrow().sort_by("key")
    words = counts.where(F.col("kind") == WORD)
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    divisor = tokens + 0.1 * (kinds + 1)
    table = words.where(F.col("n") >= F.lit(max(1.0, tokens / frequent))).select("key", "n").toArrow().sort_by("key")
    model = spark.sparkContext.broadcast((common.column(0).to_numpy().astype(np.uint64), common.column(1).to_numpy(), table.column(0).to_numpy(), table.column(1).to_numpy()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings_known, string_logs, known, known_counts = model.value
        cached, hashes = CachedScores(strings_known, string_logs), WordHashes()
        row, task = 0, TaskContext.get().partitionId()
        logs = np.log10((known_counts + 0.1) / divisor)
        for batch in sub_batches(batches):
            split = [text.encode().lower().split() for text in batch.column(1).to_pylist()]
            lengths = np.array([len(ws) + 1 for ws in split])
            owner = np.repeat(np.arange(len(split)), lengths)
            values = np.fromiter((h for ws in split for h in (*map(hashes.__getitem__, ws), END_HASH)), np.int64, len(owner))
            if len(known):
                at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                found = known[at] == values
                base = np.bincount(owner[found], logs[at[found]], len(split))
            else:
                found, base = np.zeros(len(values), bool), np.zeros(len(split))
            seen = np.bincount(owner[found], minlength=len(split))
            total, rare, rare_owner = np.zeros(len(split)), [], []
            for own, strings in byte_strings([b" ".join(ws) + b"\n" for ws in split]):
                scores = cached(strings)
                missed = np.isnan(scores)
                total += np.bincount(own[~missed], scores[~missed], len(split))
                rare.append(strings[missed].astype(np.int64))
                rare_owner.append(own[missed])
            rest, rest_owner = values[~found], owner[~found]
            edges = np.searchsorted(rest_owner, np.arange(len(split) + 1)).astype(np.int32)
            string_edges = np.searchsorted(np.concatenate(rare_owner), np.arange(len(split) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(split)) + (task << 35)), batch.column(0), batch.column(2),
                    pa.array(lengths.astype(np.int64)), pa.array(seen.astype(np.int64)), pa.array(base), pa.array(total),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(rest)),
                    pa.ListArray.from_arrays(pa.array(string_edges), pa.array(np.concatenate(rare))),
                ],
                names=["_row", "doc_id", "held_out", "n_tokens", "_seen", "_base", "_score", "_rest", "_rare"],
            )
            row += len(split)

    scored = stored(
        rows.mapInArrow(
            score,
            "_row bigint, doc_id bigint, held_out boolean, n_tokens bigint, _seen bigint, _base double, _score double, _rest array<bigint>, _rare array<bigint>",
        ),
        "ppm-scores",
    )
    rare = words.where(F.col("n") < F.lit(max(1.0, tokens / frequent))).select("key", "n")
    n = F.coalesce("n", F.lit(0))
    rest = (
        scored.select("_row", F.explode("_rest").alias("key")).join(rare, "key", "left")
        .groupBy("_row").agg(
            F.sum(F.log10((n + 0.1) / F.lit(divisor))).alias("_more"), F.sum((n > 0).cast("bigint")).alias("_more_seen")
        )
    )
    rare_strings = (
        scored.select("_row", F.explode("_rare").alias("key")).join(strings.where(~often).select("key", "score"), "key")
        .groupBy("_row").agg(F.sum("score").alias("_more_score"))
    )
    return scored.drop("_rest", "_rare").join(rest, "_row", "left").join(rare_strings, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("_seen") + F.coalesce("_more_seen", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"), (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"),
        (F.col("_score") + F.coalesce("_more_score", F.lit(0.0))).alias("score"),
    )
