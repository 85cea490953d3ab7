"""Toxicity scores of texts whose words may be disguised.

A token that is not a plain word becomes a lattice: each run of one character offers the letters it may stand for (digits
and signs that look like letters, repeated letters once or twice), nothing or the end of a word (separators), each at a cost.
Viterbi decoding under a character trigram model picks the cheapest reading. Single letters that follow each other, spaced
out, with or without punctuation, are decoded together, where a word may end anywhere. Long inputs are decoded in parts that
overlap. The trigram counts cover all documents.

The restored words and their beginnings are the features of a logistic regression. It is fitted on at most ``TRAIN_DOCS``
labelled rows, those with the smallest id hashes; rows whose crc32 of the id modulo ``FOLDS`` is 0 never take part. Only the
text enters a score. Features are chosen by their significance over these rows (log likelihood ratio).

Whole texts are scored; null is empty. Several labels of one doc_id count as toxic if one of them is; null labels and ids
are ignored. Repeated rows score alike. Without labels of both kinds every score is the smoothed share of toxic rows, below
0.5 unless most are toxic. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barlake.llm.common import id_text_bucket, stored, sub_batches, texts_of
from barlake.llm.tokens import release_encoder

FOLDS, TRAIN_DOCS, FEATURES, LEAST_GAIN = 5, 20_000, 5_000, 10.0
THRESHOLD, CACHED_TOKENS, HELD_FEATURES = 0.5, 600_000, 500_000
SCORED = "doc_id bigint, held_out boolean, score double, predicted int"
# What digits and signs may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
    "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = frozenset(".-_*~'`^/\\|,:;·•")
EDGES = ".,;:!?\"'()[]{}<>%&*#-_/\\|~^`=«»„“”‘’…—–"
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
SIZE = len(LETTERS) + 2  # a boundary (0) and one class for all other letters (last)
CODES = {letter: i for i, letter in enumerate(LETTERS, 1)}
# Costs in powers of ten.
LOOKALIKE, DROP_LOOKALIKE, DROP_SEPARATOR, DROP_OTHER, SHORTEN, SPLIT = 0.5, 4.0, 0.1, 1.0, 0.3, 0.5


# The character model.


def _code_table() -> np.ndarray:
    """Code of every character below 2**16; letters outside the model share one."""
    table = np.array([SIZE - 1 if chr(c).isalpha() else 0 for c in range(1 << 16)], np.int64)
    for letter, code in CODES.items():
        table[ord(letter)] = code
    return table


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of (before, before, letter or boundary) over all documents; at most ``SIZE ** 3`` rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoder()
        table, total = _code_table(), np.zeros(SIZE**3, np.int64)
        for batch in sub_batches(batches):
            text = "\n\n".join(["", *batch.column(0).to_pylist(), ""]).lower()
            for at in range(0, len(text), 1 << 20):
                points = np.frombuffer(text[max(0, at - 2) : at + (1 << 20)].encode("utf-32-le", "replace"), np.uint32)
                codes = table[np.minimum(points, (1 << 16) - 1)]
                first, second, third = codes[:-2], codes[1:-1], codes[2:]
                word = (second > 0) | (third > 0)
                key = (np.where(second > 0, first, 0) * SIZE + second) * SIZE + third
                total += np.bincount(key[word], minlength=SIZE**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["key", "n"])

    counts = np.zeros(SIZE**3, np.int64)
    found = docs.select("text").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    for row in found.collect():
        counts[row.key] = row.n
    return counts


def trigram_costs(counts: np.ndarray, weight: float = 20.0) -> list[float]:
    """Negative log10 probabilities, each order smoothed by the one below."""
    cube = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
    pairs = cube.sum(0)
    single = (pairs.sum(0) + 1.0) / (pairs.sum() + SIZE)
    double = (pairs + weight * single) / (pairs.sum(1, keepdims=True) + weight)
    triple = (cube + weight * double) / (cube.sum(2, keepdims=True) + weight)
    return (-np.log10(triple)).ravel().tolist()


# Restoring words.


def _groups(token: str) -> list[tuple[str, int]]:
    groups, at = [], 0
    while at < len(token):
        end = at + 1
        while end < len(token) and token[end] == token[at]:
            end += 1
        groups.append((token[at], end - at))
        at = end
    return groups


def _arcs(character: str, run: int) -> list[tuple[str, float]]:
    """What a run of one character may stand for, with costs."""
    if character.isalpha():
        if run == 1:
            return [(character, 0.0)]
        once = SHORTEN * 2 if run == 2 else SHORTEN
        return [(character, once), (character * 2, 0.0 if run == 2 else SHORTEN)]
    arcs = []
    for letter in LOOKALIKES.get(character, ""):
        arcs.append((letter, LOOKALIKE if run == 1 else LOOKALIKE + SHORTEN))
        if run > 1:
            arcs.append((letter * 2, LOOKALIKE))
    drop = DROP_SEPARATOR if character in SEPARATORS else DROP_LOOKALIKE if arcs else DROP_OTHER
    return [*arcs, ("", drop)] if character.isdigit() else [*arcs, ("", drop), (" ", SPLIT)]


def decode(token: str, costs: list[float], spaced: bool = False) -> list[str]:
    """The words of the cheapest path through the token's lattice."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for character, run in _groups(token):
        # Spaced letters are written out, so a repeated one is two letters.
        arcs = [(character * run, 0.0)] if spaced and character.isalpha() else _arcs(character, run)
        reached: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, path) in states.items():
            starts = [(a, b, cost, path)]
            if spaced and b:
                starts.append((0, 0, cost + SPLIT + costs[(a * SIZE + b) * SIZE], path + " "))
            for first, second, spent, text in starts:
                for letters, price in arcs:
                    x, y, total = first, second, spent + price
                    if letters == " ":
                        if second:
                            total += costs[(x * SIZE + y) * SIZE]
                            if (0, 0) not in reached or total < reached[0, 0][0]:
                                reached[0, 0] = (total, text + letters)
                        continue
                    for letter in letters:
                        code = CODES.get(letter, SIZE - 1)
                        total += costs[(x * SIZE + y) * SIZE + code]
                        x, y = y, code
                    old = reached.get((x, y))
                    if old is None or total < old[0]:
                        reached[x, y] = (total, text + letters)
        states = reached
    # A word that a separator has ended is paid for.
    best = min((cost if path and not b else cost + costs[(a * SIZE + b) * SIZE], path) for (a, b), (cost, path) in states.items())
    return best[1].split()


LONGEST_TOKEN, STEP = 64, 32


def decode_long(token: str, costs: list[float], spaced: bool = False) -> list[str]:
    """The words of a token of any length, decoded in parts that overlap; words that a cut may have broken come from the other part."""
    words: list[str] = []
    for at in range(0, max(1, len(token) - STEP), STEP):
        part = decode(token[at : at + LONGEST_TOKEN], costs, spaced)
        first, last = int(at > 0), len(part) - int(at + LONGEST_TOKEN < len(token))
        words += part[first:last] if first < last else part
    return words


def restored_words(token: str, costs: list[float]) -> list[str]:
    """The words that a token without white space, lower-cased, stands for; parts of a long token are decoded apart."""
    core = token.strip(EDGES)
    words = [core] if core.isalpha() else []
    doubtful = not words or any(a == b == c for a, b, c in zip(core, core[1:], core[2:], strict=False))
    lead = token[: len(token) - len(token.lstrip(EDGES))]
    if doubtful or "!" in lead or "(" in lead or "|" in lead:
        if any(c.isalpha() for c in token):
            words += decode_long(token.rstrip(EDGES), costs)
    return words


def spaced_letter(token: str) -> str | None:
    """The letter or lookalike that a token is but for its punctuation, nothing for punctuation alone, null for any other."""
    core = token if len(token) == 1 and token in LOOKALIKES else token.strip(EDGES)
    return core if not core or len(core) == 1 and (core.isalpha() or core in LOOKALIKES) else None


def spaced_runs(tokens: list[str], least: int = 3) -> Iterator[str]:
    """Single characters that follow each other as tokens, joined; punctuation at or between them is left out."""
    run: list[str] = []
    for token in [*tokens, "  "]:
        letter = spaced_letter(token)
        if letter is not None:
            run.append(letter)
            continue
        joined = "".join(run)
        if len(joined) >= least and any(c.isalpha() for c in joined):
            yield joined
        run = []


def word_features(words: Iterable[str]) -> list[str]:
    features = []
    for word in words:
        if len(word) >= 3:
            features.append(word)
            features += [f"{word[:n]}~" for n in (4, 5) if len(word) > n]
    return features


class Features:
    """Features of texts. With an index, only those in it, as numbers."""

    def __init__(self, costs: list[float], index: dict[str, int] | None = None):
        self.costs, self.index, self.cache, self.single = costs, index, {}, set()

    def _known(self, words: list[str]) -> tuple:
        features = word_features(words)
        return tuple(features if self.index is None else [self.index[f] for f in features if f in self.index])

    def __call__(self, text: str) -> set:
        tokens = text.lower().split()
        if len(self.cache) > CACHED_TOKENS:
            self.cache, self.single = {}, set()
        cache, found = self.cache, set()
        for token in set(tokens):
            features = cache.get(token)
            if features is None:
                features = cache[token] = self._known(restored_words(token, self.costs))
                if spaced_letter(token):
                    self.single.add(token)
            found.update(features)
        if sum(map(self.single.__contains__, tokens)) >= 3:
            for run in spaced_runs(tokens):
                found.update(self._known(decode_long(run, self.costs, spaced=True)))
        return found


# Learning and scoring.


def training_rows(docs: DataFrame, labels: DataFrame, folds: int, limit: int) -> DataFrame:
    """text and toxic to learn from: one row for each of ``limit`` labelled ids at most, which are broadcast.

    Of an id with several texts, the one with the smallest hash is taken, so ids that repeat do not enlarge the sample.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = known.where(id_text_bucket(F.col("doc_id"), folds) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = docs.join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return one.select("least.text", "toxic")


def significant_features(rows: DataFrame, costs: list[float], most: int) -> tuple[list[str], int, int]:
    """Features more frequent in toxic rows, by their likelihood ratio, and the numbers of toxic and other rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract, counts = Features(costs), {}

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))],
                names=["feature", "clean", "toxic"],
            )

        for batch in sub_batches(batches):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for feature in extract(text) | {""}:
                    counts.setdefault(feature, [0, 0])[toxic > 0] += 1
            if len(counts) > HELD_FEATURES:
                yield flushed()
                counts.clear()
        yield flushed()

    counts = stored(
        rows.mapInArrow(count, "feature string, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "toxic-features",
    )
    all_ = counts.where("feature = ''").select("clean", "toxic").first()
    clean, toxic = (all_.clean, all_.toxic) if all_ else (0, 0)
    if not clean or not toxic:
        return [], toxic, clean
    both, n = F.col("clean") + F.col("toxic"), clean + toxic

    def term(part, whole):
        return F.when(part > 0, part * F.log(part / whole)).otherwise(0.0)

    gain = term(F.col("toxic"), both * F.lit(toxic / n)) + term(F.col("clean"), both * F.lit(clean / n))
    best = (
        counts.where((F.col("feature") != "") & (F.col("toxic") >= 2) & (F.col("toxic") * clean > F.col("clean") * toxic))
        .where(gain >= LEAST_GAIN).orderBy(gain.desc(), "feature").limit(most)
    )
    return [row.feature for row in best.select("feature").collect()], toxic, clean


def fit_logistic(rows: list[list[int]], toxic: np.ndarray, size: int, steps: int = 300, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-regularised logistic regression on sets of features."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.array([f for r in rows for f in r], np.int64)
    weights, squares = np.zeros(size + 1), np.full(size + 1, 1e-8)
    weights[-1] = np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5))
    for _ in range(steps):
        margin = weights[-1] + np.bincount(owner, weights[feature], len(rows))
        error = (1.0 / (1.0 + np.exp(-np.clip(margin, -50, 50))) - toxic) / len(rows)
        gradient = np.append(np.bincount(feature, error[owner], size), error.sum())
        gradient[:-1] += penalty * weights[:-1]
        squares += gradient**2
        weights -= 0.5 * gradient / np.sqrt(squares)
    return weights[:-1], float(weights[-1])


class Model:
    """What a worker needs to score texts."""

    def __init__(self, costs: list[float], index: dict[str, int], weights: np.ndarray, intercept: float):
        self.costs, self.index, self.weights, self.intercept = costs, index, weights, intercept

    def scorer(self):
        extract = Features(self.costs, self.index)

        def score(texts: list[str | None]) -> np.ndarray:
            margins = np.array([self.intercept + self.weights[list(extract(text or ""))].sum() for text in texts])
            return 1.0 / (1.0 + np.exp(-np.clip(margins, -50, 50)))

        return score


def fit_model(
    docs: DataFrame, labels: DataFrame, folds: int = FOLDS, train_docs: int = TRAIN_DOCS, features: int = FEATURES
) -> Model:
    """Character costs from all documents, weights from the bounded training rows."""
    rows = texts_of(docs)
    costs = trigram_costs(trigram_counts(rows))
    sample = stored(training_rows(rows, labels, folds, train_docs), "toxic-rows")
    names, toxic, clean = significant_features(sample, costs, features)
    index = {name: i for i, name in enumerate(names)}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Features(costs, index)
        for batch in sub_batches(batches):
            found = [sorted(extract(text)) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])

    if not names:
        return Model(costs, index, np.zeros(0), float(np.log((toxic + 0.5) / (clean + 1.5))))
    learnt = sample.mapInArrow(indexed, "toxic int, found array<int>").collect()
    weights, intercept = fit_logistic([r.found for r in learnt], np.array([float(r.toxic > 0) for r in learnt]), len(names))
    return Model(costs, index, weights, intercept)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, **limits: int) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit_model(docs, labels, folds, **limits))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoder()
        scored = model.value.scorer()
        for batch in sub_batches(batches):
            scores = scored(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    held_out = (id_text_bucket(F.col("doc_id"), folds) == 0).alias("held_out")
    return texts_of(docs).select("doc_id", "text", held_out).mapInArrow(score, SCORED)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text is not predicted toxic: one pass, no join by id."""
    model = docs.sparkSession.sparkContext.broadcast(fit_model(docs, labels))
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoder()
        scored = model.value.scorer()
        for batch in sub_batches(batches):
            yield batch.filter(pa.array(scored(batch.column(at).to_pylist()) < THRESHOLD))

    return docs.mapInArrow(clean, docs.schema)
