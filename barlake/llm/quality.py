"""Quality rules as a short-circuit cascade: each document meets the rules in turn and leaves at the first that rejects it.

A rule is a predicate over a document. On a bounded sample each rule is run by itself, which gives its cost in seconds, and all
of them together, which gives who rejects what. The order is then built greedily: next comes the rule that rejects most of the
sample's survivors per second. The cascade is one nested CASE expression, whose later branches Spark only evaluates for rows
that reach them, so verdicts need one pass and no shuffle. The order never changes a verdict, only what it costs: a document
is kept if no rule rejects it.

Words are maximal runs of characters other than space, tab to carriage return; lines are parts between ``\\n``. A null text has
no words. Ids may be null or repeated, every row is judged by itself, and an empty table gives no rows. A text is one row,
whatever its length; all counts are found in time that grows with n log n of its words at most. Columns other than doc_id and
text are not read.

``SAMPLE_ROWS`` bounds the sample and nothing else.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from barlake.llm.common import stored, texts_of

SAMPLE_ROWS = 2_000
TIMED_RUNS = 2
# Characters that count as symbols, what ends a word, and the two base rules' bounds.
SYMBOL = "[#*$%&|<>]"
WHITE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A named predicate, as SQL over ``text``, ``n_lines`` and the metrics, that is true for documents to reject."""

    name: str
    rejects: str


#: What the cascade rejects. The first two are the base rules.
RULES = (
    Rule("few_words", f"n_words < {LEAST_WORDS}"),
    Rule("repeated_windows", f"100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("digits", r"100 * length(regexp_replace(text, '[^0-9]+', '')) > 30 * word_chars"),
    Rule("capitals", r"2 * length(regexp_replace(text, '\\P{Lu}+', '')) > length(regexp_replace(text, '\\P{L}+', ''))"),
    Rule("without_letters", r"2 * size(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]*\\p{L}[^\\x20\\x09-\\x0D]*', 0)) < n_words"),
)


def document_metrics(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines and the metrics of each row.

    Windows of three words are compared by 64-bit hashes. Only texts with a repeated window look for the places: hashes are
    sorted together with their positions, so repeated ones are neighbours, and each place covers the words not covered yet.
    """
    rows = texts_of(docs)
    text = F.col("text")
    rows = rows.withColumns(
        {
            "words": F.array_remove(F.split(text, WHITE), ""),
            "lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("bigint"),
        }
    )
    starts = F.sequence(F.lit(0), F.size("words") - 3)
    windows = F.transform(starts, lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("bigint"),
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_lines": F.size("lines").cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
            "windows": F.when(F.size("words") >= 3, windows).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("words", "lines")
    places = F.transform("windows", lambda window, i: F.struct(window.alias("window"), i.alias("at")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("places", F.when(repeats, F.sort_array(places)))

    def neighbour(i: Column, step: int) -> Column:
        return F.coalesce(F.get("places", i + step)["window"] == F.get("places", i)["window"], F.lit(False))

    twice = F.filter(F.sequence(F.lit(0), F.size("places") - 1), lambda i: neighbour(i, -1) | neighbour(i, 1))
    at = F.sort_array(F.transform(twice, lambda i: F.get("places", i)["at"]))
    covered = F.aggregate(
        at,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("words")),
        lambda so_far, i: F.struct(i.alias("last"), (so_far["words"] + F.least(F.lit(3), i - so_far["last"])).alias("words")),
        lambda so_far: so_far["words"],
    )
    repeated = F.when(F.col("places").isNull(), F.lit(0).cast("bigint")).otherwise(covered)
    return rows.withColumn("n_repeat_words", repeated).select("doc_id", "text", "n_lines", *METRICS)


@dataclass(frozen=True)
class Measured:
    """A rule's place in the cascade: seconds a row, and the share of the rows that reach it which it rejects."""

    rule: Rule
    seconds: float
    rejects: float


def _seconds(sample: DataFrame, predicate: Column) -> float:
    best = None
    for _ in range(TIMED_RUNS):
        began = time.perf_counter()
        sample.agg(F.count_if(predicate)).collect()
        took = time.perf_counter() - began
        best = took if best is None else min(best, took)
    return best


def rule_order(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """The rules by rejections per cost among the rows that the earlier ones leave, from a sample of the rows."""
    if not rules:
        return []
    total = docs.count()
    few = docs.sample(min(1.0, sample_rows / max(total, 1)), seed=1).limit(2 * sample_rows)
    sample = stored(document_metrics(few), "quality-sample")
    empty = _seconds(sample, F.lit(False))
    costs = {rule: max(_seconds(sample, F.expr(rule.rejects)) - empty, 1e-6) for rule in rules}
    verdicts = F.array(*[F.coalesce(F.expr(rule.rejects), F.lit(False)) for rule in rules])
    # At most as many rows as the sample has.
    patterns = [(row.verdicts, row.n) for row in sample.groupBy(verdicts.alias("verdicts")).agg(F.count("*").alias("n")).collect()]
    sampled = max(sum(n for _, n in patterns), 1)
    order, left = [], list(range(len(rules)))
    while left:
        alive = sum(n for _, n in patterns)
        # A rule that rejects none of the sample counts as half a row, so cheap ones still come before dear ones.
        gained = {i: sum(n for verdict, n in patterns if verdict[i]) + 0.5 for i in left}
        best = max(left, key=lambda i: (gained[i] / costs[rules[i]], -i))
        order.append(Measured(rules[best], costs[rules[best]] / sampled, (gained[best] - 0.5) / max(alive, 1)))
        patterns = [(verdict, n) for verdict, n in patterns if not verdict[best]]
        left.remove(best)
    return order


def stopping_rule(order: Sequence[Measured]) -> Column:
    """Name of the first rule in this order that rejects the row, null if none does; rules after it are not evaluated."""
    stop = F.lit(None).cast("string")
    for measured in reversed(order):
        stop = F.when(F.expr(measured.rule.rejects), F.lit(measured.rule.name)).otherwise(stop)
    return stop


def judge_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the metrics, base_failed, kept and ``stopped_by`` of each row.

    ``stopped_by`` names the rule that ended the cascade; it depends on the measured order, the other columns do not.
    """
    metrics = document_metrics(docs)
    stop = stopping_rule(rule_order(docs, rules, sample_rows))
    base = F.expr(" OR ".join(f"({rule.rejects})" for rule in RULES[:2]))
    judged = metrics.select("doc_id", *METRICS, base.alias("base_failed"), stop.alias("stopped_by"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("stopped_by").isNull())
