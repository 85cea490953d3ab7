"""The training corpus: toxic documents and copies go, one document of each near-duplicate group stays, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import content_sort, jaccard, pack, toxicity
from barlake.llm.common import named_table, stored
from barlake.llm.queries import WORD_TOKENIZER
from barlake.llm.tokens import CACHED_FEW

#: Near-duplicates share this percentage of their shingles of so many words; op6 has stricter figures of its own.
NEAR_WIDTH, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.without_toxic(docs, named_table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return content_sort.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of near-duplicates connect."""
    return jaccard.one_of_each_group(docs, NEAR_PERCENT, NEAR_WIDTH)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; executors still hold the heap of the stages before, so workers cache few words."""
    return pack.piece_digests(pack.pack_documents(docs, WORD_TOKENIZER, cached=CACHED_FEW))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("packing", packing_stage),
]

#: SQL can neither learn the toxicity model nor tokenize; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on what the one before has written."""
    docs = named_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
