"""Exact deduplication by content sort.

Normalised texts are range-partitioned by splitters that Spark samples from them and sorted within their range by the
external sorter, so equal texts lie next to each other. The window over the text then compares neighbours in full: range
partitioning already satisfies its distribution, so the texts are shuffled once. The sort key starts with the first
``PREFIX`` characters and a hash of the text, so a splitter is short and texts with one long beginning still spread.

A text that more than ``1 / HOT_SLOTS`` of the rows share is dealt into several ranges by a salt: a count per text
hash, combined before its shuffle, finds such texts, of which there are at most ``HOT_SLOTS``. The leaders of the
salted runs, one per salt, are compared by text once more.

Only DataFrame functions are used. A null text is empty, and empty texts equal each other. Among equal texts the row
with the most code points in the original stays, then the smallest doc_id (a null doc_id last), then any one of equal
rows: exactly one row of a group is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.llm.common import HOT_SLOTS, bounded, stored, texts_of

PREFIX = 32
SPACE = " \t\n\x0b\f\r"


def without_spaces(text: Column) -> Column:
    for character in SPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def equal_texts(docs: DataFrame, slots: int = HOT_SLOTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256, one row per row of ``docs``."""
    rows = texts_of(docs).select("doc_id", F.length("text").alias("_n"), without_spaces(F.col("text")).alias("_norm"))
    hashes = stored(rows.groupBy(F.xxhash64("_norm").alias("_hash")).agg(F.count("*").alias("_rows")).where("_rows > 1"), "sort-hashes")
    total = max(docs.count(), 1)
    hot = hashes.where(F.col("_rows") > total / slots).select(
        "_hash", F.ceil(F.col("_rows") * F.lit(2.0 * slots / total)).alias("_salts")
    )
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64("doc_id", "_n"), F.col("_salts")) + 1).otherwise(F.lit(0))
    salted = (
        rows.withColumn("_hash", F.xxhash64("_norm"))
        .join(F.broadcast(hot), "_hash", "left")
        .select("doc_id", "_n", "_norm", "_hash", F.left("_norm", F.lit(PREFIX)).alias("_start"), salt.cast("bigint").alias("_salt"))
    )
    content = ["_start", "_hash", "_salt", "_norm"]
    run = Window.partitionBy(*content)
    first = run.orderBy(F.col("_n").desc(), F.col("doc_id").asc_nulls_last())
    sorted_rows = salted.repartitionByRange("_start", "_hash", "_salt").sortWithinPartitions(
        *content, F.col("_n").desc(), F.col("doc_id").asc_nulls_last()
    )
    at = F.row_number().over(first)
    runs = stored(
        sorted_rows.select(
            "doc_id", "_salt", F.sha2("_norm", 256).alias("text_sha256"), at.alias("_at"),
            F.first("doc_id").over(first).alias("_lead"), F.first("_n").over(first).alias("_lead_n"),
            F.count("*").over(run).alias("_size"),
            F.when((F.col("_salt") > 0) & (at == 1), F.col("_norm")).alias("_text"),
        ),
        "sort-runs",
    )
    # The complement orders the other way round and cannot overflow.
    best = F.struct(F.col("_lead_n").alias("n"), F.col("_lead").isNotNull().alias("known"), F.bitwise_not("_lead").alias("id"), F.bitwise_not("_salt").alias("salt"))
    merged = (
        runs.where(F.col("_text").isNotNull())
        .groupBy("_text")
        .agg(F.first("text_sha256").alias("text_sha256"), F.max(best).alias("_best"), F.sum("_size").alias("_all"))
        .select(
            "text_sha256", F.bitwise_not("_best.id").alias("_keep"), F.bitwise_not("_best.salt").alias("_keep_salt"), "_all"
        )
    )
    whole = F.col("_all").isNull()
    return runs.join(F.broadcast(merged), "text_sha256", "left").select(
        "doc_id",
        F.when(whole, F.col("_lead")).otherwise(F.col("_keep")).alias("keep_id"),
        F.when(whole, F.col("_size")).otherwise(F.col("_all")).alias("group_size"),
        ((F.col("_at") == 1) & (whole | (F.col("_salt") == F.col("_keep_salt")))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of identical kept rows one stays.

    Only the (doc_id, text) keys with a dropped row are joined back; they are broadcast where measured to be small.
    """
    marks = stored(
        equal_texts(docs)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("keep_id"))
        .agg(F.max("kept").alias("_repeat"), F.count("*").alias("_rows"))
        .where("not _repeat or _rows > 1")
        .select("_id", "_sha", "_repeat"),
        "sort-marks",
    )
    sha = F.sha2(without_spaces(F.coalesce("text", F.lit(""))), 256)
    keyed = docs.withColumns({"_own": F.col("doc_id").cast("bigint"), "_sha": sha})
    other = F.broadcast(marks) if bounded(marks) else marks
    marked = keyed.join(other, (F.col("_own").eqNullSafe(F.col("_id"))) & (keyed["_sha"] == other["_sha"]), "left").drop(other["_sha"])
    kept = marked.where(F.col("_repeat").isNull()).select(*docs.columns)
    if marks.where("_repeat").isEmpty():
        return kept
    longest = Window.partitionBy("_own", "_sha").orderBy(F.length("text").desc_nulls_last(), "text")
    one = marked.where("_repeat").withColumn("_at", F.row_number().over(longest)).where("_at = 1")
    return kept.unionByName(one.select(*docs.columns))
