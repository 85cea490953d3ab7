"""Documents with every awkward case, and small brute-force helpers."""

from __future__ import annotations

import random

LONG = "Ab cd,\n" * 4000
EDGES = [
    (1, "the quick brown Fox."), (2, None), (3, ""), (4, " \t\n\x0b\f\r "), (5, LONG), (6, "the quick brown Fox."),
    (7, "thequick  brownFox."), (8, "é ñ 漢字 😀\x85x\xa0y"), (9, "the quick brown Fox."), (9, "the quick brown Fox."), (None, "no id here"),
    (11, "one"), (12, "ONE"),
]
# Columns named like those the operators make.
SCHEMA = "doc_id bigint, text string, lang string, kept boolean, n bigint, node bigint, start bigint"


def edge_docs(spark):
    return spark.createDataFrame([(i, t, None, True, 7, 7, 7) for i, t in EDGES], SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def words(seed: int, count: int, kinds: int = 500) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(kinds)}" for _ in range(count)]
