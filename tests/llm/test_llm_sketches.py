import hashlib
import re

from llm_cases import EDGES, documents, edge_docs, no_docs
from pyspark.sql import functions as F

from barlake.llm.sketches import LINE, fingerprints, with_successor

PARAGRAPH = re.compile(LINE, re.ASCII)


def likeness(one, other):
    x, y = set(PARAGRAPH.findall(one)), set(PARAGRAPH.findall(other))
    return 1.0 if not x and not y else 1 - len(x ^ y) / (len(x) + len(y))


def check(rows, ordered):
    assert len(rows) == len(ordered)
    want = []
    for i, (doc_id, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(text, edited), 9), round(likeness(text, after), 9)))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_recovered_differences_equal_brute_force(spark):
    texts = ["\n".join(f"line {i * j % 91} of {i % 7}" for j in range(i * i % 200)) for i in range(40)] + ["same\ntext"] * 2
    rows = fingerprints(documents(spark, texts), range_rows=5).collect()
    check(rows, list(enumerate(texts)))
    assert len({r.fingerprint for r in rows}) == len(set(frozenset(PARAGRAPH.findall(t)) for t in texts))
    assert rows[0].fingerprint and len({len(r.fingerprint) for r in rows}) == 1


def test_awkward_rows(spark):
    ordered = sorted(((i, t or "") for i, t in EDGES), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for size in (512, 2):
        check(fingerprints(edge_docs(spark), range_rows=size).collect(), ordered)
    assert fingerprints(no_docs(spark)).count() == 0


def test_every_row_meets_its_successor(spark):
    docs = spark.createDataFrame([(i * 1000 % 997 - 400, f"t{i}") for i in range(300)], "doc_id bigint, text string")
    ids = sorted((r.doc_id, r.text) for r in docs.collect())
    after = {i: ids[(k + 1) % len(ids)][1] for k, (i, _) in enumerate(ids)}
    rows = with_successor(docs, 16).where(~F.col("_guard")).collect()
    assert len(rows) == 300 and all(r._next == after[r.doc_id] for r in rows)
