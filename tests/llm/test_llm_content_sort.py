import hashlib
import re

import pytest
from llm_cases import EDGES, edge_docs, no_docs

from barlake.llm.content_sort import drop_copies, equal_texts


def groups():
    out = {}
    for doc_id, text in EDGES:
        out.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, len(text or "")))
    return out


@pytest.mark.parametrize("slots", [1000, 3])
def test_groups_equal_brute_force(spark, slots):
    rows = equal_texts(edge_docs(spark), slots).collect()
    assert len(rows) == len(EDGES)
    for norm, members in groups().items():
        sha = hashlib.sha256(norm.encode()).hexdigest()
        own = [r for r in rows if r.text_sha256 == sha]
        longest = max(n for _, n in members)
        keep = min((i for i, n in members if n == longest and i is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in own} == {(keep, len(members))}
        assert sorted(str(r.doc_id) for r in own) == sorted(str(i) for i, _ in members)
        assert [r.doc_id for r in own if r.kept] == [keep]


def test_kept_rows_have_all_columns(spark):
    kept = drop_copies(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert kept.count() == len(groups())
    assert equal_texts(no_docs(spark)).count() == 0 and drop_copies(no_docs(spark)).count() == 0


def test_one_of_identical_rows_stays(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab"), (3, "c")], "doc_id bigint, text string")
    assert sorted(map(tuple, drop_copies(rows).collect())) == [(1, "a b"), (3, "c")]
