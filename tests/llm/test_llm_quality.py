import random
import re

import pytest
from llm_cases import EDGES, documents, edge_docs, no_docs, words

from barlake.llm import quality


def plain_metrics(text):
    text = text or ""
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    seen = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    covered = {i + j for i, window in enumerate(windows) if seen[window] > 1 for j in range(3)}
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def texts():
    draw = random.Random(4)
    out = [" ".join(words(seed, draw.randrange(300), kinds)) for seed in range(60) for kinds in (2, 5, 40, 10**6)]
    out += ["\n".join(draw.choice(["a b", "a b ", "", " \t", "c", "#a|b"]) for _ in range(30)) for _ in range(30)]
    return out + ["x " * 60, "a b c a b c a", " 　 \x1f a", "漢字 😀 " * 40, "A" * 3000, " ".join(words(9, 30_000, 25))]


def test_metrics_and_verdicts_equal_plain_code(spark):
    given = texts()
    got = {r.doc_id: r for r in quality.judge_documents(documents(spark, given)).collect()}
    for i, text in enumerate(given):
        n, chars, symbols, lines, repeats = want = plain_metrics(text)
        row = got[i]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want, text[:80]
        assert row.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert row.kept == (row.stopped_by is None) and not (row.base_failed and row.kept)
        assert 10 * symbols <= n or not row.kept


def test_edges(spark):
    rows = quality.judge_documents(edge_docs(spark)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars) for r in rows) == sorted((i or -1, *plain_metrics(t)[:2]) for i, t in EDGES)
    assert quality.judge_documents(no_docs(spark)).count() == 0


def test_order_is_by_rejections_per_cost_and_changes_no_verdict(spark, monkeypatch):
    seconds = {"n_words < 50": 4.0, "n_words < 100": 1.0, "n_words > 150": 1.0, "False": 0.0}
    monkeypatch.setattr(quality, "_seconds", lambda sample, predicate: next(v for k, v in seconds.items() if k.lower() in str(predicate).lower()))
    docs = documents(spark, [" ".join(words(i, i, 10**6)) for i in range(200)])
    short, shorter, long = (quality.Rule(n, p) for n, p in (("a", "n_words < 50"), ("b", "n_words < 100"), ("c", "n_words > 150")))
    order = quality.rule_order(docs, (short, shorter, long), 10_000)
    assert [m.rule.name for m in order] == ["b", "c", "a"]
    assert [round(m.rejects, 2) for m in order] == [0.5, 0.49, 0.0]
    kept = quality.judge_documents(docs, (short, shorter, long)).where("kept")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(100, 151))


@pytest.mark.parametrize("sample_rows", [1, 50])
def test_small_samples_decide_alike(spark, sample_rows):
    docs = documents(spark, texts()).repartition(3)
    want = {r.doc_id: r.kept for r in quality.judge_documents(docs).collect()}
    assert {r.doc_id: r.kept for r in quality.judge_documents(docs, sample_rows=sample_rows).collect()} == want
