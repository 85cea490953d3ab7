import random
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import EDGES, SCHEMA, edge_docs, no_docs

from barlake.llm import collocations


def plain(docs, support, top):
    """lang -> rows, by counting every phrase."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, 6):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n, rows = totals[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        for p, a in candidates.items():
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            inside = any(q[i : i + len(p)] == p and b >= a for q, b in candidates.items() if len(q) > len(p) for i in range(len(q) - len(p) + 1))
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def prose(seed, count, kinds, phrases):
    draw = random.Random(seed)
    out = []
    while len(out) < count:
        out += draw.choice(phrases) if draw.random() < 0.3 else [f"w{int(kinds * draw.random() ** 2)}"]
        if draw.random() < 0.1:
            out[-1] += draw.choice([".", ",", "! ", ";", "\n", " - ", "\x0b", "\t"])
    return " ".join(out)


def corpus():
    phrases = [["New", "York", "City"], ["state", "of", "the", "art", "é"], ["a", "a", "a", "a"], ["one", "two", "three", "four", "five", "six"]]
    docs = [(lang, prose(i, 150, 80, phrases)) for i, lang in enumerate(["en"] * 40 + ["de"] * 15 + [None] * 8 + ["und"] * 4)]
    # A copy group of a third of all rows.
    return docs + [("en", prose(99, 60, 30, phrases))] * 30 + [("en", None), ("fr", ""), ("fr", " . , ")]


def frame(spark, docs):
    return spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(docs)], "doc_id bigint, text string, lang string")


def rows(found):
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("support", "top"), [(12, 2000), (3, 25), (60, 2000)])
def test_equals_counting_everything(spark, support, top):
    docs = corpus()
    assert rows(collocations.collocations(frame(spark, docs).repartition(5), support, top)) == plain(docs, support, top)


def test_small_parts_and_saturated_bitmaps_change_nothing(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 500)
    monkeypatch.setattr(collocations, "MAX_BITS", 8)
    assert rows(collocations.collocations(frame(spark, docs).repartition(3), 12)) == plain(docs, 12, 2000)


def test_every_shard_mines_at_its_share_of_the_support(spark):
    docs = frame(spark, corpus())
    words = collocations.shard_counts(collocations._sharded(docs), (1,), None)
    supports = collocations.local_supports(words, 50).collect()
    assert len({r.shard for r in supports}) > 3
    for r in supports:
        assert r.need == -(-50 * r.own // r.total)
    by_lang = defaultdict(list)
    for r in supports:
        by_lang[r.lang].append(r.need - 1)
    # Being short everywhere means being short in all.
    assert all(sum(short) < 50 for short in by_lang.values())


def test_exact_where_products_pass_64_bits(spark):
    frequent = spark.createDataFrame(
        [("en", "x y", 2, 10**12 + 7), ("en", "x", 1, 10**13 + 1), ("en", "y", 1, 10**12 + 9)], "lang string, phrase string, size int, f bigint"
    )
    totals = spark.createDataFrame([("en", 10**14 + 3)], "lang string, total bigint")
    row = collocations.cut_scores(frequent, totals).first()
    assert row.score == 1000 * (10**12 + 7) * (10**14 + 3) // ((10**13 + 1) * (10**12 + 9))


def test_edges(spark):
    own = spark.createDataFrame([(i, t, "L", True, 7, 7, 7) for i, t in EDGES], SCHEMA)
    assert rows(collocations.collocations(own, 2)) == plain([("L", t) for _, t in EDGES], 2, 2000)
    assert rows(collocations.collocations(edge_docs(spark), 3)) == plain([(None, t) for _, t in EDGES], 3, 2000)
    assert collocations.collocations(no_docs(spark)).count() == 0
    assert collocations.collocations(frame(spark, [("en", None), ("en", " ")])).count() == 0
