import random
import re

import corpus_pipeline
from llm_cases import documents, words
from test_llm_jaccard import edited, near_copies

from barlake.llm import jaccard


def five_word_sets(text):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(own)} if 0 < len(own) < 5 else set(zip(*[own[i:] for i in range(5)]))


def kept_ids(texts):
    sets, parent = [five_word_sets(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 5 * len(x & sets[j]) >= 4 * len(x | sets[j]):
                one, other = sorted((root(i), root(j)))
                parent[other] = one
    return [i for i in range(len(texts)) if root(i) == i]


def test_near_stage_equals_brute_force_over_five_words(spark):
    texts = near_copies(5, 10, (4, 6, 9, 12, 16, 25, 60, 150))
    base = words(77, 100, 10**6)
    texts += [" ".join(base), " ".join([*base[:50], "other", *base[51:]]), " ".join(base[:80])]
    kept = corpus_pipeline.near_stage(spark, documents(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == kept_ids(texts)


def test_copies_too_far_apart_to_link_are_not_paired_with_each_other(spark, monkeypatch):
    # Up to eight words of 150 are other ones, so most members of the group link with nobody, and any two lack a shingle in common.
    draw, base, met = random.Random(3), words(5, 150, 10**6), []
    texts = [edited(base, draw.randrange(1, 9), draw) for _ in range(240)]
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *rest: met.append(pairs.count()) or verified(pairs, *rest))
    kept = corpus_pipeline.near_stage(spark, documents(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == kept_ids(texts)
    assert len(met) == 2 and sum(met) < 5 * len(texts)


def test_ids_that_repeat_or_are_missing_are_judged_by_text(spark):
    a, b = words(1, 60, 10**6), words(2, 60, 10**6)
    near = [*a[:59], "other"]
    rows = [(1, " ".join(a)), (2, " ".join(near)), (2, " ".join(b)), (None, " ".join(a)), (None, None), (3, "")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, gone_id int, node int")
    kept = corpus_pipeline.near_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)
    assert corpus_pipeline.near_stage(spark, docs.limit(0), "").count() == 0
