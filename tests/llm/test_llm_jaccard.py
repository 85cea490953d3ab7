import random
import re

import numpy as np
import pytest
from llm_cases import EDGES, documents, edge_docs, no_docs, words

from barlake.llm import jaccard
from barlake.llm.jaccard import (
    Plan, _cuts, connected, heavy_keys, least_overlap, linked_groups, most_different, one_of_each_group, partner_sizes,
)


def shingles(text):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(own)} if 0 < len(own) < 3 else set(zip(own, own[1:], own[2:]))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(frame):
    return sorted((tuple(r) for r in linked_groups(frame).collect()), key=str)


def edited(base, changes, draw):
    out = list(base)
    for _ in range(changes):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**9)}"
    return " ".join(out)


def near_copies(seed, size, lengths=(8, 14, 19, 21, 30, 60, 150)):
    draw, texts = random.Random(seed), []
    for length in lengths:
        base = words(seed + length, length, 10**6)
        texts += [edited(base, draw.randrange(0, max(2, length // 12)), draw) for _ in range(size)]
        texts += [" ".join(base[: draw.randrange(length * 8 // 10, length + 1)]) for _ in range(3)]
    return texts


def test_groups_equal_brute_force(spark):
    texts = near_copies(3, 12)
    assert got(documents(spark, texts)) == brute(list(enumerate(texts)))


def half_and_half(size):
    """Near copies with an edit each; half of them also have the same insertion."""
    draw, base, extra = random.Random(size), words(1, 150, 10**6), words(2, 8, 10**6)
    rows = []
    for i in range(size):
        text = edited(base, 1, draw).split()
        rows.append(" ".join([*text[:60], *extra, *text[60:]] if i % 2 else text))
    return rows


def test_pairs_grow_with_a_group_that_shares_a_change(spark, monkeypatch):
    seen, verified = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda met, *rest: seen.append(met.count()) or verified(met, *rest))
    small, large = half_and_half(120), half_and_half(480)
    assert got(documents(spark, small)) == brute(list(enumerate(small)))
    first, seen[:] = sum(seen), []
    assert got(documents(spark, large)) == brute(list(enumerate(large)))
    assert sum(seen) <= 5 * max(first, 120)


def test_neighbours_are_found_across_batches_and_at_borders():
    import pyarrow as pa

    rows = [(1, 5), (2, 1), (2, 1), (3, 1), (3, 2), (4, 1), (5, 1), (5, 3), (6, 9), (7, 7), (7, 7)]
    for size in range(1, len(rows) + 1):
        parts = [list(zip(*rows[i : i + size])) for i in range(0, len(rows), size)]
        batches = iter([pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in p], names=["key", "node"]) for p in parts])
        out = [(r["key"], r["node"]) for b in jaccard._with_neighbours(batches) for r in b.to_pylist()]
        assert out == [(1, 5), (3, 1), (3, 2), (5, 1), (5, 3), (7, 7)]


def test_awkward_rows(spark):
    assert got(edge_docs(spark)) == brute(EDGES)
    assert linked_groups(no_docs(spark)).count() == 0
    kept = one_of_each_group(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "8", "None", "11"])


def test_costs_choose_the_boundary():
    plan = Plan()
    assert plan.boundary == max(n for n in range(1, 64) if plan._subsets(n) <= plan._lists(n) + jaccard.VERIFY_COST + n / 5)
    for n in range(plan.boundary + 1, 3000, 7):
        for m in range(n, 100 * n // 90 + 1):
            band = plan.band(m)
            assert band in plan.bands(n) and band in plan.bands(m)
            agreed = plan.blocks(band) - (n + m - 2 * least_overlap(n, m))
            assert 0 < plan.surely_equal(n, band) <= agreed and 0 < plan.surely_equal(m, band) <= agreed


@pytest.mark.parametrize("percent", [80, 90])
def test_partners_share_a_block_however_their_differences_are_spread(percent):
    plan, draw, pairs = Plan(percent), np.random.default_rng(percent), 0
    for _ in range(1500):
        n = int(draw.integers(plan.boundary + 1, 900))
        m = int(draw.choice(list(partner_sizes(n, percent))))
        one = np.unique(draw.integers(0, 1 << 64, n, dtype=np.uint64))
        differ = most_different(n + m, percent)
        lacks, adds = (differ - m + n) // 2, (differ + m - n) // 2
        cuts = _cuts(plan.blocks(plan.band(max(n, m, plan.boundary + 1))))
        # One difference in each block, those with the most shingles first.
        blocks = np.searchsorted(cuts, one, "right")
        largest = np.argsort(-np.bincount(blocks, minlength=len(cuts) + 1), kind="stable")
        gone = [int(np.flatnonzero(blocks == b)[0]) for b in largest[:lacks] if (blocks == b).any()]
        fresh = [np.uint64(int(cuts[b - 1] if b else 0) + 1 + int(draw.integers(1000))) for b in largest[lacks : lacks + adds]]
        other = np.unique(np.concatenate([np.delete(one, gone), np.array(fresh, np.uint64)]))
        shared = len(np.intersect1d(one, other))
        if 100 * shared >= percent * (len(one) + len(other) - shared) and max(len(one), len(other)) > plan.boundary:
            pairs += 1
            assert len(np.intersect1d(heavy_keys(one, plan), heavy_keys(other, plan)))
    assert pairs > 1000


def test_chains_and_stars_are_connected(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    rows = {r.node: r.group for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(rows[i] == 0 for i in range(1, 41)) and all(rows[i] == 100 for i in range(101, 130)) and 0 not in rows
