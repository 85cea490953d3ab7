import numpy as np
import pytest

from barlake.llm import whiten
from barlake.llm.bidiagonal import bidiagonalised, dqds, right_singular
from barlake.llm.common import named_table

SCHEMA = "vec_id bigint, embedding array<float>, n bigint, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 7, "x") for i, v in rows], SCHEMA)


def matrices():
    draw = np.random.default_rng(3)
    turned = np.linalg.qr(draw.normal(size=(24, 24)))[0]
    return {
        "tall": draw.normal(size=(300, 40)),
        "graded": draw.normal(size=(60, 30)) * 10.0 ** -np.arange(30),
        "ties": np.diag([5, 5, 5, 3, 3, 2, 1] + [0.1] * 17) @ turned,
        "near ties": np.diag([5, 5 * (1 + 1e-8), 5 * (1 + 1e-11), 3, 3 * (1 - 1e-9), 2, 1] + [0.1] * 17) @ turned,
        "few rows": draw.normal(size=(3, 12)),
        "one column": draw.normal(size=(9, 1)),
        "zero": np.zeros((5, 5)),
    }


@pytest.mark.parametrize("name", matrices())
def test_solver_equals_a_singular_value_decomposition(name):
    m = matrices()[name]
    d = m.shape[1]
    r = np.linalg.qr(m, mode="r")
    r = np.concatenate([r, np.zeros((d - len(r), d))])
    squares, vectors = right_singular(r, min(3, d))
    want = np.zeros(d)
    want[: min(m.shape)] = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.allclose(squares, want, rtol=1e-12, atol=1e-14 * max(want[0], 1e-300))
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-11
    assert np.abs(m.T @ (m @ vectors) - vectors * squares[: vectors.shape[1]]).max() <= 1e-13 * max(want[0], 1e-300)


def test_small_singular_values_are_accurate_relatively():
    a = 10.0 ** -np.arange(12.0)
    exact = np.sort(np.array([v for v in dqds(a, np.zeros(11))]))[::-1]
    assert np.allclose(exact, a**2, rtol=1e-15)
    # The product of all values is the determinant, whatever their size.
    values = dqds(a, a[:-1] / 3)
    assert np.isclose(np.log(values).sum(), 2 * np.log(a).sum(), rtol=1e-13)


def test_bidiagonal_form_keeps_the_matrix():
    m = np.random.default_rng(1).normal(size=(20, 20))
    a, b, right = bidiagonalised(m)
    form = np.diag(a) + np.diag(b, 1)
    assert np.allclose(right.T @ (m.T @ m) @ right, form.T @ form) and np.allclose(right.T @ right, np.eye(20))


def expected(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    deviation = [sum(int(v) ** 2 for v in row) for row in (n * x - sums)]
    return n, deviation, centred @ directions[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check(rows, ids, vectors, components=8):
    n, deviation, whitened, explained = expected(vectors, components)
    assert len(rows) == len(ids) * whitened.shape[1]
    signs = {}
    by_id = {i: k for k, i in enumerate(ids)}
    for row in rows:
        k, c = by_id[row.vec_id], row.component - 1
        assert (row.n, row.deviation) == (n, deviation[k])
        assert abs(row.explained / explained[c] - 1) < 1e-9 and row.identity_error < 1e-9
        sign = signs.setdefault(c, np.sign(row.whitened * whitened[k, c]) or 1)
        assert abs(row.whitened * sign - whitened[k, c]) < 1e-6
    assert len({row.identity_error for row in rows}) <= 1


def test_whole_table_equals_plain_numpy(spark):
    embeddings = named_table(spark, "/root/testdata/sf0.001", "embeddings")
    given = {r.vec_id: r.embedding for r in embeddings.collect()}
    check(whiten.whitened_rows(embeddings.repartition(7)).collect(), list(given), list(given.values()))


def test_tree_of_small_fan_in_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(whiten, "BLOCK_BYTES", 2 * 8 * 36)
    draw = np.random.default_rng(5)
    vectors = (draw.normal(size=(90, 6)) * [9, 5, 3, 2, 1, 0.5]).astype(np.float32).tolist()
    rows = whiten.whitened_rows(table(spark, list(enumerate(vectors))).repartition(9), 3).collect()
    check(rows, list(range(90)), vectors, 3)


def test_edges(spark):
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(30, 4)).astype(np.float32).tolist()
    odd = [(100, None), (101, [1, None, 2, 3]), (102, [float("nan")] * 4), (103, [float("inf"), 0, 0, 0]), (104, [1.0, 2.0]), (105, []), (106, [1e30] * 4)]
    rows = whiten.whitened_rows(table(spark, [*enumerate(vectors), *odd])).collect()
    check(rows, list(range(30)), vectors)
    # Repeated rows count each; ids may repeat or be null.
    twice = whiten.whitened_rows(table(spark, [(None, v) for v in vectors] + [(1, v) for v in vectors])).collect()
    assert len(twice) == 60 * 4 and {r.n for r in twice} == {60} and {r.vec_id for r in twice} == {None, 1}
    for none in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, [])]):
        out = whiten.whitened_rows(table(spark, none))
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]
    flat = whiten.whitened_rows(table(spark, [(i, [i, 2 * i, 5.0]) for i in range(9)])).collect()
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-9
    large = whiten.whitened_rows(table(spark, [(i, [i * 1e8, 1.0]) for i in range(9)])).collect()
    assert {r.deviation for r in large if r.vec_id != 4} == {None}
