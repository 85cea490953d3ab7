"""Singular values and right singular vectors of a small matrix: Householder bidiagonalisation, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the orthogonal V of r = U B V' by Householder reflections from both sides."""
    r, d = np.array(r, float), r.shape[1]
    right = np.eye(d)
    for k in range(d):
        v = _reflector(r[k:, k])
        if v is not None:
            r[k:, k:] -= np.outer(2 * v, v @ r[k:, k:])
        v = _reflector(r[k, k + 1 :]) if k + 2 < d else None
        if v is not None:
            r[k:, k + 1 :] -= np.outer(r[k:, k + 1 :] @ v, 2 * v)
            right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, 2 * v)
    return np.diag(r).copy(), np.diag(r, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector of the reflection that leaves only the first entry of x."""
    scale = np.abs(x).max(initial=0.0)
    if len(x) < 2 or scale == 0 or not np.any(x[1:]):
        return None
    v = x / scale
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal (a, b), falling, each to high relative accuracy.

    A shift that turns out to exceed the smallest value makes a negative pivot; the sweep is then repeated with a smaller one,
    in the end with none, which cannot fail. Shifts are added up apart, so nothing cancels.
    """
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a))
    blocks = [((np.asarray(a) / scale) ** 2, (np.asarray(b) / scale) ** 2, 0.0)]
    values = []
    while blocks:
        q, e, shifted = blocks.pop()
        tau = 0.0
        while len(q):
            if len(q) == 1:
                values.append(q[0] + shifted)
                break
            small = np.flatnonzero(e <= EPS * EPS * (shifted + np.minimum(q[:-1], q[1:])))
            if len(small):
                at = small[-1] + 1
                blocks.append((q[:at], e[: at - 1], shifted))
                q, e, tau = q[at:], e[at:], 0.0
                continue
            while True:
                swept = _sweep(q, e, tau)
                if swept is not None:
                    break
                tau = tau / 4 if tau > EPS * EPS * shifted + TINY else 0.0
            q, e, least = swept
            shifted += tau
            # The least pivot bounds the smallest value from above, and comes close to it as the last e vanishes.
            tau = max(0.0, least * (1 - 2 * np.sqrt(e[-1] / (q[-1] + TINY)))) if e[-1] < q[-1] / 4 else least / 4
    return np.sort(np.array(values))[::-1] * scale**2


def _sweep(q: np.ndarray, e: np.ndarray, tau: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One differential quotient-difference transform with shift, None if a pivot is negative."""
    new_q, new_e, d = np.empty_like(q), np.empty_like(e), q[0] - tau
    least = d
    for i in range(len(e)):
        if d < 0:
            return None
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i] if new_q[i] > 0 else 0.0
        new_e[i] = e[i] * ratio
        d = d * ratio - tau if new_q[i] > 0 else q[i + 1] - tau
        least = min(least, d)
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, max(least, 0.0)


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit vector z with B'B z = value z, from the twisted factorisation with the least twist element.

    B'B = L D L' with D = a^2 and L = b / a. The stationary transform factorises it less ``value`` from the top, the
    progressive one from the bottom; where they meet best, both halves of z follow by multiplications alone.
    """
    n = len(a)
    if n == 1:
        return np.ones(1)
    floor = EPS * max(np.abs(a).max(), np.abs(b).max(), TINY)
    safe = np.where(np.abs(a) < floor, floor, a)
    pivots, l = safe**2, b / safe[:-1]
    down, s = np.empty(n - 1), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        plus = s[i] + pivots[i] or TINY
        down[i] = pivots[i] * l[i] / plus
        s[i + 1] = down[i] * l[i] * s[i] - value
    up, p = np.empty(n - 1), np.empty(n)
    p[-1] = pivots[-1] - value
    for i in range(n - 2, -1, -1):
        minus = pivots[i] * l[i] ** 2 + p[i + 1] or TINY
        up[i] = l[i] * pivots[i] / minus
        p[i] = p[i + 1] * pivots[i] / minus - value
    twist = s + p + value
    r = int(np.argmin(np.abs(np.where(np.isfinite(twist), twist, np.inf))))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def right_singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of ``r``, falling, and the right singular vectors of the first ``count`` as columns.

    Where B falls apart, a vector lives on one part, so equal values of different parts get orthogonal vectors. Vectors of
    values that nearly agree within a part are made orthogonal to the earlier ones and corrected by inverse iteration.
    """
    a, b, right = bidiagonalised(r)
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * top / 4) + 1), len(a)]
    found = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        own, above = a[low:high], b[low : high - 1]
        values = dqds(own, above)
        gram = np.diag(own**2) + np.diag(own[:-1] * above, 1) + np.diag(own[:-1] * above, -1)
        gram[1:, 1:] += np.diag(above**2)
        vectors = []
        for value in values[:count]:
            close = [v for other, v in vectors if abs(other - value) <= 1e-3 * abs(value)]
            z = twisted_vector(own, above, value)
            if close:
                z = _apart(gram, value, z, np.array(close))
            vectors.append((value, z))
        for i, value in enumerate(values):
            found.append((value, low, vectors[i][1] if i < count else None))
    found.sort(key=lambda item: -item[0])
    columns = np.zeros((len(a), min(count, len(a))))
    for j, (_, low, z) in enumerate(found[: columns.shape[1]]):
        columns[:, j] = right[:, low : low + len(z)] @ z
    return np.array([value for value, _, _ in found]), columns


def _apart(gram: np.ndarray, value: float, z: np.ndarray, close: np.ndarray) -> np.ndarray:
    """An eigenvector of ``value`` orthogonal to those of the values next to it."""

    def cleared(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - close.T @ (close @ v)
        return v

    z = cleared(z)
    if np.linalg.norm(z) < 0.5:
        z = cleared(np.cos(np.arange(1, len(z) + 1)))
    shifted = gram - (value * (1 + 4 * EPS)) * np.eye(len(z))
    for _ in range(3):
        z = cleared(np.linalg.solve(shifted, z / np.linalg.norm(z)))
    return z / np.linalg.norm(z)
