"""Right singular vectors and values of a small square matrix by bidiagonalisation, dqds and twisted factorisations.

The matrix is a triangle whose size is the length of a vector, never the number of rows, so it is solved where it is needed."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Values closer than this, relative to their size, are a cluster whose directions are made orthogonal to each other.
CLOSE = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and right factor v with r = u B v^T, by Householder reflections from both sides in turn."""
    m = np.array(r, np.float64)
    d = m.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x[1:])
        if norm == 0:
            return None
        w = x.copy()
        w[0] += np.copysign(np.hypot(x[0], norm), x[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        if (w := reflector(m[k:, k])) is not None:
            m[k:, k:] -= 2 * np.outer(w, w @ m[k:, k:])
        if k < d - 2 and (w := reflector(m[k, k + 1 :])) is not None:
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential quotient-difference step with a shift, and the d of each place; None if the shift was too large."""
    d, new_q, new_e, ds = q[0] - shift, [], [], []
    for k in range(len(e)):
        if d < 0:
            return None
        ds.append(d)
        s = d + e[k]
        new_q.append(s)
        if s == 0:
            new_e.append(0.0)
            d = q[k + 1] - shift
        else:
            t = q[k + 1] / s
            new_e.append(e[k] * t)
            d = d * t - shift
    if d < 0:
        return None
    ds.append(d)
    new_q.append(d)
    return new_q, new_e, ds


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the upper bidiagonal (a, b) to high relative accuracy.

    Steps without subtraction are taken on squares; the shift is first the least d (an upper bound), then Newton's lower bound, then 0."""
    out, blocks = [], [((a * a).tolist(), (b * b).tolist(), 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        spent = 0.0  # lost digits of the sum of shifts (compensated)
        while q:
            n = len(q)
            if n == 1:
                out.append(shifted + (q[0] + spent))
                break
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= EPS * EPS * (shifted + min(q[k], q[k + 1])) or (e[k] <= EPS * EPS * shifted)), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], shifted + spent))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # small values belong to the end
                q, e = q[::-1], e[::-1]
            q, e, ds = _dqds(q, e, 0.0)
            least = min(ds)
            newton = 0.0 if least <= 0 else 1 / sum(1 / d for d in ds)
            for s in (least * (1 - 4 * EPS) if ds[-1] == least else 0.0, newton * (1 - 64 * EPS * n)):
                if s > 0 and (step := _dqds(q, e, s)) is not None:
                    q, e = step[:2]
                    total = shifted + s
                    spent += (shifted - total) + s
                    shifted = total
                    break
    return np.sort(np.array(out))[::-1]


def _twisted(q: np.ndarray, e: np.ndarray, a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B^T B for an eigenvalue: stationary and progressive factorisations meet where the residual is least."""
    n = len(q)
    if n == 1:
        return np.ones(1)
    tiny = np.finfo(np.float64).tiny
    # B^T B has the diagonal q[k] + e[k - 1] and a[k] * b[k] beside it; both factorisations of it less the value are kept as differences.
    low, s_at, s = np.empty(n - 1), np.empty(n), -value  # from the top
    for k in range(n - 1):
        s_at[k] = s
        low[k] = a[k] * b[k] / ((s + q[k]) or tiny)
        s = low[k] / a[k] * b[k] * s - value if a[k] else -value
    s_at[-1] = s
    down, p_at, p = np.empty(n - 1), np.empty(n), q[-1] - value  # from the bottom
    p_at[-1] = p
    for k in range(n - 2, -1, -1):
        full = (e[k] + p) or tiny
        down[k] = a[k] * b[k] / full
        p = p * (q[k] / full) - value
        p_at[k] = p
    gamma = s_at + p_at + value
    twist = int(np.abs(gamma).argmin())
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -down[k] * z[k]
    if not np.isfinite(z).all():
        z = np.nan_to_num(z / np.nanmax(np.abs(z)), nan=0.0, posinf=0.0, neginf=0.0)
    return z / np.linalg.norm(z)


def _refined(a: np.ndarray, b: np.ndarray, z: np.ndarray, value: float, others: np.ndarray) -> np.ndarray | None:
    """Inverse iteration on B^T B, orthogonal to the directions already taken of the cluster; None if it adds no direction of its own."""
    n = len(a)
    t = np.zeros((n, n))
    k = np.arange(n - 1)
    t[np.arange(n), np.arange(n)] = a * a - value
    t[k + 1, k + 1] += b * b
    t[k, k + 1] = t[k + 1, k] = a[:-1] * b
    t += np.eye(n) * EPS * max(np.abs(t).max(), abs(value)) * 4
    for start in (z, np.random.default_rng(len(others)).standard_normal(n)):
        x = start - others @ (others.T @ start)
        for _ in range(4):
            norm = np.linalg.norm(x)
            if norm < 1e-8:
                break
            x = np.linalg.solve(t, x / norm)
            x /= np.linalg.norm(x)
            for _ in range(2):
                x -= others @ (others.T @ x)
        norm = np.linalg.norm(x)
        if norm > 1e-4:
            return x / norm
    return None


def right_singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest singular values of a square matrix, falling, and their right directions as columns."""
    d = r.shape[1]
    scale = np.abs(r).max()
    if not scale:
        return np.zeros(count), np.eye(d)[:, :count]
    a, b, v = bidiagonalise(r / scale)
    if d > 1:  # couplings below rounding part the matrix into blocks whose directions don't overlap
        b = np.where(np.abs(b) <= EPS * np.sqrt(np.abs(a[:-1] * a[1:])) * 1e-2, 0.0, b)
        b = np.where(np.abs(b) <= EPS * EPS * np.abs(a).max(), 0.0, b)
    ends = [*(np.flatnonzero(b == 0) + 1).tolist(), d]
    found = []
    begin = 0
    for end in ends:
        aa, bb = a[begin:end], b[begin : end - 1]
        for value in squared_values(aa, bb):
            found.append((float(value), begin, end))
        begin = end
    found.sort(key=lambda x: (-x[0], x[1]))
    values, columns, taken = [], [], []
    for value, begin, end in found[:count]:
        aa, bb = a[begin:end], b[begin : end - 1]
        z = _twisted(aa * aa, bb * bb, aa, bb, value)
        near = [c[begin:end] for x, first, c in taken if first == begin and abs(x - value) <= CLOSE * max(x, value)]
        if near:
            others = np.linalg.qr(np.array(near).T)[0]
            z = next((x for x in (_refined(aa, bb, z, value, others),) if x is not None), z)
        full = np.zeros(d)
        full[begin:end] = z
        taken.append((value, begin, full))
        values.append(value)
        columns.append(v @ full)
    return scale * np.sqrt(np.maximum(values, 0)), np.array(columns).T
