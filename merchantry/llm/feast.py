"""Eigenpairs of a symmetric matrix inside intervals, by contour integration, with inertia counts as proof that none is missed.

The projector onto the eigenvectors of an interval is an integral of shifted inverses around it. A Gauss-Legendre rule on the upper half of a circle approximates it by a few complex solves (FEAST); the filtered block is made
orthonormal, the matrix is projected onto it (Rayleigh-Ritz), and the step is repeated until the residuals are at rounding level, with a wider block if it takes long. How many eigenvalues lie above a shift is the number of positive pivots of a symmetric
factorisation of the shifted matrix (Sylvester's law); intervals are cut by bisection on these counts, so every interval's number is known before its pairs are sought.
"""

from __future__ import annotations

import numpy as np


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than ``shift``: positive eigenvalues of the block diagonal factor, with pivots of one or two rows (Bunch and Kaufman)."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    growth = (1 + np.sqrt(17)) / 8
    while k < n:
        rest = a[k:, k:]
        m = n - k
        size = 1
        if m > 1:
            r = 1 + int(np.abs(rest[1:, 0]).argmax())
            most = abs(rest[r, 0])
            if most > 0 and abs(rest[0, 0]) < growth * most:
                row = np.abs(rest[r])
                row[r] = 0
                across = row.max()
                if abs(rest[0, 0]) * across < growth * most * most:
                    if abs(rest[r, r]) >= growth * across:
                        _swap(rest, 0, r)
                    else:
                        _swap(rest, 1, r)
                        size = 2
        if size == 1:
            pivot, column = rest[0, 0], rest[1:, 0].copy()
            positive += pivot > 0
            if pivot != 0:
                rest[1:, 1:] -= np.outer(column, column / pivot)
        else:
            block, columns = rest[:2, :2].copy(), rest[2:, :2].copy()
            # A block of this kind has a negative determinant: one eigenvalue of each sign.
            positive += 1
            rest[2:, 2:] -= columns @ np.linalg.solve(block, columns.T)
        k += size
    return int(positive)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    a[[i, j]] = a[[j, i]]
    a[:, [i, j]] = a[:, [j, i]]


def intervals(matrix: np.ndarray, k: int, most: int) -> list[tuple[float, float, int]]:
    """(low, high, number) of intervals, upper ones first, that together hold the k largest eigenvalues at least.

    Intervals of more than ``most`` eigenvalues are halved until they aren't, or until they are as narrow as a cluster that rounding can't tell apart.
    """
    size = np.abs(matrix).sum(axis=1).max()  # no eigenvalue is larger
    if not size:
        return []
    fine = 1e-9 * size
    top, bottom = size * (1 + 1e-9) + 1e-300, -size * (1 + 1e-9)
    low, high = bottom, top
    # The cut below the k-th: a shift with k or more above it, as few more as bisection gives.
    while high - low > fine and above(matrix, low) != k:
        middle = (low + high) / 2
        if above(matrix, middle) >= k:
            low = middle
        else:
            high = middle
    if above(matrix, low) != k:
        low -= fine  # through a cluster: it is taken as a whole
    out, open_ = [], [(low, top, above(matrix, low))]
    while open_:
        a, b, n = open_.pop()
        if not n:
            continue
        if n <= most or b - a <= 4 * fine:
            out.append((a, b, n))
            continue
        middle = (a + b) / 2
        upper = above(matrix, middle) - (0 if b == top else above(matrix, b))
        open_ += [(a, middle, n - upper), (middle, b, upper)]
    return sorted(out, key=lambda x: -x[0])


def inside(matrix: np.ndarray, low: float, high: float, number: int, *, points: int = 8, rounds: int = 40, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` eigenvalues in the interval and their unit vectors as columns."""
    n = len(matrix)
    r = np.random.Generator(np.random.PCG64([seed, n]))
    block = r.normal(size=(n, min(n, number + max(4, number // 2))))
    nodes, weights = np.polynomial.legendre.leggauss(points)
    middle, radius, scale = (low + high) / 2, (high - low) / 2, np.abs(matrix).sum(axis=1).max()
    angles = -np.pi / 2 * (nodes - 1)
    shifts = [(w, radius * np.exp(1j * t), middle + radius * np.exp(1j * t)) for w, t in zip(weights, angles, strict=True)]
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for turn in range(rounds):
        q, _ = np.linalg.qr(block)
        out = np.zeros_like(q)
        for w, step, z in shifts:
            out += w / 2 * np.real(step * np.linalg.solve(z * np.eye(n) - matrix, q.astype(complex)))
        q, _ = np.linalg.qr(out)
        ritz, turned = np.linalg.eigh(q.T @ matrix @ q)
        vectors = q @ turned
        mine = np.argsort(np.where((ritz > low) & (ritz <= high), 0.0, np.maximum(low - ritz, ritz - high)), kind="stable")[:number]
        values, found = ritz[mine], vectors[:, mine]
        error = float(np.linalg.norm(matrix @ found - found * values, axis=0).max())
        fits = bool(((values > low) & (values <= high)).all())
        if fits and (best is None or error < best[0]):
            best = (error, values, found)
        elif best is not None and best[0] <= 1e-12 * scale:
            break  # rounding is reached
        if best is not None and best[0] <= 1e-15 * scale:
            break
        block = vectors
        if turn % 4 == 3:  # too many eigenvalues near the edges for a block of this width
            block = np.concatenate([block, r.normal(size=(n, min(n, 2 * block.shape[1]) - block.shape[1]))], axis=1)
    if best is None or best[0] > 1e-9 * scale:
        raise ArithmeticError(f"{number} eigenvalues lie between {low} and {high}, but the subspace doesn't settle on them")
    return best[1], best[2]


def largest(matrix: np.ndarray, k: int, *, most: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues in falling order, and their unit vectors as columns."""
    k = min(k, len(matrix))
    values, vectors = [], []
    for low, high, number in intervals(matrix, k, most):
        e, v = inside(matrix, low, high, number)
        values.append(e)
        vectors.append(v)
    if not values:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    # The intervals' vectors together once more, so that neighbours on both sides of a cut are orthogonal to rounding.
    q, _ = np.linalg.qr(np.concatenate(vectors, axis=1))
    e, turned = np.linalg.eigh(q.T @ matrix @ q)
    order = np.argsort(-e, kind="stable")[:k]
    return e[order], q @ turned[:, order]
