"""Leading eigenvectors of a symmetric matrix by spectral divide and conquer.

The unitary polar factor U of A - sI has the eigenvectors of A and eigenvalues +1 (above s) and -1 (below s), so
(U + I) / 2 projects on the invariant subspace above s. A basis of it and of its complement turns A into two blocks, which
are split again until a block is a single eigenvector. Polar factors come from the QR-based dynamically weighted Halley
iteration (Nakatsukasa, Bai and Gygi 2010; Nakatsukasa and Higham 2013). The matrix has the size of the embedding
dimension, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Places of the cut, in standard deviations of a block's eigenvalues around their mean, in the order they are tried.
CUTS = (0.0, 0.15, -0.15, 0.4, -0.4, 0.8, -0.8, 0.05, -0.05)
#: With weights below this the cheaper Cholesky form of a step is stable.
SAFE_WEIGHT = 100.0


def polar(a: np.ndarray) -> np.ndarray:
    """Unitary polar factor of a symmetric matrix without zero eigenvalues."""
    size = len(a)
    one = np.eye(size)
    x = a / np.linalg.norm(a)
    try:
        # 1 / norm of the inverse: no singular value is smaller.
        low = min(1.0, max(EPS, 1.0 / np.linalg.norm(np.linalg.inv(x))))
    except np.linalg.LinAlgError:
        low = EPS
    for _ in range(30):
        square = low * low
        d = (4.0 * (1.0 - square) / (square * square)) ** (1.0 / 3.0)
        root = np.sqrt(1.0 + d)
        p = root + 0.5 * np.sqrt(max(0.0, 8.0 - 4.0 * d + 8.0 * (2.0 - square) / (square * root)))
        q = (p - 1.0) ** 2 / 4.0
        r = p + q - 1.0
        if r > SAFE_WEIGHT:
            basis, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, one]))
            step = (p - q / r) / np.sqrt(r) * (basis[:size] @ basis[size:].T)
        else:
            factor = np.linalg.cholesky(one + r * (x.T @ x))
            step = (p - q / r) * np.linalg.solve(factor.T, np.linalg.solve(factor, x.T)).T
        after = q / r * x + step
        after = (after + after.T) / 2.0
        moved = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (p + q * square) / (1.0 + r * square))
        if moved <= EPS ** (1.0 / 3.0) and 1.0 - low <= 10.0 * EPS:
            break
    return x


def _bases(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns: the first ``rank`` span the projector's range, the others its complement."""
    start = np.random.default_rng(rank).standard_normal((len(projector), rank))
    for _ in range(2):
        start, _ = np.linalg.qr(projector @ start)
    return np.linalg.qr(start, mode="complete")[0]


def split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """(basis, rank): the leading ``rank`` columns span the eigenvectors above a cut. None for equal eigenvalues."""
    size, norm = len(a), np.linalg.norm(a)
    mean = np.trace(a) / size
    one = np.eye(size)
    spread = np.linalg.norm(a - mean * one) / np.sqrt(size)
    if size == 1 or spread <= 8.0 * EPS * norm:
        return None
    best, found = np.inf, None
    for cut in CUTS:
        projector = (polar(a - (mean + cut * spread) * one) + one) / 2.0
        rank = int(round(float(np.trace(projector))))
        if not 0 < rank < size:
            continue
        basis = _bases(projector, rank)
        # What couples the two parts: nothing but rounding, unless an eigenvalue lies on the cut.
        coupling = np.linalg.norm(basis[:, rank:].T @ a @ basis[:, :rank])
        if coupling < best:
            best, found = coupling, (basis, rank)
        if coupling <= 4.0 * size * EPS * norm:
            break
    return found if best < 0.1 * spread else None


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the ``wanted`` greatest eigenvalues above rounding, greatest first.

    Of each vector the entry largest in size, the first of several, is positive. Vectors of equal eigenvalues are any
    orthonormal ones of their space.
    """
    size = len(a)
    norm = np.linalg.norm(a)
    if not size or not np.isfinite(norm) or norm == 0.0:
        return np.zeros(0), np.zeros((0, size))
    done: list[np.ndarray] = []
    # Upper parts are taken from the stack first, so parts below the wanted ones are never split.
    waiting = [np.eye(size)]
    while waiting and len(done) < wanted:
        basis = waiting.pop()
        block = basis.T @ a @ basis
        parts = split((block + block.T) / 2.0)
        if parts is None:
            done.extend(basis.T)
        else:
            turned, rank = parts
            waiting.append(basis @ turned[:, rank:])
            waiting.append(basis @ turned[:, :rank])
    vectors = np.array([v / np.linalg.norm(v) for v in done])
    values = np.einsum("ij,jk,ik->i", vectors, a, vectors)
    kept = [k for k in np.argsort(-values, kind="stable") if values[k] > size * EPS * norm][:wanted]
    signs = [np.sign(vectors[k][np.argmax(np.abs(vectors[k]))]) for k in kept]
    return values[kept], vectors[kept] * np.array(signs).reshape(-1, 1)
