"""Eigenvectors of a symmetric matrix by mixed-precision refinement.

A float32 decomposition is corrected by Ogita-Aishima iterations, which need
matrix products only: first in float64, then in extended precision. Where
eigenvalues lie too close together for that (less apart than the error of the
vectors), an iteration only makes the vectors orthonormal; the directions
inside such a cluster come from the small problem that the matrix poses within
the cluster's space, shifted and scaled so that its eigenvalues are apart
again, and solved in the same way.
"""

from __future__ import annotations

import numpy as np

#: Precisions of the iterations, in turn.
LADDER = (np.float64, np.longdouble)
MAX_ITERATIONS = 8
MAX_ROUNDS = 8


def _iterate(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima iteration: better vectors, the eigenvalues of ``x``,
    and the distance from which on two eigenvalues count as apart."""
    eye = np.eye(len(a), dtype=a.dtype)
    r = eye - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    least = 2 * (np.linalg.norm(off) + np.linalg.norm(a) * np.linalg.norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > least
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(least)


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Iterations until the vectors stand still in the precision of ``a``."""
    x = x.astype(a.dtype)
    floor = 4 * np.sqrt(len(a)) * np.finfo(a.dtype).eps
    for _ in range(MAX_ITERATIONS):
        new = _iterate(a, x)[0]
        change = float(np.abs(new - x).max())
        if not np.isfinite(change):
            break
        x = new
        if change <= floor:
            break
    _, values, least = _iterate(a, x)
    return x, values, least


def _clusters(values: np.ndarray, least: float) -> list[np.ndarray]:
    """Runs of falling eigenvalues, each nearer than ``least`` to the next."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > least) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def _solve(a: np.ndarray, noise: float) -> np.ndarray:
    """Eigenvectors of ``a``; what differs by less than ``noise`` is one
    eigenvalue, any orthonormal basis of whose space will do."""
    d = len(a)
    size = float(np.linalg.norm(a))
    if d == 1 or size <= noise:
        return np.eye(d, dtype=a.dtype)
    x = np.linalg.eigh((a / size).astype(np.float32))[1]
    for kind in LADDER:
        scaled = (a / size).astype(kind)
        x, values, least = _refine(scaled, x)
        for _ in range(MAX_ROUNDS):
            near = _clusters(values, least)
            moved = False
            for run in near:
                inner = x[:, run].T @ (scaled @ x[:, run])
                inner = (inner + inner.T) / 2
                inner = inner - np.eye(len(run), dtype=kind) * (np.trace(inner) / len(run))
                limit = max(noise / size, float(d * np.finfo(kind).eps))
                if np.linalg.norm(inner) <= limit or len(run) == d:
                    continue
                x[:, run] = x[:, run] @ _solve(inner, limit)
                moved = True
            if not moved:
                break
            x, values, least = _refine(scaled, x)
    return x


def symmetric_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix, in extended precision where the machine has it. Of the two signs of
    a vector the one whose largest entry is positive is taken. Equal eigenvalues
    give any orthonormal basis of their space; an empty matrix gives nothing."""
    a = np.asarray(a, dtype=LADDER[-1])
    if not len(a):
        return np.zeros(0, a.dtype), a
    a = (a + a.T) / 2
    x = _solve(a, float(len(a) * np.finfo(a.dtype).eps * np.linalg.norm(a)))
    for _ in range(2):  # rounding errors between near eigenvalues leave the angles last
        x = x + x @ (np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    lead = np.take_along_axis(x, np.abs(x).argmax(axis=0)[None, :], axis=0)
    return values[order], x * np.where(lead < 0, -1, 1)
