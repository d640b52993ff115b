"""Singular values and right singular vectors of a small matrix by a bidiagonal qd solver.

Householder reflections bring the matrix to upper bidiagonal form. The dqds transform, with
Laguerre's shifts from below, finds all singular values to high relative accuracy. Each
direction comes from a twisted factorisation of the bidiagonal's square less the value, and
is carried back through the reflections.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
NEGLIGIBLE = (100 * EPS) ** 2  # of squared entries
SWEEPS = 60  # per value, before the solver gives up
CLOSE = 1e-7  # relative distance of squared values that are resolved together


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, beta) so that ``x - beta * v * (v . x)`` has its first entry only."""
    scale = np.abs(x).max()
    if scale == 0:
        return x, 0.0
    v = x / scale
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v, 2 / float(v @ v)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, Q) with ``matrix = P B Q'``; the matrix is square."""
    a = np.array(matrix, float)
    n = len(a)
    q = np.eye(n)
    for k in range(n):
        v, beta = reflector(a[k:, k].copy())
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = reflector(a[k, k + 1 :].copy())
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            q[:, k + 1 :] -= beta * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def laguerre_shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest squared singular value, from the traces of the inverse
    and its square. All terms have one sign, so none cancels."""
    n = len(q)
    if min(q) <= 0:
        return 0.0
    first, second = -1.0, 0.0  # derivatives of the pivot
    s1, s2 = 1 / q[0], 1 / q[0] ** 2
    for i in range(1, n):
        ratio = e[i - 1] / q[i - 1]
        first, second = -1 + ratio * first, ratio * (second - 2 * first * first / q[i - 1])
        s1 -= first / q[i]
        s2 += (first / q[i]) ** 2 - second / q[i]
    root = math.sqrt(max(0.0, (n - 1) * (n * s2 - s1 * s1)))
    bound = n / (s1 + root)
    return bound * (1 - 4 * n * EPS) if math.isfinite(bound) else 0.0


def dqds_sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """The factors of the shifted product; None where the shift is too large."""
    new_q, new_e = [], []
    d = q[0] - shift
    for i, step in enumerate(e):
        if d < 0:
            return None
        pivot = d + step
        new_q.append(pivot)
        if pivot == 0:
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / pivot
            new_e.append(step * ratio)
            d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def squared_values(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values, falling, of the bidiagonal with squared entries ``q`` and ``e``."""
    out: list[float] = []
    pieces = [(list(q), list(e), 0.0, SWEEPS * len(q))]
    while pieces:
        q, e, found, left = pieces.pop()
        cut = next((i for i, x in enumerate(e) if x <= NEGLIGIBLE * (found + min(q[i], q[i + 1]))), None)
        if len(q) == 1:
            out.append(found + q[0])
        elif cut is not None:
            pieces.append((q[: cut + 1], e[:cut], found, left))
            pieces.append((q[cut + 1 :], e[cut + 1 :], found, left))
        elif not left:
            raise ArithmeticError(f"no convergence of {len(q)} values")
        else:
            bound = laguerre_shift(q, e)
            for shift in (bound, bound * (1 - 1e-8), bound / 2, 0.0):  # rounding may make the bound too high
                swept = dqds_sweep(q, e, shift)
                if swept is not None:
                    break
            pieces.append((*swept, found + shift, left - 1))
    return sorted(out, reverse=True)


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit right singular direction of the bidiagonal for a squared value.

    ``B'B - value`` is factored from the top (stationary) and from the bottom (progressive);
    the two meet where the remaining pivot is smallest, and the direction follows from there.
    """
    n = len(a)
    low, aux = np.zeros(n), np.zeros(n)  # multipliers and auxiliary values from the top
    tiny = EPS * EPS * float(np.abs(a).max()) ** 2
    aux[0] = -value
    for i in range(n - 1):
        pivot = aux[i] + a[i] ** 2 or tiny
        low[i] = a[i] * b[i] / pivot
        aux[i + 1] = low[i] * (b[i] / a[i]) * aux[i] - value
    up, rest = np.zeros(n), np.zeros(n)  # the same from the bottom
    rest[n - 1] = a[n - 1] ** 2 - value
    for i in range(n - 2, -1, -1):
        pivot = b[i] ** 2 + rest[i + 1] or tiny
        up[i] = a[i] * b[i] / pivot
        rest[i] = rest[i + 1] * (a[i] ** 2 / pivot) - value
    twist = int(np.argmin(np.abs(aux + rest + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _close_directions(a: np.ndarray, b: np.ndarray, values: list[float]) -> np.ndarray:
    """Orthonormal directions of squared values too close to be told apart one by one."""
    square = np.diag(a**2) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    square[1:, 1:] += np.diag(b**2)
    span = np.random.default_rng(len(a)).standard_normal((len(a), len(values)))
    beside = values[0] * (1 + 1e-12)
    for _ in range(3):
        span = np.linalg.qr(np.linalg.solve(square - beside * np.eye(len(a)), span))[0]
    found, inner = np.linalg.eigh(span.T @ square @ span)
    return span @ inner[:, np.argsort(-found)]


def right_directions(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values falling, directions as columns) of the largest values, ``most`` at most.

    Values that are nothing but rounding (below some ``n * EPS`` of the largest) are left out.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).max(initial=0.0))
    if scale == 0:
        return np.zeros(0), np.zeros((n, 0))
    a, b, q = bidiagonalise(matrix / scale)
    values = squared_values((a**2).tolist(), (b**2).tolist())
    values = [v for v in values if v > (8 * n * EPS) ** 2 * values[0]]
    least = EPS * EPS * float(np.abs(a).max())
    a = np.where(np.abs(a) < least, least, a)  # a zero has no multiplier
    columns: list[np.ndarray] = []
    at = 0
    while at < min(most, len(values)):
        end = at + 1
        while end < len(values) and values[end - 1] - values[end] < CLOSE * values[at]:
            end += 1
        if end - at == 1:
            columns.append(twisted_vector(a, b, values[at]))
        else:
            columns.extend(_close_directions(a, b, values[at:end]).T)
        at = end
    kept = min(most, len(values))
    z, r = np.linalg.qr(np.column_stack(columns))
    directions = q @ (z * np.sign(np.diag(r)))
    return scale * np.sqrt(values[:kept]), directions[:, :kept]
