"""Numpy arithmetic on one Arrow batch of vectors, used inside Spark tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Entries of one matrix product held at a time: 32 MB.
PRODUCT_CELLS = 4_000_000


def batch_matrix(column: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows as a float64 matrix, and which rows are real vectors of length ``dim``."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    ok = lengths == dim
    if ok.all() and flat.null_count == 0:
        return flat.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64), ok
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
    holes = np.zeros(len(flat), dtype=bool) if flat.null_count == 0 else flat.is_null().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(np.maximum(lengths, 0))))[:-1]
    matrix = np.zeros((len(column), dim))
    found = np.flatnonzero(ok)
    places = starts[found][:, None] + np.arange(dim)
    whole = ~holes[places].any(axis=1)
    matrix[found[whole]] = values[places[whole]]
    ok[found[~whole]] = False
    return matrix, ok


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; NaN for a zero row."""
    norm = np.sqrt((x * x).sum(axis=-1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(norm > 0, x / norm, np.nan)


def exact_cost(metric: str, x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cost (lower is nearer) of matching rows of ``x`` and ``q``; NaN where undefined."""
    if metric == "l2":
        gap = x - q
        return np.sqrt((gap * gap).sum(axis=-1))
    if metric == "hamming":
        return (x != q).sum(axis=-1).astype(np.float64)
    dot = (x * q).sum(axis=-1)
    if metric == "ip":
        return -dot
    norms = np.sqrt((x * x).sum(axis=-1)) * np.sqrt((q * q).sum(axis=-1))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(norms > 0, 1.0 - dot / norms, np.nan)


def cost_matrix(metric: str, x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float]:
    """All costs by one matrix product, and a bound on their error."""
    if metric == "l2":
        xx, qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
        squared = qq[:, None] + xx[None, :] - 2.0 * (q @ x.T)
        scale = float(np.sqrt(max(xx.max(initial=0.0), qq.max(initial=0.0), 1e-30)))
        return np.sqrt(np.maximum(squared, 0.0)), 1e-6 * scale
    if metric == "hamming":
        signs = (2.0 * q - 1.0) @ (2.0 * x - 1.0).T
        return (x.shape[1] - signs) / 2.0, 0.25
    if metric == "ip":
        costs = -(q @ x.T)
        return costs, 1e-9 * float(np.abs(costs).max(initial=1.0))
    return 1.0 - unit_rows(q) @ unit_rows(x).T, 1e-9


def nearest_rows(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of the nearest centre and a cost comparable between blocks of centres."""
    squares = (centres * centres).sum(axis=1)[None, :]
    step = max(1, PRODUCT_CELLS // len(centres))
    best = np.empty(len(x), dtype=np.int64)
    cost = np.empty(len(x))
    for at in range(0, len(x), step):
        part = squares - 2.0 * (x[at : at + step] @ centres.T)
        best[at : at + step] = part.argmin(axis=1)
        cost[at : at + step] = part.min(axis=1)
    return best, cost
