"""The largest products of factors between a block of users and a block of items, in an Arrow task (GRF-07)."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# tasks get this module by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Users and items of one product of matrices.
ROWS, COLUMNS = 512, 2048


def best_of_blocks(k: int):
    """The cogrouped function: (user, its ``k`` best items of the block, best first)."""

    def run(users: pa.Table, items: pa.Table) -> pa.Table:
        u, v = _matrix(users), _matrix(items)
        ids, named = users.column("id").to_numpy(), items.column("id").to_numpy()
        score, at = top_products(u, v, named, k) if len(u) and len(v) else (np.zeros((0, 0), np.float32),) * 2
        n, each = score.shape
        flat = pa.StructArray.from_arrays([pa.array(score.reshape(-1), pa.float32()), pa.array(named[at.reshape(-1).astype(np.int64)], pa.int32())], ["score", "item"])
        best = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * each, pa.int32()), flat)
        return pa.table({"user": pa.array(ids[:n], pa.int32()), "best": best})

    return run


def _matrix(table: pa.Table) -> np.ndarray:
    if not table.num_rows:
        return np.zeros((0, 0), np.float32)
    return table.column("features").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).astype(np.float32, copy=False)


def top_products(u: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, rows of ``v``) of the ``k`` largest products of every row of ``u``, equal ones by ``ids``.

    ``v`` is taken by falling length: |u| |v| bounds a product, so rows of ``u``
    whose k-th best lies above the bound of what is left are done.
    """
    length = lambda x: np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64))
    lengths = length(v)
    order = np.lexsort((ids, -lengths))
    v, lengths, own = v[order], lengths[order], length(u)
    k = min(k, len(v))
    score, at = np.full((len(u), k), -np.inf, np.float32), np.zeros((len(u), k), np.int64)
    for s in range(0, len(u), ROWS):
        rows = np.arange(s, min(s + ROWS, len(u)))
        for c in range(0, len(v), COLUMNS):
            # the bound allows for rounding of 32-bit products; an item that ties may still have the smaller id
            rows = rows[score[rows, -1] <= own[rows] * lengths[c] * (1 + 1e-5) + 1e-30]
            if not len(rows):
                break
            part = u[rows] @ v[c : c + COLUMNS].T
            if c == 0:
                _keep(score, at, rows, part, np.broadcast_to(np.arange(part.shape[1]), part.shape), ids, order)
                continue
            low = score[rows, -1][:, None]
            hit = part >= low
            some = np.flatnonzero(hit.any(1))
            for r in some:
                cols = np.flatnonzero(hit[r])
                _keep(score, at, rows[r : r + 1], part[r : r + 1, cols], (c + cols)[None, :], ids, order)
    return score, order[at]


def _keep(score, at, rows, part, cols, ids, order) -> None:
    """The best of what ``rows`` have and of ``part``, whose columns are ``cols``."""
    known = np.isfinite(score[rows])
    scores = np.concatenate([np.where(known, score[rows], -np.inf), part], 1)
    places = np.concatenate([at[rows], cols], 1)
    k = score.shape[1]
    if scores.shape[1] > 16 * k:  # only what reaches the k-th best needs sorting
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        for n, r in enumerate(rows):
            few = np.flatnonzero(scores[n] >= kth[n])
            first = few[np.lexsort((ids[order[places[n, few]]], -scores[n, few]))[:k]]
            score[r], at[r] = scores[n, first], places[n, first]
        return
    for n, r in enumerate(rows):
        first = np.lexsort((ids[order[places[n]]], -scores[n]))[:k]
        score[r], at[r] = scores[n, first], places[n, first]
