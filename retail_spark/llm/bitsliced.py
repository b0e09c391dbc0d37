"""Exact top-k inner product over a bit-sliced index.

A block's quantised attributes are kept as slices: bitmap ``b`` of attribute
``d`` has a bit for each row whose value has bit ``b``. A query's score of all
rows is the sum of slices shifted by the bits of its own components, done with
carry-save adders on whole bitmaps. The sum is again in slices, from which the
best rows are selected from the most significant slice downward; rows that tie
at the boundary are resolved exactly, to the smaller ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retail_spark.llm import vectors
from retail_spark.llm.common import stash

#: Steps of a component's unit.
STEPS = 256
#: Bits of a quantised component in the slices at most; rows with larger ones are scored apart, in whole numbers of any size.
MOST_BITS = 31
#: Rows and queries of a block of those.
EXACT_ROWS = 1_024


def _slices(values: np.ndarray, bits: int) -> np.ndarray:
    """(attributes, bits, words): bitmaps of ``values`` (rows, attributes), offset to be at least 0."""
    n, dim = values.shape
    words = max(1, -(-n // 64))
    out = np.zeros((dim, bits, words * 64), dtype=np.uint8)
    shifted = (values + (1 << (bits - 1))).astype(np.uint64).T
    for b in range(bits):
        out[:, b, :n] = (shifted >> np.uint64(b)) & np.uint64(1)
    return np.packbits(out, axis=2, bitorder="little").view(np.uint64).reshape(dim, bits, words)


def _add(levels: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps, those of ``levels[p]`` counting 2**p a bit: the slices of the sum from bit 0."""
    out, p = [], 0
    while levels:
        stacks = levels.pop(p, [])
        maps = np.concatenate(stacks) if stacks else None
        while maps is not None and len(maps) > 1:
            m = len(maps) // 3 * 3
            if m:  # three bitmaps of weight 2**p are one of that weight and one of the next
                a, b, c = maps[0:m:3], maps[1:m:3], maps[2:m:3]
                either = a ^ b
                carry, total, rest = (a & b) | (c & either), either ^ c, maps[m:]
            else:
                a, b = maps[0:1], maps[1:2]
                carry, total, rest = a & b, a ^ b, maps[2:]
            levels.setdefault(p + 1, []).append(carry)
            maps = np.concatenate([total, rest]) if len(rest) else total
        out.append(None if maps is None else maps[0])
        p += 1
    return out


def score_slices(slices: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray | None], int]:
    """Slices of a number for each row, and what to add to it for the row's inner product with ``query``.

    A negative component adds its size times the row's complement.
    """
    bits = slices.shape[1]
    size = np.abs(query)
    levels: dict[int, list[np.ndarray]] = {}
    for negative in (False, True):
        for j in range(int(size.max(initial=0)).bit_length()):
            at = np.flatnonzero(((size >> j) & 1 == 1) & ((query < 0) == negative))
            if len(at):
                part = ~slices[at] if negative else slices[at]
                for b in range(bits):
                    levels.setdefault(j + b, []).append(part[:, b])
    # value = slice value - offset; for a complement c: value = (2**bits - 1 - c) - offset
    offset, full = 1 << (bits - 1), (1 << bits) - 1
    constant = sum(-int(q) * offset if q > 0 else int(q) * (full - offset) for q in query.tolist())
    return _add(levels), constant


def select(planes: list[np.ndarray | None], rows: np.ndarray, k: int) -> list[int]:
    """Row numbers of the ``k`` largest of ``rows`` (a bitmap): larger sums first to be sure, ties to smaller numbers."""
    sure, open_ = np.zeros_like(rows), rows.copy()
    if int(np.bitwise_count(rows).sum()) > k:
        for plane in reversed(planes):
            high = open_ & plane if plane is not None else np.zeros_like(rows)
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                open_ = high
            else:
                sure |= high
                if n == k:
                    open_ = np.zeros_like(rows)
                    break
                open_ = open_ & ~plane if plane is not None else open_
    else:
        sure, open_ = rows, np.zeros_like(rows)
    chosen = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    need = k - len(chosen)
    if need > 0 and open_.any():
        # the boundary: equal sums; a block's rows stand in order of their ids
        words = np.flatnonzero(open_)
        words = words[: need]
        ties = np.flatnonzero(np.unpackbits(open_[words].view(np.uint8), bitorder="little"))[:need]
        chosen = np.concatenate([chosen, words[ties // 64] * 64 + ties % 64])
    return chosen.tolist()


def _value(planes: list[np.ndarray | None], row: int) -> int:
    return sum(int((int(p[row >> 6]) >> (row & 63)) & 1) << k for k, p in enumerate(planes) if p is not None)


def build_index(rows: DataFrame, bits: int) -> DataFrame:
    """One row a block: dim, block, ids (ascending) and slices, packed."""

    def build(key, table):
        dim = key[0].as_py()
        ids = table.column("vec_id").to_numpy()
        values = np.floor(vectors.matrix(table, "v", dim) * STEPS).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        packed = _slices(values[order], bits)
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "ids": pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()),
                         "slices": pa.array([packed.tobytes()], pa.binary())})

    return rows.groupBy("dim", "block").applyInArrow(build, "dim int, block int, ids binary, slices binary")


FOUND = "query_id bigint, vec_id bigint, score bigint"


def _steps(x: Column) -> Column:
    """A component in steps, as a whole double: too large ones for a long included."""
    scaled = x * STEPS
    return F.when(F.abs(scaled) < F.lit(2.0 ** 52), F.floor(scaled).cast("double")).otherwise(scaled)


def _whole(x: float) -> int:
    """A component in steps, exactly; doubles of 2**53 and more are whole."""
    return int(x) * STEPS if abs(x) >= 2.0 ** 53 else math.floor(x * STEPS)


def _exactly(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``FOUND``: the ``k`` best of every block for each query, by products of whole numbers of any size."""

    def search(left, right):
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            held, queries = (np.array([[_whole(x) for x in v] for v in vectors.matrix(t, "v", dim).tolist()], dtype=object).reshape(t.num_rows, dim)
                             for t in (left, right))
            ids = left.column("vec_id").to_pylist()
            for q, query in zip(right.column("vec_id").to_pylist(), queries):
                scored = sorted((-int(s), i) for s, i in zip(held.dot(query), ids) if i != q)[:k]
                if any(not -(2 ** 63) <= -s < 2 ** 63 for s, _ in scored):
                    raise OverflowError(f"a best score of vector {q} leaves a long")
                for s, i in scored:
                    for name, value in (("query_id", q), ("vec_id", i), ("score", -s)):
                        out[name].append(value)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    placed, blocks = vectors.dealt(rows, EXACT_ROWS, "block")
    asked, query_blocks = vectors.dealt(asked, EXACT_ROWS, "query_block")
    return vectors.every_pair(placed, blocks, asked, query_blocks, search, FOUND)


def top_inner_products(embeddings: DataFrame, is_query: Column, k: int, *, block: int = vectors.ROWS, queries: int = vectors.QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest integer inner products of each query row.

    Every component x counts as ``floor(256 * x)``. Rows of ``embeddings``
    (vec_id, embedding) for which ``is_query`` holds are searched against every
    usable row of the same number of components but those with the query's own
    vec_id. Ties go to smaller ids; queries with fewer rows to meet get them
    all, those with none get no row. Rows alike count once; rows that share an
    id but not the vector are all searched and found. Null vectors and vectors
    with null or non-finite components take no part. Rows with a component of
    ``MOST_BITS`` bits and more have no slices; they meet the queries, and as
    queries all rows, in products of whole numbers of any size. Only a score
    among a query's best that leaves a long raises an error.
    """
    rows = stash(vectors.usable(embeddings, zero=True), "vectors")
    reach = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(_steps(x))))
    is_wide = reach >= F.lit(float(1 << (MOST_BITS - 1)))
    wide, rows = rows.filter(is_wide), rows.filter(~is_wide)
    bits = int(rows.agg(F.max(reach)).first()[0] or 0).bit_length() + 1
    placed, blocks = vectors.dealt(rows, block, "block")
    asked, query_blocks = vectors.dealt(rows.filter(is_query), queries, "query_block")
    index = stash(build_index(placed, bits), "slices")

    def search(left, right):
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            ids = np.frombuffer(left.column("ids")[0].as_py(), np.int64)
            n_words = max(1, -(-len(ids) // 64))
            slices = np.frombuffer(left.column("slices")[0].as_py(), np.uint64).reshape(dim, bits, n_words)
            exists = np.packbits(np.arange(n_words * 64) < len(ids), bitorder="little").view(np.uint64)
            asked = np.floor(vectors.matrix(right, "v", dim) * STEPS).astype(np.int64)
            for q, query in zip(right.column("vec_id").to_pylist(), asked):
                planes, constant = score_slices(slices, query)
                others = exists.copy()
                for r in range(*np.searchsorted(ids, [q, q + 1]).tolist()):
                    others[r >> 6] &= ~np.uint64(1 << (r & 63))
                for r in select(planes, others, k):
                    for name, value in (("query_id", q), ("vec_id", int(ids[r])), ("score", _value(planes, r) + constant)):
                        out[name].append(value)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    found = vectors.every_pair(index, blocks, asked, query_blocks, search, FOUND)
    if wide.take(1):
        wide_queries = wide.filter(is_query)
        found = found.union(_exactly(wide, asked.drop("query_block"), k)).union(_exactly(wide.union(rows), wide_queries, k))
    return vectors.best(found, k, F.desc("score")).select("query_id", "rank", "vec_id", "score")
