"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector, taken from the mean and made a unit vector, is rotated at random and
kept as the signs of its coordinates, with two correction scalars: its distance
from the mean, and the inner product of the unit vector with its own code. From
the packed bits and a query quantised to 8 bits a coordinate, bit counts give an
unbiased estimate of the inner product with an error bound of the order of
1 / sqrt(dimensions). Every vector whose lower bound of the distance is not
above the k-th best exact distance met so far is ranked again by its exact
distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retail_spark.llm import vectors
from retail_spark.llm.common import map_arrow, stash

#: Width of the error bound in standard deviations of the estimate; the paper's 1.9 already finds nearly all.
EPSILON = 2.5
QUERY_BITS = 8


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix for vectors padded to whole 64-bit words."""
    wide = -(-dim // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((wide, wide)))
    return q * np.sign(np.diag(r))


def _rotated(vectors_: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors from the centre, padded and rotated, and their lengths."""
    rest = vectors_ - centre
    rest = np.pad(rest, ((0, 0), (0, turn.shape[0] - rest.shape[1]))) @ turn
    return rest, np.linalg.norm(rest, axis=1)


def encode(vectors_: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, words), lengths, and inner products of unit vectors with their codes."""
    rest, length = _rotated(vectors_, centre, turn)
    unit = rest / np.where(length > 0, length, 1)[:, None]
    bits = unit > 0
    codes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    own = np.abs(unit).sum(axis=1) / np.sqrt(unit.shape[1])
    return codes, length, np.where(length > 0, own, 1.0)


def estimate(codes: np.ndarray, length: np.ndarray, own: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance from a rotated query to every coded vector, and the half width of its bound."""
    wide = len(query)
    norm = float(np.linalg.norm(query))
    low, high = float(query.min()), float(query.max())
    step = (high - low) / ((1 << QUERY_BITS) - 1) or 1.0
    whole = np.rint((query - low) / step).astype(np.int64)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    hits = np.zeros(len(codes), dtype=np.int64)
    for j in range(QUERY_BITS):
        plane = np.packbits((whole >> j) & 1 == 1, bitorder="little").view(np.uint64)
        hits += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j
    # <code, query> with code coordinates of +-1 / sqrt(wide)
    dot = (2 * (step * hits + low * ones) - (step * whole.sum() + low * wide)) / np.sqrt(wide)
    inner = dot / own
    width = norm * np.sqrt(np.maximum(0, 1 - own ** 2)) / own * EPSILON / np.sqrt(max(1, wide - 1)) + step
    return length ** 2 + norm ** 2 - 2 * length * inner, 2 * length * width


def _centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector of each number of components (so many numbers reach the driver, whatever the rows)."""

    def sums():
        def step(batch):
            out = {"dim": [], "at": [], "total": [], "n": []}
            of: dict[int, list] = {}
            for v in batch.column(0).to_pylist():
                of.setdefault(len(v), []).append(v)
            for dim, vs in of.items():
                for at, total in enumerate(np.sum(np.array(vs, dtype=np.float64), axis=0).tolist()):
                    for k, x in zip(out, (dim, at, total, len(vs))):
                        out[k].append(x)
            return out

        return step

    parts = map_arrow(rows.select("v"), sums, "dim int, at int, total double, n bigint")
    means = parts.groupBy("dim", "at").agg((F.sum("total") / F.sum("n")).alias("mean")).orderBy("dim", "at").collect()
    out: dict[int, list[float]] = {}
    for r in means:
        out.setdefault(r["dim"], []).append(float(np.float32(r["mean"])))
    return {d: np.array(v) for d, v in out.items()}


def build_index(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """One row a block: dim, block, ids, codes, scalars and the vectors for the exact ranking, packed."""

    def build(key, table):
        dim = key[0].as_py()
        ids, values = table.column("vec_id").to_numpy().astype(np.int64), vectors.matrix(table, "v", dim)
        codes, length, own = encode(values, centres[dim], rotation(dim))
        packed = [ids.tobytes(), codes.tobytes(), np.stack([length, own]).tobytes(), values.tobytes()]
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         **{n: pa.array([p], pa.binary()) for n, p in zip(("ids", "codes", "scalars", "vectors"), packed)}})

    return rows.groupBy("dim", "block").applyInArrow(
        build, "dim int, block int, ids binary, codes binary, scalars binary, vectors binary")


def nearest(embeddings: DataFrame, is_query: Column, k: int, *, block: int = vectors.ROWS, queries: int = vectors.QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found of each query row, by Euclidean distance.

    Rows of ``embeddings`` (vec_id, embedding) for which ``is_query`` holds are
    searched against every usable row of the same number of components but
    those with the query's own vec_id. ``score`` is the exact distance of the
    vectors as given, in double precision. Ties go to smaller ids; queries with
    fewer rows to meet get them all. Rows alike count once. Null and zero
    vectors and vectors with null or non-finite components take no part.
    """
    rows = stash(vectors.usable(embeddings, zero=False), "vectors")
    centres = _centres(rows)
    placed, blocks = vectors.dealt(rows, block, "block")
    asked, query_blocks = vectors.dealt(rows.filter(is_query), queries, "query_block")
    index = stash(build_index(placed, centres), "codes")

    def search(left, right):
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            turn = rotation(dim)
            ids, codes, scalars, values = (np.frombuffer(left.column(n)[0].as_py(), t) for n, t in
                                           (("ids", np.int64), ("codes", np.uint64), ("scalars", np.float64), ("vectors", np.float64)))
            codes, values = codes.reshape(len(ids), -1), values.reshape(len(ids), dim)
            length, own = scalars.reshape(2, -1)
            exact = vectors.matrix(right, "v", dim)
            turned, _ = _rotated(exact, centres[dim], turn)

            def distances(q, at):
                return np.sqrt(((values[at] - q) ** 2).sum(axis=1))

            for q_id, q, t in zip(right.column("vec_id").to_pylist(), exact, turned):
                guess, width = estimate(codes, length, own, t)
                others = np.flatnonzero(ids != q_id)
                if len(others) > k:
                    first = others[np.argpartition(guess[others], k - 1)[:k]]
                    limit = distances(q, first).max() ** 2
                    # a hair above: the limit itself is rounded
                    others = others[guess[others] - width[others] <= limit * (1 + 1e-9) + 1e-12]
                d = distances(q, others)
                order = np.lexsort((ids[others], d))[:k]
                found.append((np.full(len(order), q_id), ids[others][order], d[order]))
        columns = [np.concatenate(c) if found else np.zeros(0) for c in (zip(*found) if found else ((), (), ()))]
        return pa.table({n: pa.array(c.astype(t)) for n, c, t in zip(("query_id", "vec_id", "score"), columns, (np.int64, np.int64, np.float64))})

    found = vectors.every_pair(index, blocks, asked, query_blocks, search, "query_id bigint, vec_id bigint, score double")
    return vectors.best(found, k, F.col("score")).select("query_id", "rank", "vec_id", "score")
