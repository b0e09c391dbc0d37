"""Pairs of similar sets, compared block by block in Arrow tasks (GRF-04).

The rows of a group are cut into hash blocks and every two blocks meet in one
place, where all their pairs are counted and tested at once. Nothing but pairs
that reach the threshold leaves a task, so what is shuffled grows with the sets
times the number of blocks, never with the candidates. A task holds two blocks
and the counts of one strip of rows.

Items of both blocks are counted by a matrix product if many of their rows hold
them, else by listing the rows that share them; both counts are exact.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# tasks get this module by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block, rows of a strip, items of one matrix product, shared places listed at once.
BLOCK, STRIP, WIDTH, LISTED = 2048, 512, 512, 1 << 21
#: An item is listed if it makes this many times fewer shared places than there are pairs of rows.
RARE = 64


def meetings(members: DataFrame, *, blocks) -> DataFrame:
    """``members`` (group, entity, items) copied to every meeting (group, i, j) of its block; ``blocks`` is the group's number of them."""
    own = F.pmod(F.xxhash64("entity"), blocks.cast("bigint")).cast("int")
    m = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    return m.select("group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "entity", "items")


def similar_pairs(met: DataFrame, threshold: float, *, links_only: bool = False) -> DataFrame:
    """(entity_a < entity_b, size_a, size_b, intersection, jaccard) with Jaccard >= ``threshold`` of every meeting.

    ``links_only`` keeps of a meeting's pairs a spanning forest: as many as join
    all that its pairs join. Pairs of entities in several groups come once each.
    """
    entity = met.schema["entity"].dataType
    long = T.LongType()
    schema = T.StructType([T.StructField(*f) for f in (("x", entity), ("y", entity), ("nx", long), ("ny", long), ("intersection", long), ("jaccard", T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            yield from _compared(table, threshold, links_only)

    keys = ["group", "i", "j"]
    found = met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
    swap = F.col("x") > F.col("y")
    side = lambda one, two, name: F.when(swap, F.col(two)).otherwise(F.col(one)).alias(name)
    return found.select(side("x", "y", "entity_a"), side("y", "x", "entity_b"), side("nx", "ny", "size_a"), side("ny", "nx", "size_b"), "intersection", "jaccard")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (group, i, j), which come in sorted order and may span batches; small meetings of a block
    with itself come several in one table."""
    pool, pooled, kept, rows, last = [], 0, [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "i", "j")]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]]).tolist()
        for start, end in zip(cuts, cuts[1:]):
            key = (keys[0][start], keys[1][start], keys[2][start])
            if key != last:
                if rows > 1:
                    if last[1] == last[2] and rows <= STRIP:
                        pool += kept
                        pooled += rows
                    else:
                        yield pa.Table.from_batches(kept)
                if pooled >= STRIP:
                    yield pa.Table.from_batches(pool)
                    pool, pooled = [], 0
                kept, rows, last = [], 0, key
            kept.append(batch.slice(start, end - start))
            rows += end - start
    if rows > 1:
        yield pa.Table.from_batches(kept)
    if pooled:
        yield pa.Table.from_batches(pool)


def _entries(items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every item of the sets; equal items have equal codes."""
    sizes = pc.list_value_length(items).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = pc.dictionary_encode(items.flatten()).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), codes, sizes


def _compared(table: pa.Table, threshold: float, links_only: bool) -> Iterator[pa.RecordBatch]:
    if table.num_rows < 2:
        return
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    group = table.column("group").to_numpy()
    ids = table.column("entity").combine_chunks()
    row, code, sizes = _entries(table.column("items").combine_chunks())
    own = table.column("own").to_numpy()
    # the meetings of one table are of blocks with themselves: all its rows are on both sides
    left, right = (np.arange(table.num_rows),) * 2 if i == j else (np.flatnonzero(own == i), np.flatnonzero(own == j))
    if not (len(left) and len(right)):
        return
    label = np.arange(table.num_rows)
    for a, counts in _counted(row, code, left, right, table.num_rows):
        na, nb = sizes[a][:, None], sizes[right][None, :]
        # what can't reach the threshold goes by a cheap test, the rest by the exact one
        r, c = np.nonzero(counts * (1.0 + threshold) >= threshold * (na + nb) - 1e-6)
        if i == j:
            once = (a[r] < right[c]) & (group[a[r]] == group[right[c]]) & (own[a[r]] == own[right[c]])
            r, c = r[once], c[once]
        both, x, y = counts[r, c].astype(np.int64), a[r], right[c]
        jaccard = both / (sizes[x] + sizes[y] - both)
        ok = (jaccard >= threshold - 1e-12) & (both > 0)
        x, y, both, jaccard = x[ok], y[ok], both[ok], jaccard[ok]
        if links_only:
            label, at = _forest(label, x, y)
            x, y, both, jaccard = x[at], y[at], both[at], jaccard[at]
        for s in range(0, len(x), 100_000):
            w = slice(s, s + 100_000)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(x[w])), ids.take(pa.array(y[w])), pa.array(sizes[x[w]]), pa.array(sizes[y[w]]), pa.array(both[w]), pa.array(jaccard[w])],
                names=["x", "y", "nx", "ny", "intersection", "jaccard"])


def _counted(row, code, left, right, rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the left block, their shared items with every right row), strip by strip."""
    at_left, at_right = np.full(rows, -1), np.full(rows, -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    la, lc = at_left[row], code
    ra, rc = at_right[row], code
    la, lc, ra, rc = la[la >= 0], lc[la >= 0], ra[ra >= 0], rc[ra >= 0]
    n = int(code.max()) + 1 if len(code) else 0
    fa, fb = np.bincount(lc, minlength=n), np.bincount(rc, minlength=n)
    common = (fa > 0) & (fb > 0)
    dense = common & (fa * fb * RARE > len(left) * len(right))
    rare = common & ~dense
    place = np.where(dense, np.cumsum(dense) - 1, -1)
    width = int(dense.sum())
    # right side: rows of each rare item in one run; dense items by column
    keep = rare[rc]
    order = np.argsort(rc[keep], kind="stable")
    runs, first = ra[keep][order], np.concatenate([[0], np.cumsum(np.bincount(rc[keep], minlength=n))]) if n else np.zeros(1, np.int64)
    keep = dense[rc]
    dr, dp = ra[keep], place[rc[keep]]
    by = np.argsort(la, kind="stable")
    la, lc = la[by], lc[by]
    for s in range(0, len(left), STRIP):
        e = min(s + STRIP, len(left))
        lo, hi = np.searchsorted(la, [s, e])
        r, c = la[lo:hi] - s, lc[lo:hi]
        counts = np.zeros((e - s, len(right)), dtype=np.int32)
        for w in range(0, width, WIDTH):
            cols = min(WIDTH, width - w)
            p = place[c]
            m = (p >= w) & (p < w + cols)
            one, two = np.zeros((e - s, cols), np.float32), np.zeros((len(right), cols), np.float32)
            one[r[m], p[m] - w] = 1
            m = (dp >= w) & (dp < w + cols)
            two[dr[m], dp[m] - w] = 1
            counts += (one @ two.T).astype(np.int32)
        m = rare[c]
        r, c = r[m], c[m]
        ends = np.cumsum(fb[c])
        flat, k = counts.reshape(-1), 0
        while k < len(c):
            stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + LISTED, side="right")))
            lens = fb[c[k:stop]]
            inside = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
            at = np.repeat(r[k:stop], lens) * len(right) + runs[np.repeat(first[c[k:stop]], lens) + inside]
            where, times = np.unique(at, return_counts=True)
            flat[where] += times.astype(np.int32)
            k = stop
        yield left[s:e], counts


def _forest(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of the components after the edges (x, y), and the edges that joined two: each component with a lower
    neighbour hooks to the lowest, round by round."""
    at, kept = np.arange(len(x)), []
    while True:
        one, two = label[x[at]], label[y[at]]
        apart = one != two
        at, one, two = at[apart], one[apart], two[apart]
        if not len(at):
            break
        high, low = np.maximum(one, two), np.minimum(one, two)
        order = np.lexsort((low, high))
        first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
        kept.append(at[first])
        up = np.arange(len(label))
        up[high[first]] = low[first]
        while not np.array_equal(up, up[up]):
            up = up[up]
        label = up[label]
    return label, np.concatenate(kept) if kept else at
