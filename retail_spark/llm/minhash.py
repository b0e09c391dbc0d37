"""MinHash near-duplicate detection by one-permutation hashing.

Each document is hashed once: the top bits of a shingle's hash choose one of
``BANDS * ROWS`` bins and the smallest hash of a bin is its value. Empty bins
copy from a bin found by a sequence of universal hashes (optimal
densification), so bin values of two sets agree with the sets' Jaccard
similarity even for sets far smaller than the number of bins. Bands of bins
form buckets; candidates are stars around one centre a bucket, never all
pairs, and every candidate is confirmed on the full shingle sets.

Steps and what they move:

1. ``sketches``: one pass over the texts, no shuffle; written to the shared folder.
2. Documents with equal shingle sets become one class (a grouped minimum), so a
   huge group of copies costs one representative afterwards.
3. Band buckets with two or more classes. The centre of a bucket is the member
   that meets most others over all its buckets: in a group of edited copies
   that is the text they stem from, which is nearer to each copy than copies
   are to one another.
4. Texts of classes in such buckets are shuffled once and their sets stored.
5. Two rounds of stars around the two heaviest members of each bucket: members
   that no centre's component holds after the first round choose the centres of
   the second, which meet the whole rest of the bucket again.
6. Members of buckets that then still hold several components are compared
   exactly, by prefix filtering on their shingles, whatever the bucket's size.
7. Connected components of the confirmed links.

A pair at the threshold of 0.8 shares no bucket with a probability of
(1 - 0.8**4)**32 = 5e-8, and shares 13 of 32 on average. Of two members that
share a bucket one was a centre of it, or both are in one component after the
rounds, or step 6 compares them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retail_spark.llm.common import WordHashes, binary_column, connected, map_arrow, mix64, shingle_hashes, stash
from retail_spark.operators.graph import block_pairs

BANDS, ROWS = 32, 4
#: Stars of a bucket: centres in a round, and rounds.
CENTRES, ROUNDS = 2, 2
#: Members that one task compares with a centre; a centre with more is copied to several tasks.
STAR = 256


def _densify(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Fill empty bins of each row from the first non-empty bin of a universal hash sequence.

    ``values`` and ``filled`` are (documents, bins); rows have a filled bin at least.
    """
    bins = np.uint64(values.shape[1])
    doc, at = np.nonzero(~filled)
    source = np.array(values)
    attempt = 0
    while len(doc):
        attempt += 1
        probe = (mix64(at.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(attempt * 0x9E3779B1)) % bins).astype(np.int64)
        hit = filled[doc, probe]
        source[doc[hit], at[hit]] = values[doc[hit], probe[hit]]
        doc, at = doc[~hit], at[~hit]
    return source


def _shingle_set(text: bytes | None, hashes: WordHashes, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (A-Z lower-cased)."""
    return np.unique(shingle_hashes(hashes.of((text or b"").lower().split()), words))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, h1, h2, bands): set size, identity of the set, one hash a band.

    Null and empty texts have n = 0 and no bands.
    """
    bins = BANDS * ROWS

    def start():
        import xxhash

        hashes = WordHashes()
        edges = (np.arange(bins, dtype=np.uint64) << np.uint64(64 - bins.bit_length() + 1))

        def step(batch: pa.RecordBatch) -> dict:
            sets = [_shingle_set(t, hashes, words) for t in binary_column(batch, "text")]
            n = np.array([len(s) for s in sets], dtype=np.int64)
            some = [s for s in sets if len(s)]
            values, filled = np.zeros((len(some), bins), np.uint64), np.zeros((len(some), bins), bool)
            for row, s in enumerate(some):
                first = np.searchsorted(s, edges)
                filled[row] = np.diff(np.append(first, len(s))) > 0
                values[row] = s[np.minimum(first, len(s) - 1)]
            values = _densify(values, filled)
            rows = values.reshape(len(some), BANDS, ROWS)
            band = np.full((len(some), BANDS), 0, np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
            with np.errstate(over="ignore"):
                for r in range(ROWS):
                    band = mix64(band * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
            keys = iter(band.view(np.int64).tolist())
            ids = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"\0" * 16 for s in sets]
            ids = np.frombuffer(b"".join(ids), dtype=np.int64).reshape(-1, 2)
            return {"doc_id": batch.column(0), "n": pa.array(n), "h1": pa.array(ids[:, 0]), "h2": pa.array(ids[:, 1]),
                    "bands": pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64()))}

        return step

    return map_arrow(docs.select("doc_id", "text"), start,
                     "doc_id bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>")


def _members(classes: DataFrame) -> DataFrame:
    """(bucket, rep, n, weight) for buckets of two or more classes.

    ``weight`` is the number of members that the class meets over all its buckets.
    """
    rows = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    full = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met = stash(rows.join(full, "bucket"), "buckets")
    weight = met.groupBy("rep").agg(F.sum("size").alias("weight"))
    return met.select("bucket", "rep", "n").join(weight, "rep")


def _sets_of(docs: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles): the full sets, as packed 64-bit hashes, of the documents in ``reps``."""

    def start():
        hashes = WordHashes()

        def step(batch):
            texts = binary_column(batch, "text")
            return {"doc_id": batch.column(0),
                    "shingles": pa.array([_shingle_set(t, hashes, words).tobytes() for t in texts], pa.binary())}

        return step

    wanted = docs.select("doc_id", "text").join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    return map_arrow(wanted, start, "doc_id bigint, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs(u, v)`` whose sets have ``100 * common >= percent * union``.

    The centre ``u`` goes to as many tasks as its members need, each member to
    one of them; a task streams its rows, holding one centre's set at a time.
    """
    spread = pairs.groupBy("u").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")
    centres = spread.select(F.col("u").alias("doc_id"), "u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    members = pairs.join(spread, "u").select(F.col("v").alias("doc_id"), "u", part.alias("part"))
    wanted = centres.withColumn("v", F.lit(None).cast("bigint")).unionByName(members.withColumn("v", F.col("doc_id")))
    rows = (wanted.join(sets, "doc_id").select("u", "part", "v", "shingles")
            .repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first()))

    def check(batches):
        centre, held = None, None
        for batch in batches:
            us, parts, vs, sets_ = (c.to_pylist() for c in batch.columns)
            found = []
            for u, p, v, s in zip(us, parts, vs, sets_):
                s = np.frombuffer(s, np.uint64)
                if v is None:
                    centre, held = (u, p), s
                elif centre == (u, p):
                    common = len(held) + len(s) - len(np.union1d(held, s))
                    if 100 * common >= percent * (len(held) + len(s) - common) and len(s):
                        found.append((u, v))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], names=["u", "v"])

    return rows.mapInArrow(check, "u bigint, v bigint")


def _alike(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): every pair of ``left(rep, n, root)`` of different roots that can reach ``percent``, by prefix filtering.

    Shingles of one root only can't be in common and stand first in the order,
    then the rarer ones. A pair that reaches ``percent`` has its first common
    shingle among the first ``n - ceil(percent * n / 100) + 1`` of both sets,
    with enough left behind it in either.
    """
    def split(batches):
        for batch in batches:
            packed = [np.frombuffer(s, np.int64) for s in batch.column(3).to_pylist()]
            many = np.repeat(np.arange(len(packed)), [len(s) for s in packed])
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(many)) for k in range(3)),
                                              pa.array(np.concatenate([*packed, np.zeros(0, np.int64)]))],
                                             names=["rep", "n", "root", "shingle"])

    held = left.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select("rep", "n", "root", "shingles")
    each = stash(held.mapInArrow(split, "rep bigint, n bigint, root bigint, shingle bigint"), "shingles")
    common = (each.groupBy("shingle").agg(F.count("*").alias("f"), F.min("root").alias("a"), F.max("root").alias("b"))
              .filter("a <> b").select("shingle", "f"))
    shared = each.join(common, "shingle")
    order = Window.partitionBy("rep").orderBy("f", "shingle")
    some = shared.groupBy("rep").agg(F.count("*").alias("some")).withColumnRenamed("rep", "r")
    place = F.col("n") - F.col("some") + F.col("rank")
    first = (shared.withColumn("rank", F.row_number().over(order)).join(some, F.col("rep") == F.col("r"))
             .withColumn("place", place).filter(F.lit(100) * (F.col("n") - F.col("place") + 1) >= F.lit(percent) * F.col("n")))
    first = stash(first.select("shingle", "rep", "n", "root", "place"), "prefixes")
    met = block_pairs(first, "shingle", "rep", block=STAR, extra=("n", "root", "place"))
    behind = F.lit(1) + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = F.lit(100 + percent) * behind >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))
    return (met.filter((F.col("root_a") != F.col("root_b")) & enough)
            .select(F.col("rep_a").alias("u"), F.col("rep_b").alias("v")).distinct())


def _links(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame | None:
    """(u, v): confirmed links between classes, or None where no bucket has two classes.

    ``left`` holds the members of buckets that still have work: ``open`` ones
    may become a centre, the others are confirmed to one and are only compared
    with later centres. A centre has met its whole bucket and leaves it. What is
    left of buckets with several components after the rounds is compared by
    shingles.
    """
    left = stash(_members(classes).withColumns({"open": F.lit(True), "root": F.col("rep")}), "members")
    if not left.take(1):
        return None
    sets = stash(_sets_of(docs, left.select("rep").distinct(), words), "sets")
    links = None
    for _ in range(ROUNDS):
        order = Window.partitionBy("bucket").orderBy(F.desc("weight"), "rep")
        best = (left.filter("open").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= CENTRES)
                .select("bucket", F.col("rep").alias("u"), F.col("n").alias("m"), F.col("root").alias("u_root")))
        stars = left.join(best, "bucket").filter("rep <> u")
        near = stars.filter(F.lit(100) * F.least("n", "m") >= F.lit(percent) * F.greatest("n", "m")).filter("root <> u_root")
        found = stash(_confirm(near.select("u", F.col("rep").alias("v")).distinct(), sets, percent), "links")
        links = found if links is None else links.union(found)
        roots = connected(links)
        label = roots.select(F.col("node").alias("rep"), F.col("root").alias("now"))
        met = (stars.select("bucket", "rep", "u").join(label, "rep", "left")
               .join(label.select(F.col("rep").alias("u"), F.col("now").alias("u_now")), "u", "left")
               .groupBy("bucket", "rep").agg(F.max(F.coalesce("now", "rep") == F.coalesce("u_now", "u")).alias("held")))
        rest = (left.drop("root").join(best.select("bucket", F.col("u").alias("rep")), ["bucket", "rep"], "left_anti")
                .join(met, ["bucket", "rep"], "left").join(label, "rep", "left")
                .select("bucket", "rep", "n", "weight", (F.col("open") & ~F.coalesce("held", F.lit(False))).alias("open"),
                        F.coalesce("now", "rep").alias("root")))
        work = rest.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
        left = stash(rest.join(work, "bucket", "left_semi"), "members")
        if not left.take(1):
            return links
    pairs = _alike(left.select("rep", "n", "root").distinct(), sets, percent)
    return links.union(stash(_confirm(pairs, sets, percent), "links"))


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Words are
    runs of anything but ASCII white space, A-Z lower-cased. Two documents are
    linked when ``100 * common >= percent * union`` of their distinct shingles
    of ``words`` words (a shorter text is one shingle); ``component_id`` is the
    smallest doc_id reachable and ``kept`` marks that document.

    Null, empty and blank texts have no shingles and are their own component.
    Rows that share a doc_id are one document: their texts' links are shared.
    Rows with a null doc_id get a null component and are kept. An empty table
    gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketch = stash(sketches(docs, words), "sketches")
    named = sketch.filter("n > 0 and doc_id is not null")
    reps = named.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    classes = (named.join(reps.withColumnRenamed("rep", "doc_id"), ["h1", "h2", "doc_id"], "left_semi")
               .dropDuplicates(["doc_id", "h1", "h2"]).select(F.col("doc_id").alias("rep"), "n", "bands"))
    links = _links(docs, classes, words, percent)
    out = sketch.join(reps, ["h1", "h2"], "left")
    same_id = named.select("doc_id", "h1", "h2").distinct().groupBy("doc_id").agg(F.count("*").alias("sets")).filter("sets > 1")
    shared = (named.join(same_id, "doc_id", "left_semi").join(reps, ["h1", "h2"])
              .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    links = shared if links is None else links.union(shared)
    roots = connected(links)
    out = out.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("root", "rep", "doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group of near copies, with all columns.

    Rows that repeat both doc_id and text of another row are one document and stay once.
    """
    gone = near_duplicates(docs, words=words, percent=percent).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])
