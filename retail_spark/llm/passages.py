"""Repeated passages by collinear chaining of shared seeds.

1. Texts that are equal as word sequences are one class; its smallest doc_id
   stands for it, the others are copies of it.
2. Seeds: of each window of ``WINDOW`` successive runs of ``K`` words the one
   with the smallest hash; equal ones give one seed a window. Any ``K + WINDOW - 1`` words that two texts share
   have a seed in common.
3. A seed that several documents hold links each of them to the smallest
   doc_id among them only: a star, so a passage in a thousand documents makes a
   thousand links, not a million.
4. The links of a document and its source are chained: the best sequence that
   rises in both texts, a seed counting its words and a gap costing by its
   length in both, found with a Fenwick tree of prefix maxima in
   O(n log n).
5. The words of chained stretches are fetched (one shuffle of the texts) and
   aligned by edit distance; ends are extended while words agree. Stretches of
   ``MIN_WORDS`` words and more with few enough edits are passages; others are
   split at their largest gap and each part is aligned by itself.
6. Seeds in no passage yet may have scattered over several smallest holders.
   Runs of 2 to 16 successive shared seeds link such places to the smallest
   document that holds the whole run, again a star, and steps 4 and 5 follow.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retail_spark.llm.common import WordHashes, binary_column, map_arrow, mix64, shingle_hashes, stash

K, WINDOW = 5, 14
#: Fewest words of a passage, and most edits a word of it.
MIN_WORDS, MOST_EDITS = 50, 0.2
#: What a word of a gap costs, beside a seed's ``K``.
GAP_COST = 0.1
#: A gap of more words in both texts, of which over half differ, parts two passages.
MOST_GAP = 25
#: Words fetched beyond either end of a chain; two seeds are at most a window apart.
FLANK = K + WINDOW
#: Seeds of the runs by which places that no passage covers find another source.
RUNS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16)
#: Words of a text that one key holds where places meet passages.
STRIP = 256
#: Diagonals that an alignment may reach beyond the first and the last.
BAND = 64
#: Stretches that one row asks of a text; a text with more is asked in several rows.
ASKED = 1_000


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes made different by how often they stand earlier in the text, and which of them do.

    So the third time that a text says something is held against the third
    time in the other, which keeps texts that repeat themselves in order.
    """
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    time = np.arange(len(hashes)) - np.repeat(first, np.diff(np.append(first, len(hashes))))
    out = hashes.copy()
    again = time > 0
    out[order[again]] = mix64(sorted_[again] + time[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out, np.sort(order[again])


def _picked(runs: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of every window of ``WINDOW`` runs.

    Of equal ones the last is picked, and one that was picked stays while it is
    in the window: a word said a hundred times is no hundred seeds, but one a
    window, while each window still has one of its own.
    """
    wide = np.lib.stride_tricks.sliding_window_view(runs, min(WINDOW, len(runs)))
    first, last = wide.argmin(axis=1), wide.shape[1] - 1 - wide[:, ::-1].argmin(axis=1)
    at = np.arange(len(wide))
    if (first != last).any():
        least, picked = runs[at + last].tolist(), -1
        kept, values = (at + last).tolist(), runs.tolist()
        for k in range(len(kept)):
            if picked >= k and values[picked] == least[k]:
                kept[k] = picked
            picked = kept[k]
        return np.unique(np.array(kept)).astype(np.int32)
    return np.unique(at + first).astype(np.int32)


def _name(words: np.ndarray) -> tuple[int, int]:
    """What names a text: two hashes of its words."""
    import xxhash

    h1, h2 = np.frombuffer(xxhash.xxh3_128_digest(words.tobytes()), np.int64)
    return int(h1), int(h2)


def seeds(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, n, hashes, places): a text's identity as words, its size and its seeds."""

    def start():
        known = WordHashes()

        def step(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("h1", "h2", "n", "hashes", "places")}
            for text in binary_column(batch, "text"):
                words = known.of((text or b"").lower().split())
                whole = _name(words)
                hashes, places = np.zeros(0, np.int64), np.zeros(0, np.int32)
                if len(words) >= K:
                    runs = shingle_hashes(words, K)
                    places = _picked(runs)
                    # a later time is held against the source's first time, too
                    numbered, again = _numbered(runs[places])
                    hashes = np.concatenate([numbered, runs[places[again]]]).view(np.int64)
                    places = np.concatenate([places, places[again]])
                for k, v in zip(out, (*whole, len(words), hashes, places)):
                    out[k].append(v)
            return out | {"doc_id": batch.column(0)}

        return step

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    return map_arrow(rows, start, "doc_id bigint, h1 bigint, h2 bigint, n bigint, hashes array<bigint>, places array<int>")


class Fenwick:
    """Prefix maxima: the best (value, item) among the places below a given one."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, place: int, value: float, item: int) -> None:
        entry, k = (value, item), place + 1
        while k < len(self.best):
            if self.best[k] < entry:
                self.best[k] = entry
            k += k & -k

    def below(self, place: int) -> tuple[float, int]:
        found, k = (float("-inf"), -1), place
        while k > 0:
            found = max(found, self.best[k])
            k -= k & -k
        return found


def chains(a: list[int], b: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Chains of links (a[i], b[i]): (first a, last a, first b, last b, links), best first, sharing no link."""
    return [(a[c[0]], a[c[-1]], b[c[0]], b[c[-1]], len(c)) for c in _chains(a, b)]


def _chains(a: list[int], b: list[int]) -> list[list[int]]:
    """The links of each chain, best chain first.

    A chain's score is K a link less ``GAP_COST`` for each word it moves on in
    either text. Without the part that depends on its end alone, a chain's
    score grows with the places, so a prefix maximum over ``b`` gives the best
    predecessor of each link.
    """
    order = sorted(range(len(a)), key=lambda i: (a[i], -b[i]))
    ranks = sorted(set(b))
    tree, score, before = Fenwick(len(ranks)), [0.0] * len(a), [-1] * len(a)
    for i in order:
        place, here = bisect_left(ranks, b[i]), GAP_COST * (a[i] + b[i])
        value, j = tree.below(place)
        score[i] = K
        if j >= 0 and value - here > 0 and a[j] < a[i]:
            score[i], before[i] = K + value - here, j
        tree.put(place, score[i] + here, i)
    used, out = [False] * len(a), []
    for i in sorted(range(len(a)), key=lambda i: (-score[i], a[i], b[i])):
        if used[i]:
            continue
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        out.append(chain[::-1])
    return out


#: What names the two texts of a link.
KEY = ("doc_id", "text", "source_id", "source_text")


def _chained(links: DataFrame) -> DataFrame:
    """(chain, doc_id, text, source_id, source_text, start, stop, source_start, source_stop, places, source_places) from links.

    A text is named by its doc_id and a hash, for rows may share a doc_id.
    """

    def run(batches):
        key, a, b = None, [], []

        def done():
            for c in _chains(a, b):
                x, y = [a[i] for i in c], [b[i] for i in c]
                # a passage holds seeds up to a window from its ends
                if min(x[-1] - x[0], y[-1] - y[0]) + K + 2 * (FLANK - 1) >= MIN_WORDS:
                    yield (*key, x[0], x[-1] + K, y[0], y[-1] + K, x, y)

        def batch_of(rows):
            kinds = [pa.int64()] * 8 + [pa.list_(pa.int64())] * 2
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                              names=[*KEY, "start", "stop", "source_start", "source_stop", "places", "source_places"])

        for batch in batches:
            rows = []
            for *own, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                if key != own:
                    if key:
                        rows += done()
                    key, a, b = own, [], []
                a.append(x)
                b.append(y)
            yield batch_of(rows)
        if key:
            yield batch_of(list(done()))

    sorted_ = (links.select(*KEY, "place", "source_place").distinct()
               .repartition("doc_id", "source_id").sortWithinPartitions(*KEY, "place", "source_place"))
    found = sorted_.mapInArrow(run, ", ".join(f"{n} bigint" for n in (*KEY, "start", "stop", "source_start", "source_stop"))
                               + ", places array<bigint>, source_places array<bigint>")
    return found.withColumn("chain", F.xxhash64(*found.columns[:8]))


def edits(a: list[int], b: list[int], most: int, band: int = BAND) -> int | None:
    """Edit distance of two word sequences, None above ``most`` or outside the band.

    Furthest-reaching points per diagonal (Myers): the work follows the number
    of edits, and equal stretches cost one comparison a word.
    """
    n, m = len(a), len(b)
    goal = m - n
    if abs(goal) > most:
        return None
    low, high = min(0, goal) - band, max(0, goal) + band
    reach = {}
    for e in range(most + 1):
        new = {}
        for d in range(max(-e, low), min(e, high) + 1):
            if e == 0:
                x = 0
            else:
                x = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -2))
                if x < 0:
                    continue
            x = min(x, n, m - d)
            if x < 0 or x + d < 0:
                continue
            while x < n and x + d < m and a[x] == b[x + d]:
                x += 1
            new[d] = x
        if new.get(goal, -1) >= n:
            return e
        reach = new
    return None


def parts(x: list[int], y: list[int], p: list[int], q: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, stop, start in y, stop in y, edits) of a chain of seeds x[p[i]:], y[q[i]:].

    A stretch with too many edits is split at its largest gap, and so are its
    parts until they pass or are too short. One that passes is split at a gap
    that parts two passages, if there is a passage on both sides.
    """
    out, todo = [], [(0, len(p))]
    while todo:
        lo, hi = todo.pop()
        i, j, k, l = p[lo], p[hi - 1] + K, q[lo], q[hi - 1] + K
        while i > 0 and k > 0 and x[i - 1] == y[k - 1]:
            i, k = i - 1, k - 1
        while j < len(x) and l < len(y) and x[j] == y[l]:
            j, l = j + 1, l + 1
        if min(j - i, l - k) < MIN_WORDS:
            continue
        e = 0 if x[i:j] == y[k:l] else edits(x[i:j], y[k:l], int(MOST_EDITS * (j - i)))
        if e == 0 or hi - lo < 2:
            out += [] if e is None else [(i, j, k, l, e)]
            continue
        cut = max(range(lo + 1, hi), key=lambda c: max(p[c] - p[c - 1], q[c] - q[c - 1]))
        if e is None:
            todo += [(lo, cut), (cut, hi)]
            continue
        sides = []
        a, b = x[p[cut - 1] + K : p[cut]], y[q[cut - 1] + K : q[cut]]
        if min(len(a), len(b)) > MOST_GAP and edits(a, b, max(len(a), len(b)) // 2) is None:
            sides = [parts(x, y, p[s:t], q[s:t]) for s, t in ((lo, cut), (cut, hi))]
        out += [*sides[0], *sides[1]] if sides and all(sides) else [(i, j, k, l, e)]
    return out


def _words_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(chain, side, from, words): word hashes of each chain's stretch, with its flanks, in both texts."""
    span = F.struct("chain", "side", "own", F.greatest(F.lit(0), F.col("a") - FLANK).alias("a"), (F.col("b") + FLANK).alias("b"))
    sides = (found.select(F.col("doc_id").alias("id"), F.col("text").alias("own"), "chain", F.lit(0).alias("side"), F.col("start").alias("a"), F.col("stop").alias("b"))
             .union(found.select(F.col("source_id").alias("id"), F.col("source_text").alias("own"), "chain", F.lit(1).alias("side"),
                                 F.col("source_start").alias("a"), F.col("source_stop").alias("b"))))
    # a source can have a chain with a third of all documents
    parts = sides.groupBy("id").agg(F.ceil(F.count("*") / F.lit(ASKED)).alias("parts"))
    asked = (sides.join(parts, "id").withColumn("part", F.pmod("chain", "parts")).repartition("id", "part")
             .groupBy("id", "part").agg(F.collect_list(span).alias("spans")).drop("part"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").filter("text is not null").join(asked, "id")

    def start():
        known = WordHashes()

        def step(batch):
            out = {k: [] for k in ("chain", "side", "from", "words")}
            for text, spans in zip(binary_column(batch, "text"), batch.column(batch.schema.get_field_index("spans")).to_pylist()):
                words = known.of(text.lower().split())
                own, words = _name(words)[0], words.astype(np.uint32)
                for s in spans:
                    if s["own"] != own:  # asked of another text under this doc_id
                        continue
                    for k, v in zip(out, (s["chain"], s["side"], s["a"], words[s["a"] : s["b"]].tobytes())):
                        out[k].append(v)
            return out

        return step

    return map_arrow(rows.select("id", "text", "spans"), start, "chain bigint, side int, from bigint, words binary")


def _aligned(found: DataFrame, words: DataFrame) -> DataFrame:
    """Chains that align, with their ends extended: doc_id, start, stop, source_id, source_start, source_stop, n_words, edits."""
    own = words.filter("side = 0").select("chain", F.col("from").alias("a"), F.col("words").alias("x"))
    other = words.filter("side = 1").select(F.col("chain").alias("c"), F.col("from").alias("b"), F.col("words").alias("y"))
    both = found.join(own, "chain").join(other, F.col("chain") == F.col("c")).dropDuplicates(["chain"])
    names = ("doc_id", "text", "start", "stop", "source_id", "source_start", "source_stop")

    def run(batches):
        for batch in batches:
            out = []
            for d, t, o, p, q, a, x, b, y in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = np.frombuffer(x, np.uint32).tolist(), np.frombuffer(y, np.uint32).tolist()
                for i, j, k, l, e in parts(x, y, [z - a for z in p], [z - b for z in q]):
                    out.append((d, t, i + a, j + a, o, k + b, l + b, j - i, e))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(9)], names=[*names, "n_words", "edits"])

    return both.select("doc_id", "text", "source_id", "places", "source_places", "a", "x", "b", "y").mapInArrow(run, ", ".join(f"{n} bigint" for n in (*names, "n_words", "edits")))


def _run_links(held: DataFrame, aligned: DataFrame) -> DataFrame | None:
    """Links of the places of ``held`` in no passage of ``aligned``, by runs of shared seeds; None if there are none."""
    strip = F.sequence(F.floor(F.col("start") / STRIP), F.floor((F.col("stop") - 1) / STRIP))
    covered = aligned.select(F.col("doc_id").alias("d"), F.col("text").alias("t"), "start", "stop", F.explode(strip).alias("strip"))
    inside = (F.col("doc_id") == F.col("d")) & (F.col("text") == F.col("t")) & (F.floor(F.col("place") / STRIP) == F.col("strip")) & \
        (F.col("place") >= F.col("start")) & (F.col("place") + K <= F.col("stop"))
    open_ = held.filter("doc_id <> source_id").join(covered, inside, "left_anti").select("doc_id", "text", "place", "seed")
    # stretches of open places too short for a passage, as a repeated phrase has, stay out
    along = Window.partitionBy("doc_id", "text").orderBy("place", "seed")
    apart = F.coalesce((F.col("place") - F.lag("place").over(along) > MOST_GAP).cast("int"), F.lit(0))
    open_ = stash(open_.withColumn("apart", apart).withColumn("stretch", F.sum("apart").over(along)).drop("apart"), "open")
    long = (open_.groupBy("doc_id", "text", "stretch").agg((F.max("place") - F.min("place")).alias("span"))
            .filter(F.col("span") + K + 2 * (FLANK - 1) >= MIN_WORDS))
    open_ = stash(open_.join(long, ["doc_id", "text", "stretch"], "left_semi").drop("stretch"), "open")
    if not open_.take(1):
        return None
    rows = (held.join(open_.select("seed").distinct(), "seed", "left_semi").select("doc_id", "text", "place", "seed")
            .join(open_.withColumn("open", F.lit(True)), ["doc_id", "text", "place", "seed"], "left"))
    # an open run that another document holds is made of pairs that are open somewhere and that two documents hold
    both = F.coalesce(F.col("open") & F.lead("open").over(along), F.lit(False))
    rows = stash(rows.withColumn("pair", F.xxhash64("seed", F.lead("seed").over(along))).withColumn("both", both), "runs")
    pairs = (rows.groupBy("pair").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.bool_or("both").alias("asked"))
             .filter("low < high and asked").select("pair"))
    pairs = stash(pairs, "pairs")
    rows = rows.join(pairs.withColumn("held", F.lit(True)), "pair", "left")
    ahead = along.rowsBetween(0, RUNS[-1] - 1)
    entry = F.struct("seed", "place", F.coalesce("open", F.lit(False)).alias("open"), F.coalesce("held", F.lit(False)).alias("held"))
    rows = rows.withColumn("ahead", F.collect_list(entry).over(ahead)).filter("held")
    last = F.array_position(F.col("ahead.held"), False).cast("int")
    most = F.when(last > 0, last).otherwise(F.size("ahead"))
    long = F.filter(F.array(*map(F.lit, RUNS)), lambda m: m <= most)
    runs = rows.select("doc_id", "text", "place", "ahead", F.explode(long).alias("m")).withColumn("run", F.expr("slice(ahead, 1, m)"))
    runs = stash(runs.select("doc_id", "text", "place", F.xxhash64("m", F.col("run.seed")).alias("key"), F.col("run.place").alias("places"),
                             F.forall("run.open", lambda o: o).alias("open")), "runs")
    first = (runs.groupBy("key").agg(F.min(F.struct("doc_id", "text", "place", "places")).alias("s"), F.max("doc_id").alias("last")).filter("s.doc_id < last")
             .select("key", F.col("s.doc_id").alias("source_id"), F.col("s.text").alias("source_text"), F.col("s.places").alias("source_places")))
    first = stash(first, "first")
    pairs = F.explode(F.arrays_zip("places", "source_places")).alias("p")
    return (runs.filter("open").join(first, "key").filter("doc_id <> source_id").select(*KEY, pairs)
            .select(*KEY, F.col("p.places").alias("place"), F.col("p.source_places").alias("source_place")))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per passage: doc_id, start, stop, source_id, source_start, source_stop, n_words, edits.

    Words ``start`` to ``stop`` of document ``doc_id`` repeat words
    ``source_start`` to ``source_stop`` of ``source_id``, which has a smaller
    doc_id, but for ``edits`` words put in, left out or changed. Words are runs
    of anything but ASCII white space, A-Z lower-cased. A text that equals an
    earlier one as a whole is one passage of it; its own passages stand at the
    earlier text only.

    ``docs`` needs doc_id and text. Null and empty texts, texts of fewer than
    ``MIN_WORDS`` words and rows with a null doc_id have no passage. Rows that
    share a doc_id are texts of their own and never a repeat of each other;
    their places count within their own text. Other columns are ignored;
    an empty table gives an empty result.
    """
    found = stash(seeds(docs), "seeds")
    classes = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("source_id"))
    copies = (found.select("doc_id", "h1", "h2", "n").distinct().join(classes, ["h1", "h2"])
              .filter(f"doc_id <> source_id and n >= {MIN_WORDS}"))
    alone = found.join(classes.withColumnRenamed("source_id", "doc_id"), ["h1", "h2", "doc_id"], "left_semi")
    each = alone.select("doc_id", F.col("h1").alias("text"), F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "doc_id", "text", F.col("s.hashes").alias("seed"), F.col("s.places").cast("bigint").alias("place"))
    shared = (each.groupBy("seed").agg(F.min(F.struct("doc_id", "text", "place")).alias("first"), F.max("doc_id").alias("last")).filter("first.doc_id < last")
              .select("seed", F.col("first.doc_id").alias("source_id"), F.col("first.text").alias("source_text"), F.col("first.place").alias("source_place")))
    # written apart, so that Spark can split the rows of a frequent seed in the join
    held = stash(each.join(stash(shared, "sources"), "seed"), "shared")
    links = held.filter("doc_id <> source_id")
    chained = stash(_chained(links), "chains")
    aligned = stash(_aligned(chained, _words_of(docs, chained)), "passages")
    more = _run_links(held, aligned)
    if more is not None:
        chained = stash(_chained(more), "chains")
        aligned = aligned.unionByName(_aligned(chained, _words_of(docs, chained)))
    whole = copies.select("doc_id", F.lit(0).cast("bigint").alias("start"), F.col("n").alias("stop"), "source_id",
                          F.lit(0).cast("bigint").alias("source_start"), F.col("n").alias("source_stop"), F.col("n").alias("n_words"),
                          F.lit(0).cast("bigint").alias("edits"))
    return aligned.drop("text").unionByName(whole).distinct()
