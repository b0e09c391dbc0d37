"""Importance resampling towards a target distribution, with segment deduplication.

Features are runs of one and two consecutive words, hashed into buckets. A
bucket weighs more the more often the target texts use it compared with all
documents; a document's weight is the mean over its features, and a keyed
Gumbel number added to it makes the highest scores a weighted draw without
replacement.

How the documents' bucket counts are made: separator newlines cut texts into
lines, equal lines are counted first (partial sums, then a shuffle by line), the
features of each distinct line are computed once and multiplied by its number
of occurrences. Pairs of words that reach over a line end are counted apart,
by a pass that keeps the first and last word of each line only. A feature's
crc32 needs no joined string: the crc of ``a b`` follows from those of ``a``
and ``b`` by shifting the first over the length of the second.

Results for odd inputs: null and empty texts have no feature, weight 0 and
still a score; a null doc_id is drawn with the key of the empty id and orders
before all ids; repeated rows each count and each take their place in the
ranking (ties of score and doc_id by weight, then number of features); an empty
table gives an empty result; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retail_spark.llm.common import SLICE, binary_column, map_arrow, stash

#: Buckets that features are hashed into.
BUCKETS = 10_000
#: Seed of the draw, fewest words of a document that may be drawn, and per cent of those that are.
SEED, LEAST_WORDS, PERCENT = 7, 20, 25

#: A-Z to a-z; what ends a word (all ASCII characters but digits and letters) to a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: The same, but line ends stay.
_KEEP_LINES = _FOLD[:10] + b"\n" + _FOLD[11:]


def words(text: bytes | None) -> list[bytes]:
    """The lower-cased words of a text, as UTF-8."""
    return text.translate(_FOLD).split() if text else []


class Crc:
    """crc32 of two words with a blank between them, from the words' own crc32.

    Appending n bytes multiplies a crc by x^8n modulo the polynomial, which is
    linear: four tables of 256 entries a length, filled when a length turns up.
    """

    POLYNOMIAL = 0xEDB88320

    def __init__(self) -> None:
        bits = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            bits = np.where(bits & 1, (bits >> 1) ^ np.uint32(self.POLYNOMIAL), bits >> 1)
        self.byte = bits
        self.kept: dict[int, np.ndarray] = {}

    def _table(self, n: int) -> np.ndarray:
        found = self.kept.get(n)
        if found is None:
            found = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
            for _ in range(n):
                found = (found >> np.uint32(8)) ^ self.byte[found & np.uint32(255)]
            if len(self.kept) < 4096:
                self.kept[n] = found
        return found

    def shifted(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``crc`` after as many zero bytes as ``lengths`` says, without the crc of those bytes."""
        out = np.empty_like(crc)
        for n in np.unique(lengths):
            at = lengths == n
            t, c = self._table(int(n)), crc[at]
            out[at] = t[0, c & 255] ^ t[1, (c >> np.uint32(8)) & 255] ^ t[2, (c >> np.uint32(16)) & 255] ^ t[3, c >> np.uint32(24)]
        return out

    def pairs(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """crc32 of each word, a blank and the next word."""
        blank = zlib.crc32(b" ")
        one = np.ones(max(len(crc) - 1, 0), np.int64)
        first = self.shifted(crc[:-1], one) ^ np.uint32(blank)
        return self.shifted(first, lengths[1:]) ^ crc[1:]


def _hashed(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (np.fromiter(map(zlib.crc32, found), np.uint32, len(found)), np.fromiter(map(len, found), np.int64, len(found)))


def _features(texts: list[bytes | None], crc: Crc, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of its text) of every feature of the texts."""
    split = [words(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    own, lengths = _hashed([w for s in split for w in s])
    of = np.repeat(np.arange(len(split)), sizes)
    within = of[1:] == of[:-1]
    pairs = crc.pairs(own, lengths)[within]
    return np.concatenate([own, pairs]).astype(np.int64) % buckets, np.concatenate([of, of[1:][within]])


def _counted(rows: DataFrame, buckets: int, found) -> DataFrame:
    """(bucket, n): sums of the bucket arrays that ``found(batch, crc)`` gives, one row a bucket and task."""

    def run(batches):
        crc, total = Crc(), np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                bucket, times = found(batch.slice(at, SLICE), crc)
                np.add.at(total, bucket, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return rows.mapInArrow(run, "bucket bigint, n bigint")


def _of_lines(lines: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) from distinct lines (text, times): each line's features count ``times``."""

    def found(batch, crc):
        bucket, of = _features(binary_column(batch, "text"), crc, buckets)
        return bucket, batch.column(1).to_numpy()[of]

    return _counted(lines, buckets, found)


def _over_line_ends(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): the pairs of a line's last word and the first word of the next line that has words."""

    def found(batch, crc):
        ends = []
        for text in binary_column(batch, "text"):
            last = None
            for line in text.translate(_KEEP_LINES).split(b"\n"):
                own = line.split()
                if own:
                    if last is not None:
                        ends += [last, own[0]]
                    last = own[-1]
        own, lengths = _hashed(ends)
        return crc.pairs(own, lengths)[::2].astype(np.int64) % buckets, 1

    return _counted(texts, buckets, found)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often each bucket's features stand in all of ``texts(text)``."""
    texts = texts.select("text").filter("text is not null")
    lines = (texts.select(F.explode(F.split("text", "\n")).alias("text")).filter("text <> ''")
             .groupBy("text").agg(F.count("*").alias("times")))
    parts = _of_lines(lines, buckets).union(_over_line_ends(texts.filter(F.instr("text", "\n") > 0), buckets))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths: the log ratio of its share in ``target`` and in ``docs``, one added to each count."""

    def counted(texts):  # at most ``buckets`` rows
        out = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, buckets).collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = counted(docs), counted(target)
    ratio = ((t + 1).astype(np.float64) * float(s.sum() + buckets)) / ((s + 1).astype(np.float64) * float(t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``; whole texts, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def start():
        crc, gain = Crc(), held.value

        def step(batch):
            n = batch.num_rows
            bucket, of = _features(binary_column(batch, "text"), crc, len(gain))
            count, total = np.bincount(of, minlength=n), np.zeros(n, np.int64)
            np.add.at(total, of, gain[bucket])
            return {"doc_id": batch.column(0), "n_words": (count + 1) // 2, "n_features": count,
                    "weight": np.floor_divide(total, np.maximum(count, 1))}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), start,
                     "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def with_ranks(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... by ``order``: sorted ranges are numbered on their own and moved by the rows before them."""
    ranged = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    kept = stash(ranged, "ranges")
    # one row a range, as many as shuffle partitions
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = kept.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return kept.withColumn("own", own).join(sizes, "range").withColumn("rank", (F.col("own") + F.col("before")).cast("bigint")).drop("range", "own", "before")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
             buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs``.

    Of the documents with ``least_words`` words and more, ``percent`` per cent
    with the highest scores get a rank; the others' is null. Only what may
    reach the draw is sorted: the number of documents at each score tells the
    lowest score that can (scores are whole thousandths, so there are some ten
    thousands of them whatever the input's size).
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stash(weigh(docs, gains(docs, target, buckets)).withColumn("score", F.col("weight") + gumbel), "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    histogram = able.groupBy("score").agg(F.count("*").alias("n"))
    draw = able.count() * percent // 100
    above = F.sum("n").over(Window.orderBy(F.desc("score")))
    # one row a score; the first one at which the draw is full
    lowest = histogram.withColumn("upto", above).filter(F.col("upto") >= draw).agg(F.max("score")).first()[0] if draw else None
    reach = (F.col("n_words") >= least_words) & (F.col("score") >= F.lit(lowest)) if draw else F.lit(False)
    ranked = with_ranks(scored.filter(reach), [F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.desc("n_features")])
    columns = ["doc_id", "n_features", "weight", "score"]
    return (ranked.select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
            .union(scored.filter(~reach).select(*columns, F.lit(None).cast("bigint"))))
