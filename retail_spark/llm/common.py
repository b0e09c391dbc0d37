"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retail_spark.session import shared_path

#: Rows that a step of ``map_arrow`` handles at once.
SLICE = 1_000
#: Bytes of the batches that Python workers get, unless the session has a limit of its own; else 10,000 texts come at once.
BATCH_BYTES = "8m"
MAX_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Runs of ASCII white space end a word; ``bytes.split()`` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor and a restarted stage can
    read again, so a lost executor never recomputes what lies before.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null ids count as fold 0)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % F.lit(parts), F.lit(0)).cast("int")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """Word bytes -> 64-bit hash, kept for the words seen so far in a task."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.MOST:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in text order; the whole text if it is shorter."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k]
            out ^= out >> np.uint64(29)
    return mix64(out)


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task, and other stages' workers share the executor."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at ``BATCH_BYTES``: the executor and its worker each hold one whole."""
    if not spark.conf.get(MAX_BATCH_BYTES, None):
        spark.conf.set(MAX_BATCH_BYTES, BATCH_BYTES)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with a step ``batch -> dict of columns`` that ``fn()`` makes once a task.

    Steps get ``SLICE`` rows at a time, so a task holds the words of few texts.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    bound_batches(df.sparkSession)
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                columns = step(batch.slice(at, SLICE))
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type)
                     for f, c in ((f, columns[f.name]) for f in fields)], schema=fields)
        del step
        give_back()

    return df.mapInArrow(run, schema)


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges(u, v)``.

    Alternating large-star and small-star steps until the edges no longer
    change; each step is a grouped minimum and a join, written to the shared
    folder. Nodes without an edge to another node don't appear.
    """
    def both(e):
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def mark(e):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    cur = stash(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), name)
    seen = mark(cur)
    while seen[0]:
        near = both(cur)
        low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (near.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = large.filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(low, "u")
        small = (step.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).filter("u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        cur = stash(small, name)
        now = mark(cur)
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
