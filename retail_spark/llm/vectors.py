"""Vectors in blocks: what the vector searches share.

Rows go to blocks of a bounded number of rows by a hash; a block becomes one
index row. A stated set of queries is cut into blocks too, and every pair of a
query block and an index block is one group that a task handles on its own, so
memory is bounded by the two block sizes whatever the tables hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of an index block, and queries of a query block (expected; a hash deals them out).
ROWS, QUERIES = 16_384, 1_024


def usable(rows: DataFrame, *, zero: bool) -> DataFrame:
    """(vec_id, v, dim): the distinct rows whose vector is whole and finite, and not zero unless ``zero``.

    Null ids, null vectors and vectors with null or non-finite components take
    no part. Rows alike in id and vector count once.
    """
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    out = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null").filter(fine)
    if not zero:
        out = out.filter(F.exists("v", lambda x: x != 0))
    return out.withColumn("dim", F.size("v")).dropDuplicates(["vec_id", "v"])


def dealt(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` with a block number from 0 in ``name``, and how many blocks there are."""
    blocks = 1 + rows.count() // size
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "v", F.lit(name)), F.lit(blocks)).cast("int")), blocks


def every_pair(index: DataFrame, blocks: int, queries: DataFrame, query_blocks: int, fn, schema: str) -> DataFrame:
    """``fn(index rows, query rows) -> table`` for each pair of blocks of one dimension."""
    left = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "block", "query_block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(fn, schema)


def matrix(table: pa.Table, name: str, dim: int) -> np.ndarray:
    """An array<double> column as a (rows, dim) matrix."""
    values = table.column(name).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], pa.list_(pa.float64()))
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, dim)


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """The first ``k`` of each query's candidates with their rank; each task keeps k a query before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)
