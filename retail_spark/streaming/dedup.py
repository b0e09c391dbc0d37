"""Deduplication and watermarks (STR-01..04, STR-07, WIN-01, SET-02).

Batch dedup is deterministic and skew-safe: it is an aggregation
``min(struct(order..., payload...))`` per key, so Spark combines map-side
before the shuffle and a hot key (even a third of all rows, e.g. NULL ids)
reaches the reducer as one row per input partition instead of a sorted
window partition in one task.

Streaming dedup keeps the reference's event-time semantics as
``mode="forever"`` and offers ``mode="within_watermark"`` on ingest time,
which evicts state and is immune to future-dated events poisoning the
event-time watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_spark.session import ensure_shared_dir, freed_shuffles

DEFAULT_DELAY = "7 days"


def earliest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    *,
    nulls_last: bool = True,
    only_duplicated_keys: bool = False,
) -> DataFrame:
    """WIN-01: keep one row per key, the first by ``order_by`` then all columns.

    Ties are broken by the remaining columns in schema order, so the result
    does not depend on partitioning or file order. Equivalent to
    ``row_number() over (partition by keys order by ...) = 1`` but computed
    as a partial/final aggregation.
    """
    keys = list(keys)
    if only_duplicated_keys:
        return _earliest_for_duplicated_keys(df, keys, order_by, nulls_last)
    payload = [c for c in df.columns if c not in keys]
    order_exprs: list[Column] = []
    for i, o in enumerate(order_by):
        oc = F.col(o) if isinstance(o, str) else o
        if nulls_last:
            order_exprs.append(oc.isNull().alias(f"__o{i}_null"))
        order_exprs.append(oc.alias(f"__o{i}"))
    packed = F.struct(*order_exprs, *[F.col(c).alias(c) for c in payload])
    picked = df.groupBy(*keys).agg(F.min(packed).alias("__pick"))
    return picked.select(*keys, *[F.col("__pick").getField(c).alias(c) for c in payload]).select(*df.columns)


#: Most hashes of duplicated keys that are sent to all executors (16 bytes each).
DUPLICATED = 1_000_000


def _earliest_for_duplicated_keys(
    df: DataFrame, keys: list[str], order_by: Sequence[str | Column], nulls_last: bool
) -> DataFrame:
    """Same result, but whole rows are shuffled only for keys that may occur
    more than once. A count of the keys' hashes finds these; the few hashes
    seen again go to all executors, rows with others pass through, the rest
    (with keys that only share a hash) go through the min(struct) aggregation.
    With many duplicated keys all rows go through it, shuffled once. ``df``
    is read twice. NULL keys compare equal (they collapse, as in the
    streaming dedup)."""
    ensure_shared_dir(df.sparkSession)
    name = "__hash"
    with freed_shuffles(df.sparkSession):
        seen = df.groupBy(F.xxhash64(*keys).alias(name)).agg(F.count(F.lit(1)).alias("__c"))
        again = seen.where(F.col("__c") > 1).select(name).checkpoint(eager=True)
    n = again.count()
    if not n:
        return df
    if n > DUPLICATED:
        return earliest_per_key(df, keys, order_by, nulls_last=nulls_last)
    again = F.broadcast(again)
    hashed = df.withColumn(name, F.xxhash64(*keys))
    unique_rows = hashed.join(again, name, "left_anti").drop(name)
    dup_rows = hashed.join(again, name, "left_semi").drop(name)
    return unique_rows.unionByName(earliest_per_key(dup_rows, keys, order_by, nulls_last=nulls_last))


def drop_duplicates_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SET-02: distinct on key (any survivor); map-side combined by Spark."""
    return df.dropDuplicates(list(keys))


def with_ingest_time(df: DataFrame, column: str = "ingest_ts") -> DataFrame:
    """STR-07: ingest timestamp, from the file scan when the reader captured it."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.current_timestamp())


def deduplicate_stream(
    df: DataFrame,
    *,
    timestamp_column: str,
    key: str = "event_id",
    mode: str = "within_watermark",
    delay: str = DEFAULT_DELAY,
    ingest_column: str = "ingest_ts",
) -> DataFrame:
    """STR-01/02 (+07): watermark and key dedup for a streaming DataFrame.

    ``forever``: event-time watermark + ``dropDuplicates(key)``; the state is
    keyed without the watermark column, so it never evicts, and a future
    dated event drops present-time rows (reference behaviour).
    ``within_watermark``: ingest-time watermark +
    ``dropDuplicatesWithinWatermark(key)``; state is evicted after ``delay``.
    """
    if mode == "forever":
        return df.withWatermark(timestamp_column, delay).dropDuplicates([key])
    if mode == "within_watermark":
        df = with_ingest_time(df, ingest_column)
        return df.withWatermark(ingest_column, delay).dropDuplicatesWithinWatermark([key])
    if mode == "none":
        return df
    raise ValueError(f"unknown dedup mode {mode!r}")


def deduplicate(
    df: DataFrame,
    *,
    timestamp_column: str,
    key: str = "event_id",
    mode: str = "within_watermark",
    delay: str = DEFAULT_DELAY,
    only_duplicated_keys: bool = False,
) -> DataFrame:
    """Dedup for either execution mode.

    Streaming: :func:`deduplicate_stream`. Batch: earliest row per key by
    (timestamp, source file, remaining columns) - the deterministic version
    of what a single streaming run keeps. ``only_duplicated_keys`` is for a
    batch that is cheap to read twice (:func:`earliest_per_key`).
    """
    if mode == "none":
        return df
    if df.isStreaming:
        return deduplicate_stream(df, timestamp_column=timestamp_column, key=key, mode=mode, delay=delay)
    order = [timestamp_column] + (["source_file"] if "source_file" in df.columns else [])
    return earliest_per_key(df, [key], order, only_duplicated_keys=only_duplicated_keys)


def duplicate_report(df: DataFrame, key: str | Sequence[str] = "event_id") -> DataFrame:
    """DQ-07: keys seen more than once, with their copy count (a combinable
    count per key, so hot keys are pre-aggregated map-side)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
