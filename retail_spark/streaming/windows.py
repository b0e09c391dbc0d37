"""Event-time windows (STR-08, STR-09, WIN-04).

``windowed_kpis`` works on a stream (append mode: a window is emitted once
the watermark passes its end) and on a batch. Distinct counts are refused
on streams, so sessions and orders are counted as rows of the
deduplicated ``session_started`` / ``order_placed`` events.

``sessionize`` assigns gap-based sessions. Batch: ``lag`` + running sum per
user (one sort per user partition, no self-join). Stream:
``session_window``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def windowed_kpis(
    events: DataFrame,
    *,
    ts_column: str = "event_ts",
    window: str = "1 hour",
    delay: str = "1 hour",
    type_column: str = "event_type",
    amount_column: str = "event_amount",
    dedup_key: str | None = None,
    ingest_column: str | None = None,
) -> DataFrame:
    """STR-08: sessions started, orders, GMV and events per tumbling window.

    ``dedup_key``: drop re-delivered events first. On a stream this chains
    ``dropDuplicatesWithinWatermark`` and the window aggregation on the same
    event-time watermark (distinct counts are refused on streams, so
    sessions / orders are counted as rows of deduplicated events).

    ``ingest_column``: windows and watermark go by the earlier of event and
    arrival time, so a future-dated event doesn't make later ones late.
    """
    df = events
    if ingest_column:
        # an event stamped ahead of its arrival counts when it arrived: it must not push the watermark past present events
        df = df.withColumn(ts_column, F.least(F.col(ts_column), F.col(ingest_column)))
    if events.isStreaming:
        df = df.withWatermark(ts_column, delay)
        if dedup_key:
            df = df.dropDuplicatesWithinWatermark([dedup_key])
    elif dedup_key:
        df = df.dropDuplicates([dedup_key])
    t = F.col(type_column)
    return df.groupBy(F.window(ts_column, window).alias("w")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(t == F.lit("session_started")).alias("sessions"),
        F.count_if(t == F.lit("order_placed")).alias("orders"),
        F.sum(F.when(t == F.lit("order_placed"), F.col(amount_column))).alias("gmv"),
    ).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "events",
        "sessions",
        "orders",
        "gmv",
    )


def sessionize(
    events: DataFrame,
    *,
    user_column: str = "customer_id",
    ts_column: str = "event_ts",
    gap_minutes: int = 30,
    session_column: str = "session_id",
    bucket_minutes: int = 360,
) -> DataFrame:
    """STR-09 (batch): a new session starts when the gap to the user's
    previous event exceeds ``gap_minutes``.

    Adds ``session_id`` = ``<user>-<epoch seconds of the session start>``,
    ``session_start``, ``step_in_session`` (1-based) and
    ``seconds_since_previous`` (NULL at a session start).

    Skew-safe scan in two passes over (user, time bucket) partitions:

    1. within each bucket, sort the events and find the session starts that
       do not depend on earlier buckets (gaps inside the bucket); reduce
       each bucket to one summary row (first/last time, count, last
       internal start and its position);
    2. prefix-scan the summary rows per user in bucket order (rows bounded
       by the user's time span, not by its event count) to get what each
       bucket inherits: previous event time, the open session's start and
       its position; join it back on (user, bucket) - the partitioning the
       in-bucket windows already use - and finish every event locally.

    A user holding a third of all events is spread over all its buckets.
    """
    gap_us = F.lit(gap_minutes * 60 * 1_000_000)
    tie = [c for c in ("event_id",) if c in events.columns]
    us = F.unix_micros(F.col(ts_column).cast("timestamp"))
    e = events.withColumns({"__us": us, "__b": F.floor(us / F.lit(bucket_minutes * 60 * 1_000_000))})
    wl = Window.partitionBy(user_column, "__b").orderBy("__us", *tie)
    upto = wl.rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumns({"__lprev": F.lag("__us").over(wl), "__lidx": F.row_number().over(wl)})
    internal = F.col("__lprev").isNotNull() & ((F.col("__us") - F.col("__lprev")) > gap_us)
    e = e.withColumn("__istart", internal)

    summary = e.groupBy(user_column, "__b").agg(
        F.min("__us").alias("__first"),
        F.max("__us").alias("__last"),
        F.count(F.lit(1)).alias("__cnt"),
        F.max(F.when(F.col("__istart"), F.col("__us"))).alias("__lis_us"),
        F.max(F.when(F.col("__istart"), F.col("__lidx"))).alias("__lis_pos"),
    )
    wb = Window.partitionBy(user_column).orderBy("__b")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumns(
        {
            "__prev_last": F.lag("__last").over(wb),
            "__p": F.coalesce(F.sum("__cnt").over(before), F.lit(0)),
        }
    )
    first_is_start = F.col("__prev_last").isNull() | ((F.col("__first") - F.col("__prev_last")) > gap_us)
    summary = summary.withColumns(
        {
            "__first_start": first_is_start,
            "__last_start_us": F.coalesce(F.col("__lis_us"), F.when(first_is_start, F.col("__first"))),
            "__last_start_abs": F.when(F.col("__lis_us").isNotNull(), F.col("__p") + F.col("__lis_pos") - 1).when(
                first_is_start, F.col("__p")
            ),
        }
    )
    carry = summary.select(
        F.col(user_column).alias("__cu"),
        F.col("__b").alias("__cb"),
        "__prev_last",
        "__first_start",
        "__p",
        F.max("__last_start_us").over(before).alias("__open_us"),
        F.max("__last_start_abs").over(before).alias("__open_abs"),
    )
    # NULL users and times are kept: they are a user and a bucket like any other
    e = e.join(carry, F.col(user_column).eqNullSafe(F.col("__cu")) & F.col("__b").eqNullSafe(F.col("__cb"))).drop("__cu", "__cb")
    is_start = F.when(F.col("__lprev").isNull(), F.col("__first_start")).otherwise(F.col("__istart"))
    e = e.withColumns(
        {
            "__start": is_start,
            "__prev": F.coalesce(F.col("__lprev"), F.col("__prev_last")),
            "__abs": F.col("__p") + F.col("__lidx") - 1,
        }
    )
    s_us = F.coalesce(F.max(F.when(F.col("__start"), F.col("__us"))).over(upto), F.col("__open_us"))
    s_abs = F.coalesce(F.max(F.when(F.col("__start"), F.col("__abs"))).over(upto), F.col("__open_abs"))
    e = e.withColumns({"__s": s_us, "__sabs": s_abs})
    out = e.withColumns(
        {
            "session_start": F.timestamp_micros("__s"),
            session_column: F.concat_ws(
                "-", F.col(user_column).cast("string"), F.floor(F.col("__s") / F.lit(1_000_000)).cast("string")
            ),
            "step_in_session": (F.col("__abs") - F.col("__sabs") + 1).cast("int"),
            "seconds_since_previous": F.when(
                ~F.col("__start"), F.col("__us") / F.lit(1_000_000.0) - F.col("__prev") / F.lit(1_000_000.0)
            ),
        }
    )
    return out.drop(
        "__us", "__b", "__lprev", "__lidx", "__istart", "__prev_last", "__first_start", "__p", "__open_us",
        "__open_abs", "__start", "__prev", "__abs", "__s", "__sabs",
    )


def session_windows(
    events: DataFrame,
    *,
    user_column: str = "customer_id",
    ts_column: str = "event_ts",
    gap: str = "30 minutes",
    delay: str = "1 hour",
) -> DataFrame:
    """STR-09 (stream or batch): one row per gap session with event counts."""
    df = events.withWatermark(ts_column, delay) if events.isStreaming else events
    return df.groupBy(user_column, F.session_window(ts_column, gap).alias("s")).agg(
        F.count(F.lit(1)).alias("events")
    ).select(user_column, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")


def session_gaps(
    events: DataFrame,
    *,
    session_column: str = "session_id",
    ts_column: str = "event_ts",
    bucket_minutes: int = 360,
) -> DataFrame:
    """WIN-04: ``step_index`` (1-based, by time then event id) and
    ``gap_seconds`` to the previous event of the same session (NULL for the
    first), for inputs that carry explicit session ids.

    Two-phase like :func:`sessionize`: events are sorted only within
    (session, time bucket); one summary row per bucket carries the previous
    bucket's last event time and the count of earlier events, so a session
    holding a third of all events is spread over its buckets.
    """
    tie = [c for c in ("event_id",) if c in events.columns]
    us = F.unix_micros(F.col(ts_column).cast("timestamp"))
    e = events.withColumns({"__us": us, "__b": F.floor(us / F.lit(bucket_minutes * 60 * 1_000_000))})
    wl = Window.partitionBy(session_column, "__b").orderBy("__us", *tie)
    e = e.withColumns({"__lprev": F.lag("__us").over(wl), "__lidx": F.row_number().over(wl)})
    summary = e.groupBy(session_column, "__b").agg(F.max("__us").alias("__last"), F.count(F.lit(1)).alias("__cnt"))
    wb = Window.partitionBy(session_column).orderBy("__b")
    carry = summary.select(
        F.col(session_column).alias("__cs"),
        F.col("__b").alias("__cb"),
        F.lag("__last").over(wb).alias("__prev_last"),
        F.coalesce(F.sum("__cnt").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__p"),
    )
    e = e.join(carry, F.col(session_column).eqNullSafe(F.col("__cs")) & F.col("__b").eqNullSafe(F.col("__cb"))).drop("__cs", "__cb")
    prev = F.coalesce(F.col("__lprev"), F.col("__prev_last"))
    return e.withColumns(
        {
            "step_index": (F.col("__p") + F.col("__lidx")).cast("int"),
            "gap_seconds": F.col("__us") / F.lit(1_000_000.0) - prev / F.lit(1_000_000.0),
        }
    ).drop("__us", "__b", "__lprev", "__lidx", "__prev_last", "__p")
