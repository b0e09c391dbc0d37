"""Joins (JON-01, 02, 07, 08).

No side is broadcast by a hint here: Catalyst broadcasts a side whose size it
knows, and AQE one that it has measured, by bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Column,
    *,
    how: str = "left",
) -> DataFrame:
    """JON-02 / JON-08: fact (batch or stream) ⟕ a dimension; a streaming fact joins a static dim per micro-batch."""
    return fact.join(dim, on, how)


def session_attribution(
    events: DataFrame,
    *,
    session_column: str = "session_id",
    type_column: str = "event_type",
    start_type: str = "session_started",
    attrs: Sequence[str] = ("channel", "source", "medium"),
) -> DataFrame:
    """JON-01: every event gets the channel/source/medium of its session start.

    The session side is one row per session (an aggregation that is
    combined map-side), joined back on ``session_id``. Events without a
    session have no attributes; they don't take part in the join, so they
    don't meet in one task.
    """
    present = [a for a in attrs if a in events.columns]
    starts = (
        events.where((F.col(type_column) == F.lit(start_type)) & F.col(session_column).isNotNull())
        .groupBy(session_column)
        .agg(*[F.min(a).alias(f"session_{a}") for a in present])
    )
    attributed = events.where(F.col(session_column).isNotNull()).join(starts, session_column, "left").select(
        *events.columns, *[f"session_{a}" for a in present]
    )
    without = events.where(F.col(session_column).isNull()).select(
        "*", *[F.lit(None).cast(events.schema[a].dataType).alias(f"session_{a}") for a in present]
    )
    return attributed.unionByName(without)


def within_interval(
    fact: DataFrame,
    ranges: DataFrame,
    *,
    ts_column: str,
    start_column: str = "start_date",
    end_column: str = "end_date",
    key: str | Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """JON-07: fact rows matched to the ranges of their key that contain
    their date (equi-join on ``key`` plus a range predicate in the join
    condition).
    ``how="left"`` keeps unmatched facts with NULL range columns."""
    keys = [key] if isinstance(key, str) else list(key)
    r = ranges.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in ranges.columns if c not in keys])
    day = F.to_date(F.col(ts_column))
    cond = [fact[k] == F.col(f"__r_{k}") for k in keys]
    cond.append((day >= F.col(start_column)) & (day <= F.col(end_column)))
    out = fact.join(r, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])
