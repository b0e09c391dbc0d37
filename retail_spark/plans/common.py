"""Shared pieces of the registered plans: output normalisation and the
DuckDB SQL renderings of the cleaning rules (for the oracle queries)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NON_DETERMINISTIC = ("source_file", "silver_processed_at", "ingest_ts")


@dataclass(frozen=True)
class Plan:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None  # DuckDB oracle; None = rows-only check
    ops: str = ""  # SURVEY ids covered


def finalize(df: DataFrame, drop: Sequence[str] = NON_DETERMINISTIC) -> DataFrame:
    """Comparable output: decimals as double (exact sums converted once),
    instants as wall-clock ``timestamp_ntz`` (session time zone is UTC),
    non-deterministic metadata dropped."""
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# --- DuckDB renderings of the cleaning kinds (operators.silver._KINDS) ---

SQL_KIND = {
    "ts": "TRY_CAST({} AS TIMESTAMP)",
    "str": "NULLIF(TRIM({}), '')",
    "lower": "LOWER(NULLIF(TRIM({}), ''))",
    "upper": "UPPER(NULLIF(TRIM({}), ''))",
    "int": "TRY_CAST({} AS INTEGER)",
    "bool": "TRY_CAST({} AS BOOLEAN)",
    "money": "CAST(TRY_CAST({} AS DECIMAL(18,2)) AS DOUBLE)",
    "pct": "CAST(TRY_CAST({} AS DECIMAL(5,2)) AS DOUBLE)",
    "double": "TRY_CAST({} AS DOUBLE)",
}
SQL_MISSING = {"bool": "CAST(NULL AS BOOLEAN)"}


def sql_clean(spec: Sequence[tuple[str, str]], present: Sequence[str]) -> tuple[list[str], list[str]]:
    """(REPLACE items for present columns, extra items for missing ones)."""
    have = set(present)
    replace, extra = [], []
    for name, kind in spec:
        src = name if name in have else SQL_MISSING.get(kind, "CAST(NULL AS VARCHAR)")
        item = f"{SQL_KIND[kind].format(src)} AS {name}"
        (replace if name in have else extra).append(item)
    return replace, extra


def sql_select_clean(source: str, spec: Sequence[tuple[str, str]], present: Sequence[str], extra: Sequence[str] = ()) -> str:
    replace, add = sql_clean(spec, present)
    rep = f" REPLACE ({', '.join(replace)})" if replace else ""
    items = ", ".join(["*" + rep, *add, *extra])
    return f"SELECT {items} FROM {source}"


def sql_metadata(ts: str, date_col: str) -> str:
    return f"CAST({ts} AS DATE) AS {date_col}, CAST(hour({ts}) AS INTEGER) AS event_hour, CAST(year({ts}) AS INTEGER) AS event_year"


def sql_in(values: Sequence[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def sql_case_map(expr: str, mapping: dict, quote_keys: bool = True) -> str:
    def q(v):
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) or quote_keys else str(v)

    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def sql_pick(values: Sequence[str], k: str) -> str:
    """element of ``values`` at (k mod n) (0-based)."""
    arr = "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
    return f"{arr}[CAST(((({k}) % {len(values)}) + {len(values)}) % {len(values)} AS INTEGER) + 1]"
