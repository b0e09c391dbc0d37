"""Table sources (SRC-06..08) and the driver's parquet tables.

Parquet reads always name their columns so the scan's ReadSchema stays
narrow; filters written on the returned DataFrame reach the scan as
PushedFilters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from retail_spark.schemas import MASTER_SCHEMAS


def read_table_stream(
    spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet", **options: str
) -> DataFrame:
    """SRC-06: stream the files of a table store by path (delta when the jar exists)."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_catalog_stream(spark: SparkSession, table_name: str) -> DataFrame:
    """SRC-07: stream a catalog table."""
    return spark.readStream.table(table_name)


def read_master(spark: SparkSession, path: str, name: str) -> DataFrame:
    """SRC-08: one master-data file (a JSON array of objects), typed."""
    return spark.read.schema(MASTER_SCHEMAS[name]).option("multiLine", "true").json(path)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``), optionally pruned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
