"""Job runner: landing zone -> contract check -> Silver (+ quarantine).

``run_job`` is one AvailableNow stream over the landed files. Each line is
parsed once, checked against its contract and, if valid, deduplicated by the
stream's state; a rejected line passes that state under a key of its own, so
that none is collapsed. Every micro-batch is kept in memory and disk while it
is written twice, valid rows to Silver and rejected ones to quarantine.

Writes are idempotent: a batch owns one folder in either target, named after
the job (an id beside the checkpoint) and the batch's number. A batch that is
run again after a failure overwrites its own folders and adds nothing.

With a ``schema_location`` the schema evolves inside the batches: what a batch's
valid records have beyond the stored schema is added to it, nested keys too,
before the batch is written. One rule holds for unknown keys: without evolution,
or with ``strict``, they reject a row of a contract that allows none; with
evolution they become columns. Fields that the contract names keep its types.

All locations default to sub-folders of the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.functions.columns import parse_ts
from retail_spark.operators.quality import VIOLATIONS, contract_violations
from retail_spark.operators.silver import TRANSFORMS
from retail_spark.schemas import CONTRACTS, read_schema
from retail_spark.session import shared_path
from retail_spark.sources.landing import (
    CORRUPT, RECORD, RESCUED, file_exists, grow_schema, inferred_schema, load_schema, read_landing, rescue, typed_columns,
)
from retail_spark.streaming.dedup import DEFAULT_DELAY
from retail_spark.streaming.metrics import run_measured
from retail_spark.streaming.sinks import StreamTarget, clear_targets, kept_text


@dataclass
class JobResult:
    silver_path: str
    quarantine_path: str
    #: of this run: lines read, rows of Silver and quarantine written, and valid rows dropped behind the watermark
    read_rows: int = 0
    silver_rows: int = 0
    quarantine_rows: int = 0
    late_rows: int = 0

    def silver(self, spark: SparkSession) -> DataFrame:
        """All Silver rows; columns that later batches added are NULL in earlier ones."""
        return spark.read.option("mergeSchema", "true").parquet(self.silver_path).drop(LOAD)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("mergeSchema", "true").parquet(self.quarantine_path).drop(LOAD)


#: Folder level of a batch in both targets.
LOAD = "load"


def query_name(entity: str) -> str:
    """STR-10."""
    return f"silver_{entity}_available_now"


def _start_time(spark: SparkSession, checkpoint: str) -> str:
    """First-run start time, kept beside the checkpoint (include_existing_files=False)."""
    now = "SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\") AS t"
    return kept_text(spark, f"{checkpoint.rstrip('/')}_start_time", lambda: spark.sql(now).first().t)


def checked_stream(
    spark: SparkSession,
    entity: str,
    landing_paths: str | Sequence[str],
    *,
    evolving: bool = False,
    dedup: str = "within_watermark",
    start_time: str | None = None,
    max_files: int | None = None,
    strict: bool = False,
    path_glob: str = "*.json*",
) -> DataFrame:
    """The landed records of one entity with ``violations``, valid ones deduplicated."""
    contract = CONTRACTS[entity]
    rule = replace(contract, additional_properties=True) if evolving and not strict else contract
    raw = read_landing(
        spark, landing_paths, read_schema(contract), streaming=True, root="" if isinstance(landing_paths, str) else None,
        include_existing_files=start_time is None, start_time=start_time, max_files_per_trigger=max_files, path_glob=path_glob, keep_record=True,
    )
    checked = contract_violations(raw, rule, strict=strict)
    key = F.nullif(F.trim(F.col("event_id")), F.lit(""))
    reasons = F.when(key.isNull(), F.array_union(F.col(VIOLATIONS), F.array(F.lit("null_key:event_id")))).otherwise(F.col(VIOLATIONS))
    checked = checked.withColumn(VIOLATIONS, reasons)
    valid = F.size(VIOLATIONS) == 0
    if dedup == "none":
        return _observed(checked)
    # rejected rows have keys of their own and no time, so the state neither merges them nor finds them late; the
    # writer drops both columns: a watermark column that nothing reads would be pruned, and with it the late filter
    checked = checked.withColumn("__key", F.when(valid, key).otherwise(F.concat(F.lit("rejected:"), F.expr("uuid()"))))
    if dedup == "forever":
        time = parse_ts(contract.timestamp_column)
        return _observed(checked.withColumn("__time", F.when(valid, time)).withWatermark("__time", DEFAULT_DELAY).dropDuplicates(["__key"]))
    if dedup != "within_watermark":
        raise ValueError(f"unknown dedup mode {dedup!r}")
    checked = checked.withColumn("__time", F.when(valid, F.col("ingest_ts"))).withWatermark("__time", DEFAULT_DELAY)
    return _observed(checked.dropDuplicatesWithinWatermark(["__key"]))


def _observed(checked: DataFrame) -> DataFrame:
    """``checked``, counting what goes to either target."""
    valid = F.size(VIOLATIONS) == 0
    return checked.observe("written", F.count_if(valid).alias("silver"), F.count_if(~valid).alias("quarantine"))


class BatchWriter:
    """Writes one checked micro-batch to Silver and quarantine, in folders that the batch owns."""

    def __init__(self, spark: SparkSession, entity: str, job: str, silver: str, quarantine: str, *, fmt: str = "parquet", schema_location: str | None = None):
        self.spark, self.entity, self.job, self.fmt, self.schema_location = spark, entity, job, fmt, schema_location
        self.silver, self.quarantine = silver.rstrip("/"), quarantine.rstrip("/")

    def __call__(self, batch: DataFrame, number: int) -> None:
        batch = batch.drop("__key", "__time").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():  # a batch that only moves the watermark
                return
            load = f"{LOAD}={self.job}-{number}"
            valid = batch.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS, CORRUPT)
            if self.schema_location:
                valid = self._evolved(valid)
            rows = TRANSFORMS[self.entity](valid.drop(RECORD), dedup="none")
            self._write(rows, f"{self.silver}/{load}", CONTRACTS[self.entity].date_column)
            self._write(batch.where(F.size(VIOLATIONS) > 0).drop(RECORD), f"{self.quarantine}/{load}")
        finally:
            batch.unpersist()

    def _write(self, rows: DataFrame, path: str, *partitions: str) -> None:
        rows.write.format(self.fmt).mode("overwrite").partitionBy(*partitions).save(path)

    def _evolved(self, valid: DataFrame) -> DataFrame:
        """``valid`` with the columns that the stored schema and this batch's records have beyond the contract."""
        base = read_schema(CONTRACTS[self.entity])
        schema = grow_schema(self.spark, inferred_schema(valid, load_schema(self.spark, self.schema_location)), self.schema_location, base)
        known = {f.name for f in base.fields} | set(valid.columns)
        more = type(schema)([f for f in schema.fields if f.name not in known])
        record = F.col(RECORD)
        added = dict(zip(more.fieldNames(), typed_columns(record, more)))
        return valid.withColumns({RESCUED: rescue(record, schema), **added})


def run_job(
    spark: SparkSession,
    entity: str,
    landing_paths: str | Sequence[str],
    *,
    output_path: str | None = None,
    quarantine_path: str | None = None,
    checkpoint_location: str | None = None,
    schema_location: str | None = None,
    reprocess: bool = False,
    reprocess_roots: Sequence[str] = (),
    dedup: str = "within_watermark",
    include_existing_files: bool = True,
    fmt: str = "parquet",
    max_files: int | None = None,
    strict: bool = False,
    path_glob: str = "*.json*",
    writer: type[BatchWriter] = BatchWriter,
) -> JobResult:
    """Run one entity's Silver job to completion (AvailableNow).

    ``reprocess`` deletes the job's own folders first; those outside the shared
    folder must lie below one of ``reprocess_roots``. ``max_files`` bounds the
    files of one micro-batch, ``schema_location`` turns evolution on.
    """
    output_path = output_path or shared_path(spark, "silver", entity)
    quarantine_path = quarantine_path or shared_path(spark, "quarantine", entity)
    checkpoint_location = (checkpoint_location or shared_path(spark, "_checkpoints", entity)).rstrip("/")
    if reprocess:
        clear_targets(spark, [output_path, checkpoint_location, quarantine_path, f"{checkpoint_location}_job"], [shared_path(spark), *reprocess_roots])
    # a checkpoint that was deleted on its own starts a new job, whose batches don't overwrite the old one's
    if not file_exists(spark, f"{checkpoint_location}/metadata"):
        clear_targets(spark, [f"{checkpoint_location}_job"], [checkpoint_location.rpartition("/")[0]])
    job = kept_text(spark, f"{checkpoint_location}_job", lambda: uuid.uuid4().hex[:12])
    stream = checked_stream(
        spark, entity, landing_paths, evolving=schema_location is not None, dedup=dedup, max_files=max_files, strict=strict, path_glob=path_glob,
        start_time=None if include_existing_files else _start_time(spark, checkpoint_location),
    )
    write = writer(spark, entity, job, output_path, quarantine_path, fmt=fmt, schema_location=schema_location)
    batches = run_measured(spark, lambda: (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
                                           .queryName(query_name(entity)).trigger(availableNow=True).start()))
    total = lambda what: sum(b[-1].get(what, 0) for b in batches)
    return JobResult(output_path, quarantine_path, sum(b[3] for b in batches), total("silver"), total("quarantine"), sum(b[4] for b in batches))


def stream_to_table(
    df: DataFrame,
    *,
    spark: SparkSession,
    name: str,
    partition_by: Sequence[str] | None = None,
    output_mode: str = "append",
) -> DataFrame:
    """Run a streaming DataFrame once into a fresh parquet folder under the
    shared dir and return the batch read of it (used by registered queries)."""
    out = shared_path(spark, "streams", name, unique=True)
    StreamTarget(f"{out}/_checkpoint", path=f"{out}/data", mode=output_mode, partitions=tuple(partition_by or ())).run(df)
    return spark.read.parquet(f"{out}/data")
