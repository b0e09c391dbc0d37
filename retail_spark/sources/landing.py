"""Landing-zone sources (SRC-01..05, SRC-09).

Landed events are newline-delimited JSON under
``<root>/<dataset>/dt=YYYY-MM-DD/hour=HH/batch_*.jsonl`` (event files) or
``<root>/<dataset>/ingest_date=YYYY-MM-DD/snapshot_*.jsonl`` (snapshots).

``read_landing`` returns a batch or streaming DataFrame over one or many
dataset folders with:

* an explicit schema (SRC-03) or a stored, evolving one (SRC-02);
* ``_rescued_data``: JSON of the fields that are unknown to the schema or do
  not fit their type, and ``_corrupt_record`` for lines that are no JSON
  object, or one that names a key twice (SRC-04);
* ``source_file`` / ``ingest_ts`` captured at the scan from ``_metadata``;
* ``dataset`` / ``dt`` / ``hour`` / ``ingest_date`` taken from the path, so
  one recursive scan fans in every per-event-type folder (SRC-05).

The lines are read with the text source and each is parsed once, into a
VARIANT; typed fields, the rescued rest and the schema that the data has
(``schema_of_variant_agg``) are all read from that value.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"

_DATASET = r"/(?:dataset=)?([^/=]+)/(?:dt|ingest_date)="
_PATH_PARTS = {
    "dt": r"/dt=([^/]+)/",
    "hour": r"/hour=([^/]+)/",
    "ingest_date": r"/ingest_date=([^/]+)/",
}


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _reader(spark: SparkSession, streaming: bool, options: dict[str, str]):
    r = spark.readStream if streaming else spark.read
    for k, v in options.items():
        r = r.option(k, v)
    return r


def path_columns(file_path: Column, root: str | None = None) -> dict[str, Column]:
    """SRC-05: dataset and partition values parsed from the file path.

    ``dataset`` is the folder right above ``dt=`` / ``ingest_date=`` (plain
    ``<dataset>`` or Hive-style ``dataset=<name>``); it is added when
    ``root`` is given (a recursive scan over several datasets).
    """
    cols: dict[str, Column] = {}
    if root is not None:
        cols["dataset"] = F.nullif(F.regexp_extract(file_path, _DATASET, 1), F.lit(""))
    for name, pattern in _PATH_PARTS.items():
        cols[name] = F.nullif(F.regexp_extract(file_path, pattern, 1), F.lit(""))
    return cols


RECORD = "__record"


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _member(record: Column, name: str) -> Column:
    return F.try_variant_get(record, _path(name), "variant")


def _as_map(record: Column) -> Column:
    return record.try_cast("map<string,variant>")


def typed_value(value: Column, dtype: T.DataType) -> Column:
    """A VARIANT as ``dtype``; NULL where it does not fit (see ``fits``). Nested values as text are their JSON."""
    if isinstance(dtype, T.StructType):
        members = [typed_value(_member(value, f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(fits(value, dtype), F.struct(*members))
    if isinstance(dtype, T.ArrayType):
        return F.when(fits(value, dtype), F.transform(value.try_cast("array<variant>"), lambda x: typed_value(x, dtype.elementType)))
    if isinstance(dtype, (T.StringType, T.VariantType)):
        return value.try_cast("string")
    return F.when(fits(value, dtype), value.try_cast(dtype))


def fits(value: Column, dtype: T.DataType) -> Column:
    """Whether a VARIANT (not null) is of a JSON type that ``dtype`` holds without loss; all levels must fit.

    Texts hold any value, doubles any number, integers whole numbers only; a
    number in quotes is text. A struct holds an object whose keys it all has.
    """
    null = value.isNull() | F.is_variant_null(value)
    if isinstance(dtype, T.StructType):
        known = F.array(*[F.lit(f.name) for f in dtype.fields])
        ok = _as_map(value).isNotNull() & F.forall(F.map_keys(_as_map(value)), lambda k: F.array_contains(known, k))
        for f in dtype.fields:
            if not isinstance(f.dataType, T.StringType):
                ok = ok & fits(_member(value, f.name), f.dataType)
    elif isinstance(dtype, T.ArrayType):
        items = value.try_cast("array<variant>")
        ok = items.isNotNull() & F.forall(items, lambda x: fits(x, dtype.elementType))
    elif isinstance(dtype, (T.StringType, T.VariantType)):
        return F.lit(True)
    else:
        kind = F.schema_of_variant(value)
        if isinstance(dtype, T.BooleanType):
            ok = kind == "BOOLEAN"
        elif isinstance(dtype, T.IntegralType):
            ok = kind == "BIGINT"
        elif isinstance(dtype, T.FractionalType):
            ok = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        else:  # dates and times come as text
            ok = value.try_cast(dtype).isNotNull()
    return null | F.coalesce(ok, F.lit(False))


def rescue(record: Column, schema: T.StructType) -> Column:
    """SRC-04: JSON of what ``schema`` loses of a record, or NULL.

    A key is rescued, with its whole value, when the schema lacks it or when
    its value is non-null and does not fit the schema's type. Records whose keys
    are all known and fit, most of them, are not looked at key by key.
    """
    known = F.array(*[F.lit(f.name) for f in schema.fields]) if schema.fields else F.array().cast("array<string>")
    checked = [f for f in schema.fields if not isinstance(f.dataType, (T.StringType, T.VariantType))]
    misfit = {f.name: ~fits(_member(record, f.name), f.dataType) for f in checked}
    misfits = F.array(*[F.when(bad, F.lit(name)) for name, bad in misfit.items()]) if checked else F.array().cast("array<string>")
    some = F.size(F.array_except(F.map_keys(_as_map(record)), known)) > 0
    for bad in misfit.values():
        some = bad | some
    left = F.map_filter(_as_map(record), lambda k, v: ~F.is_variant_null(v) & (~F.array_contains(known, k) | F.array_contains(F.array_compact(misfits), k)))
    return F.when(some, F.when(F.size(left) > 0, F.to_json(left)))


def typed_columns(record: Column, schema: T.StructType) -> list[Column]:
    """The schema's fields of a record, one column each."""
    def value(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StringType):  # as typed_value, without a VARIANT of its own between
            return F.try_variant_get(record, _path(f.name), "string")
        return typed_value(_member(record, f.name), f.dataType)

    return [value(f).alias(f.name) for f in schema.fields]


def read_landing(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    streaming: bool = True,
    root: str | None = None,
    rescued_data_column: str | None = RESCUED,
    include_existing_files: bool = True,
    start_time: str | None = None,
    max_files_per_trigger: int | None = None,
    path_glob: str = "*.json*",
    keep_record: bool = False,
) -> DataFrame:
    """SRC-01/03/04/05/09: typed DataFrame over landed JSONL files.

    ``paths`` may be one dataset folder, several (fan-in), or the landing
    root with ``root=`` set (recursive scan, ``dataset`` from the path).
    ``include_existing_files=False`` keeps only files modified at or after
    ``start_time`` (the caller stores the first run's start beside its
    checkpoint; see streaming.jobs). ``keep_record`` adds the parsed line, a
    VARIANT, as ``__record``.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": path_glob}
    if streaming and max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    reader = _reader(spark, streaming, options).format("text")
    lines = reader.load(_as_list(paths)) if not streaming else _union_stream(reader, _as_list(paths))
    lines = lines.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("ingest_ts"),
    )
    if not include_existing_files and start_time:
        lines = lines.where(F.col("ingest_ts") >= F.to_timestamp(F.lit(start_time)))
    lines = lines.where(F.length(F.trim("value")) > 0)
    lines = lines.withColumn(RECORD, F.try_parse_json("value"))
    lines = lines.withColumn(RECORD, F.when(F.schema_of_variant(RECORD).startswith("OBJECT"), F.col(RECORD)))
    extra: list[Column] = []
    if rescued_data_column:
        extra += [rescue(F.col(RECORD), schema).alias(rescued_data_column), F.when(F.col(RECORD).isNull(), F.col("value")).alias(CORRUPT)]
    parts = path_columns(F.col("source_file"), root)
    return lines.select(
        *typed_columns(F.col(RECORD), schema), *extra, "source_file", "ingest_ts", *[c.alias(n) for n, c in parts.items()],
        *([RECORD] if keep_record else []),
    )


def _union_stream(reader, paths: list[str]) -> DataFrame:
    frames = [reader.load(p) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---------------------------------------------------------------------------
# SRC-02: stored, evolving schema (addNewColumns)
# ---------------------------------------------------------------------------

def merge_types(stored: T.DataType, found: T.DataType) -> T.DataType:
    """``stored`` with the new fields of ``found`` at every level; a type once stored stays."""
    if isinstance(stored, T.StructType) and isinstance(found, T.StructType):
        return merge_schemas(stored, found)
    if isinstance(stored, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merge_types(stored.elementType, found.elementType))
    return stored


def merge_schemas(stored: T.StructType | None, found: T.StructType) -> T.StructType:
    """Union of fields, nested ones too. Values that no longer fit a stored
    type are rescued at read time; new fields come last, in found order."""
    if stored is None:
        return found
    new = {f.name: f.dataType for f in found.fields}
    kept = [T.StructField(f.name, merge_types(f.dataType, new[f.name]) if f.name in new else f.dataType) for f in stored.fields]
    names = {f.name for f in stored.fields}
    return T.StructType(kept + [f for f in found.fields if f.name not in names])


def _plain(dtype: T.DataType) -> T.DataType | None:
    """An inferred type as it is stored: numbers with a fraction as double, mixed values as text; None if all were null."""
    if isinstance(dtype, T.StructType):
        fields = [(f.name, _plain(f.dataType)) for f in dtype.fields]
        fields = [T.StructField(n, t) for n, t in fields if t is not None]
        return T.StructType(fields) if fields else T.StringType()
    if isinstance(dtype, T.ArrayType):
        element = _plain(dtype.elementType)
        return T.ArrayType(element) if element is not None else None
    if isinstance(dtype, T.NullType):
        return None
    if isinstance(dtype, T.FractionalType):
        return T.DoubleType()
    return T.StringType() if isinstance(dtype, T.VariantType) else dtype


def _from_variant_text(found: str) -> T.DataType | None:
    """The type that ``schema_of_variant`` names; it says OBJECT for struct. Names in backquotes stay as they are."""
    ddl = "".join(p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p) for p in re.split(r"(`(?:[^`]|``)*`)", found))
    return _plain(T.DataType.fromDDL(ddl))


def inferred_schema(records: DataFrame, like: T.StructType | None = None, record: str = RECORD) -> T.StructType:
    """The schema that all of ``records``' VARIANT objects have together: one aggregation, merged in every task.

    A field whose values are of several kinds is text. Where ``like`` has an
    object or array, values of that kind alone count, so that a stray value
    doesn't hide the new keys of the others.
    """
    nested = [f for f in (like.fields if like else []) if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    aggs = [F.schema_of_variant_agg(record)]
    for f in nested:
        value = _member(F.col(record), f.name)
        kind = "OBJECT" if isinstance(f.dataType, T.StructType) else "ARRAY"
        aggs.append(F.schema_of_variant_agg(F.when(F.schema_of_variant(value).startswith(kind), value)))
    whole, *parts = records.where(F.col(record).isNotNull()).agg(*[a.alias(f"_{k}") for k, a in enumerate(aggs)]).first()
    found = _from_variant_text(whole)
    if not isinstance(found, T.StructType):
        return T.StructType([])
    own = {f.name: _from_variant_text(text) for f, text in zip(nested, parts)}
    return T.StructType([T.StructField(f.name, own.get(f.name) or f.dataType) for f in found.fields])


def file_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def load_schema(spark: SparkSession, schema_location: str) -> T.StructType | None:
    """The newest stored version; None before the first. A read error is raised, never taken for a first run."""
    versions = f"{schema_location}/versions"
    if not file_exists(spark, versions):
        return None
    row = spark.read.schema("version int, schema string").parquet(versions).orderBy(F.desc("version")).first()
    return T.StructType.fromJson(json.loads(row.schema)) if row else None


def store_schema(spark: SparkSession, schema: T.StructType, schema_location: str) -> None:
    """Append a version; none is ever overwritten, so a job that dies while it writes leaves the last one in place."""
    versions = f"{schema_location}/versions"
    last = spark.read.schema("version int, schema string").parquet(versions).agg(F.max("version")).first()[0] if file_exists(spark, versions) else 0
    row = [((last or 0) + 1, json.dumps(schema.jsonValue()))]
    spark.createDataFrame(row, "version int, schema string").coalesce(1).write.mode("append").parquet(versions)


def grow_schema(spark: SparkSession, found: T.StructType, schema_location: str, base: T.StructType | None = None) -> T.StructType:
    """The stored schema (``base`` before the first) with what is new in ``found``; stored if that changes it."""
    stored = load_schema(spark, schema_location)
    merged = merge_schemas(stored or base, found)
    if merged != stored:
        store_schema(spark, merged, schema_location)
    return merged


#: Files whose names the driver holds at once.
FILES = 10_000


def _lots(rows: Iterator, size: int) -> Iterator[list]:
    while lot := list(islice(rows, size)):
        yield lot


def evolve_schema(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema_location: str,
    *,
    base: T.StructType | None = None,
    path_glob: str = "*.json*",
) -> T.StructType:
    """Infer the schema of files not seen yet, merge it with the stored one, store it.

    A ledger beside the schema names every file that was inferred, with its
    modification time; only others are read, ``FILES`` at a time. For batch
    readers: the streaming job infers from its own micro-batches instead
    (streaming.jobs), whose checkpoint is its ledger.
    """
    ledger, schema = f"{schema_location}/files", "path string, modificationTime timestamp"
    there = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=path_glob).load(_as_list(paths))
    there = there.select("path", "modificationTime")
    if file_exists(spark, ledger):
        there = there.join(spark.read.schema(schema).parquet(ledger), ["path", "modificationTime"], "left_anti")
    merged = load_schema(spark, schema_location) or base
    for lot in _lots(there.toLocalIterator(), FILES):
        lines = spark.read.text([r.path for r in lot]).select(F.try_parse_json("value").alias(RECORD))
        found = inferred_schema(lines.where(F.schema_of_variant(RECORD).startswith("OBJECT")), merged)
        merged = grow_schema(spark, found, schema_location, base)
        spark.createDataFrame(lot, schema).coalesce(1).write.mode("append").parquet(ledger)
    return merged if merged is not None else T.StructType([])
