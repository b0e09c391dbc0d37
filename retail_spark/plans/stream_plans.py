"""Registered streaming plans (SRC-01..06, SNK-01..04/09, STR-01..10, DQ-02).

Each plan runs a Structured Streaming query with the AvailableNow trigger
into a fresh folder under the shared ``spark.checkpoint.dir`` and returns
the batch read of the sink, so the driver compares what the stream wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_spark.operators.dims import ACQUISITION_CHANNELS
from retail_spark.plans import adapters as A
from retail_spark.plans.common import Plan, finalize, sql_case_map, sql_pick
from retail_spark.session import shared_path
from retail_spark.sources.landing import read_landing
from retail_spark.sources.tables import read_table_stream
from retail_spark.streaming.dedup import deduplicate_stream
from retail_spark.streaming.jobs import run_job, stream_to_table
from retail_spark.streaming.sinks import StreamTarget, stream_routed_jsonl, write_routed_jsonl
from retail_spark.streaming.windows import session_windows, windowed_kpis

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-06: the events table as a file stream; ``ts`` as an instant
    (watermarks need ``timestamp``), ingest time from the file."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    s = read_table_stream(spark, sf, schema, pathGlobFilter="events.parquet")
    return s.select(
        *[F.col(c) for c in schema.fieldNames() if c != "ts"],
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("_metadata.file_modification_time").alias("ingest_ts"),
    )


def q_stream_dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    """STR-01/02/05/07: every event delivered twice, deduplicated by the
    stream (ingest-time watermark, state evicted after 7 days)."""
    s = events_stream(spark, sf).withColumn("__copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("__copy")
    d = deduplicate_stream(s, timestamp_column="ts", mode="within_watermark")
    return finalize(stream_to_table(d, spark=spark, name="dedup_events"))


STREAM_DEDUP_EVENTS_SQL = "SELECT DISTINCT event_id, user_id, event_type, value, props, ts FROM events"


def q_stream_dedup_events_forever(spark: SparkSession, sf: str) -> DataFrame:
    """STR-02 parity mode: event-time watermark + dropDuplicates(event_id)."""
    s = events_stream(spark, sf).withColumn("__copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("__copy", "ingest_ts")
    d = deduplicate_stream(s, timestamp_column="ts", mode="forever")
    return finalize(stream_to_table(d, spark=spark, name="dedup_events_forever"))


def _typed_events(spark: SparkSession, sf: str, *, copies: int = 1) -> DataFrame:
    s = events_stream(spark, sf)
    if copies > 1:  # at-least-once delivery: every event arrives `copies` times
        s = s.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("__copy")
    return s.select(
        F.col("event_id"),
        F.col("ts").alias("event_ts"),
        A._map(A.EVENT_VOCAB, F.col("event_type")).alias("event_type"),
        F.col("value").cast("decimal(18,2)").alias("event_amount"),
        F.col("user_id").alias("customer_id"),
        "ingest_ts",
    )


def q_stream_hourly_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """STR-08 (+STR-02 chained): every event delivered twice, deduplicated
    within the watermark, then hourly tumbling windows (1 h watermark delay)
    in append mode: a window is written once the watermark passes its end.
    Time is the earlier of event and arrival (STR-07)."""
    k = windowed_kpis(_typed_events(spark, sf, copies=2), window="1 hour", delay="1 hour", dedup_key="event_id", ingest_column="ingest_ts")
    return finalize(stream_to_table(k, spark=spark, name="hourly_kpi"))


STREAM_HOURLY_KPI_SQL = f"""
WITH e AS (SELECT ts, {sql_case_map('event_type', A.EVENT_VOCAB)} AS et, CAST(CAST(value AS VARCHAR) AS DECIMAL(18,2)) AS amt FROM events),
w AS (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
             COUNT(*) AS events, COUNT(*) FILTER (WHERE et = 'session_started') AS sessions,
             COUNT(*) FILTER (WHERE et = 'order_placed') AS orders,
             CAST(SUM(CASE WHEN et = 'order_placed' THEN amt END) AS DOUBLE) AS gmv
      FROM e GROUP BY 1, 2)
SELECT * FROM w WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR"""


def q_stream_arrival_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """STR-07/08: two deliveries, two runs on one checkpoint. Purchases of the first one with k above 90 are stamped 25 days
    ahead, as deliveries are; counted by arrival they make nothing of the second late."""
    root = shared_path(spark, "streams", "arrival", unique=True)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    middle = F.lit("2024-01-16").cast("timestamp")
    ts = F.col("ts").cast("timestamp")
    ahead = F.when((F.col("event_type") == "purchase") & (A.props_k() > 90) & (ts < middle), F.expr("INTERVAL 25 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    rows = ev.select("event_id", (ts + ahead).alias("event_ts"), ts.alias("ingest_ts"), A._map(A.EVENT_VOCAB, F.col("event_type")).alias("event_type"),
                     F.col("value").cast("decimal(18,2)").alias("event_amount"))
    for part in (rows.where(F.col("ingest_ts") < middle), rows.where(F.col("ingest_ts") >= middle)):
        part.write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landed")
        kpis = windowed_kpis(stream, window="1 hour", delay="1 hour", dedup_key="event_id", ingest_column="ingest_ts")
        StreamTarget(f"{root}/checkpoint", path=f"{root}/kpis").run(kpis)
    return finalize(spark.read.parquet(f"{root}/kpis"))


def q_stream_routed(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-09 on a stream: events routed to ``<dataset>/dt=`` (by day: the tables hold few events an hour), and what the landing reader finds there."""
    root = shared_path(spark, "routed", unique=True)
    s = events_stream(spark, sf).select(F.col("event_id").cast("string").alias("event_id"), A._map(A.EVENT_VOCAB, F.col("event_type")).alias("event_type"), "ts", "value")
    stream_routed_jsonl(s, f"{root}/zone", f"{root}/checkpoint", ts_column="ts", granularity="day").awaitTermination()
    found = read_landing(spark, f"{root}/zone", T.StructType.fromDDL("event_id string, event_type string, value double"), streaming=False, root=f"{root}/zone")
    return found.select("event_id", "event_type", "value", "dataset", "dt")


STREAM_ROUTED_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, {sql_case_map('event_type', A.EVENT_VOCAB)} AS event_type, value, {sql_case_map('event_type', A.EVENT_VOCAB)} AS dataset,
       strftime(ts, '%Y-%m-%d') AS dt FROM events"""


def q_stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """STR-09 on a stream: 30-minute session windows per user, emitted once
    the 1 h watermark passes the session end."""
    s = session_windows(_typed_events(spark, sf), user_column="customer_id", gap="30 minutes", delay="1 hour")
    return finalize(stream_to_table(s, spark=spark, name="sessions"))


STREAM_SESSIONS_SQL = """
WITH e AS (SELECT user_id AS customer_id, ts FROM events),
e1 AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s
       FROM e WINDOW w AS (PARTITION BY customer_id ORDER BY ts)),
e2 AS (SELECT *, SUM(new_s) OVER (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn FROM e1),
s AS (SELECT customer_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS events
      FROM e2 GROUP BY customer_id, sn)
SELECT * FROM s WHERE session_end <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR"""


# ------------------------------------------------------------- landing job

def landed_events(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as producer records: typed envelope + open ``attributes``."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    k = A.props_k()
    et = A._map(A.EVENT_VOCAB, F.col("event_type"))
    signup = F.col("event_type") == "signup"
    purchase = F.col("event_type") == "purchase"
    attrs = F.struct(
        k.alias("k"),
        F.when(signup, A._pick(ACQUISITION_CHANNELS, k)).alias("channel"),
        F.when(signup, F.lit(" Web ")).alias("source"),
        F.when(purchase, F.col("value")).alias("gross_amount"),
        F.when(purchase, F.col("value")).alias("net_amount"),
    )
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_ts"),
        et.alias("event_type"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("session_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        k.cast("string").alias("product_id"),
        F.lit("desktop").alias("device_type"),
        F.lit("web").alias("platform"),
        F.lit("").alias("referrer"),
        F.lit("USD").alias("currency"),
        F.lit(1).alias("quantity"),
        F.col("value").alias("unit_price"),
        attrs.alias("attributes"),
        ts.alias("__ts"),
    )


LANDING_COLS = ["event_id", "event_ts", "event_type", "session_id", "customer_id", "product_id", "unit_price", "quantity",
                "event_amount", "channel", "source", "is_commerce_event", "event_date", "event_hour"]


def q_landing_silver_job(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-09 -> SRC-01/03/04/05 -> DQ-01/02 -> PRJ-08 -> STR-07 -> SNK-01..04:
    events are landed as routed JSONL (dataset/dt), then the Silver job
    fans in every dataset folder, checks the contract, quarantines and
    writes Silver partitioned by event date."""
    root = shared_path(spark, "landing", unique=True)
    landed = landed_events(spark, sf)
    write_routed_jsonl(landed, root, dataset_column="event_type", ts_column="__ts", drop_columns=["__ts"], granularity="day")
    res = run_job(spark, "fact_event_raw", f"{root}", output_path=f"{root}_silver", quarantine_path=f"{root}_quarantine",
                  checkpoint_location=f"{root}_checkpoint")
    return finalize(res.silver(spark).select(*LANDING_COLS))


LANDING_SILVER_JOB_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_ts, {sql_case_map('event_type', A.EVENT_VOCAB)} AS event_type,
       'S' || CAST(user_id AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS customer_id, CAST({K} AS VARCHAR) AS product_id,
       CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE) AS unit_price, 1 AS quantity,
       CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE) AS event_amount,
       CASE WHEN event_type = 'signup' THEN {sql_pick(ACQUISITION_CHANNELS, K)} END AS channel,
       CASE WHEN event_type = 'signup' THEN 'web' END AS source,
       event_type IN ('click', 'purchase') AS is_commerce_event,
       CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour
FROM events"""


# ------------------------------------- quarantine, evolution, rescued data

#: Names of the files that ``land_lines`` writes.
LINES = "*.txt*"


def land_lines(records: DataFrame, root: str) -> None:
    """Write ready JSON lines (dataset, dt, value) in the landing layout; nothing checks that they are JSON."""
    records.hint("rebalance", "dataset", "dt").write.mode("append").partitionBy("dataset", "dt").text(root)


def faulty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a landed line, with the faults that producers make, by event type and props k.

    Every event comes twice, valid ones to be collapsed. Faults: sign-ups
    without a session; views of a quantity 0; clicks with a blank id;
    purchases with an unknown key or a quantity that is text; error events with
    another event type, or lines that break off.
    """
    ev = spark.read.parquet(f"{sf}/events.parquet")
    k, kind, low = A.props_k(), F.col("event_type"), A.props_k() < 10
    ts = F.col("ts").cast("timestamp")
    whole = F.to_json(F.struct(
        F.when((kind == "click") & low, F.lit("  ")).otherwise(F.col("event_id").cast("string")).alias("event_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_ts"),
        F.when((kind == "error") & low, F.lit("teleport")).otherwise(A._map(A.EVENT_VOCAB, kind)).alias("event_type"),
        F.when(~((kind == "signup") & low), F.concat(F.lit("S"), F.col("user_id").cast("string"))).alias("session_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit("desktop").alias("device_type"), F.lit("web").alias("platform"), F.lit("").alias("referrer"), F.lit("USD").alias("currency"),
        F.when((kind == "view") & low, 0).when(kind == "view", 1).alias("quantity"),
        F.when((kind == "purchase") & low, F.lit("?")).alias("mystery"),
        F.struct(k.alias("k")).alias("attributes"),
    ))
    ev = ev.withColumn("whole", whole)
    whole = F.col("whole")
    text = F.when((kind == "purchase") & (k >= 90), F.regexp_replace(whole, r"\}$", ',"quantity":"two"}'))
    text = text.when((kind == "error") & (k >= 90), F.substring(whole, 1, 40)).otherwise(whole)
    copies = F.explode(F.array(F.lit(0), F.lit(1)))
    return ev.select(A._map(A.EVENT_VOCAB, kind).alias("dataset"), F.to_date("ts").cast("string").alias("dt"), text.alias("value"), copies.alias("copy")).drop("copy")


def q_landing_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-02 in the job: one parse, one stream, two idempotent writes. All rows of both targets, with their reasons."""
    root = shared_path(spark, "landing", unique=True)
    land_lines(faulty_lines(spark, sf), root)
    res = run_job(spark, "fact_event_raw", root, output_path=f"{root}_silver", quarantine_path=f"{root}_quarantine",
                  checkpoint_location=f"{root}_checkpoint", path_glob=LINES)
    silver = res.silver(spark).select("event_id", "dataset", F.lit("silver").alias("target"), F.lit("").alias("reasons"), F.lit(False).alias("corrupt"))
    bad = res.quarantine(spark).select("event_id", "dataset", F.lit("quarantine").alias("target"), F.concat_ws(",", F.array_sort("violations")).alias("reasons"),
                                       F.col("_corrupt_record").isNotNull().alias("corrupt"))
    return silver.unionByName(bad)


LANDING_QUARANTINE_SQL = f"""
WITH e AS (SELECT *, {K} AS k, {sql_case_map('event_type', A.EVENT_VOCAB)} AS dataset FROM events),
f AS (
  SELECT CASE WHEN event_type = 'error' AND k >= 90 THEN NULL WHEN event_type = 'click' AND k < 10 THEN '  ' ELSE CAST(event_id AS VARCHAR) END AS event_id, dataset,
         CASE WHEN event_type = 'error' AND k >= 90 THEN 'malformed_json,null_key:event_id,required:attributes,required:currency,required:device_type,'
                   || 'required:event_id,required:event_ts,required:event_type,required:platform,required:referrer,required:session_id'
              WHEN event_type = 'error' AND k < 10 THEN 'enum:event_type'
              WHEN event_type = 'click' AND k < 10 THEN 'null_key:event_id'
              WHEN event_type = 'signup' AND k < 10 THEN 'required:session_id'
              WHEN event_type = 'view' AND k < 10 THEN 'minimum:quantity'
              WHEN event_type = 'purchase' AND k < 10 THEN 'unexpected:mystery'
              WHEN event_type = 'purchase' AND k >= 90 THEN 'type:quantity' ELSE '' END AS reasons,
         event_type = 'error' AND k >= 90 AS corrupt
  FROM e)
SELECT event_id, dataset, CASE WHEN reasons = '' THEN 'silver' ELSE 'quarantine' END AS target, reasons, corrupt
FROM f, range(2) AS copies(c) WHERE c = 0 OR reasons <> ''"""


def q_landing_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-02 in the job: two deliveries, the second with new keys at the top and inside an object; all Silver rows."""
    root = shared_path(spark, "landing", unique=True)
    where = dict(output_path=f"{root}_silver", quarantine_path=f"{root}_quarantine", checkpoint_location=f"{root}_checkpoint", schema_location=f"{root}_schema", path_glob=LINES)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    k, ts = A.props_k(), F.col("ts").cast("timestamp")
    envelope = [
        F.col("event_id").cast("string").alias("event_id"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_ts"),
        A._map(A.EVENT_VOCAB, F.col("event_type")).alias("event_type"), F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("session_id"),
        F.lit("desktop").alias("device_type"), F.lit("web").alias("platform"), F.lit("").alias("referrer"), F.lit("USD").alias("currency"),
        F.struct(k.alias("k")).alias("attributes"),
    ]
    system = F.when(k % 2 == 0, "ios").otherwise("android").alias("os")
    first = F.to_json(F.struct(*envelope, F.struct(system).alias("device")))
    screen = F.struct(F.col("value").alias("scale"), F.array(k, k + 1).alias("size")).alias("screen")
    second = F.to_json(F.struct(*envelope, F.struct(system, k.alias("version"), screen).alias("device"), (k > 50).alias("trial")))
    early = F.col("event_type").isin("signup", "view", "click")
    for rows, line in ((ev.where(early), first), (ev.where(~early), second)):
        land_lines(rows.select(A._map(A.EVENT_VOCAB, F.col("event_type")).alias("dataset"), F.to_date("ts").cast("string").alias("dt"), line.alias("value")), root)
        res = run_job(spark, "fact_event_raw", root, **where)
    return res.silver(spark).select(
        "event_id", F.col("device.os").alias("os"), F.col("device.version").alias("version"), F.col("device.screen.scale").alias("scale"),
        F.col("device.screen.size")[1].alias("height"), "trial", F.col("_rescued_data").isNotNull().alias("rescued"))


LANDING_EVOLVED_SQL = f"""
WITH e AS (SELECT *, {K} AS k, event_type NOT IN ('signup', 'view', 'click') AS late FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN k % 2 = 0 THEN 'ios' ELSE 'android' END AS os,
       CASE WHEN late THEN CAST(k AS BIGINT) END AS version, CASE WHEN late THEN value END AS scale,
       CASE WHEN late THEN CAST(k + 1 AS BIGINT) END AS height, CASE WHEN late THEN k > 50 END AS trial, false AS rescued
FROM e"""


def q_stream_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-05: a stream into a catalog table, run over two deliveries; the second brings two new columns and lacks an old one."""
    root = shared_path(spark, "evolved", unique=True)
    target = StreamTarget(f"{root}/_checkpoint", path=f"{root}/table", table=f"evolved_{uuid.uuid4().hex}", partitions=("event_date",))
    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("event_date", F.to_date("ts"))
    early = F.col("event_type").isin("signup", "view", "click")
    first = ev.where(early).select("event_id", "event_date", "event_type", "user_id")
    second = ev.where(~early).select("event_id", "event_date", "event_type", "value", F.array(A.props_k(), F.lit(0)).alias("keys"))
    for rows in (first, second):
        rows.write.mode("append").parquet(f"{root}/landing")
        target.run(spark.readStream.schema(rows.schema).parquet(f"{root}/landing"))
    return target.read(spark).select(
        "event_id", F.col("event_date").cast("string").alias("event_date"), "event_type", "user_id", "value", F.get("keys", F.lit(0)).alias("k"))


STREAM_EVOLVED_SQL = f"""
WITH e AS (SELECT *, event_type IN ('signup', 'view', 'click') AS early FROM events)
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type, CASE WHEN early THEN user_id END AS user_id,
       CASE WHEN NOT early THEN value END AS value, CASE WHEN NOT early THEN {K} END AS k
FROM e"""


def q_landing_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-04: typed fields, what doesn't fit them, and broken lines, from one parse of each landed line."""
    root = shared_path(spark, "landing", unique=True)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    k, kind = A.props_k(), F.col("event_type")
    line = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.when(kind == "view", k.cast("string")).alias("quantity"),
        F.when(kind == "purchase", F.col("value")).alias("unit_price"),
        F.when(kind == "signup", F.struct(k.alias("k"))).alias("tags"),
        F.when(kind == "click", k % 2 == 0).alias("flag"),
    ))
    line = F.when((kind == "click") & (k < 10), F.regexp_replace(line, r"\}$", ',"quantity":2.5}')).when(kind == "error", F.concat(F.lit("["), line, F.lit("]"))).otherwise(line)
    land_lines(ev.select(kind.alias("dataset"), F.to_date("ts").cast("string").alias("dt"), line.alias("value")), root)
    return read_landing(spark, root, T.StructType.fromDDL("id bigint, quantity int, unit_price double, flag string"), streaming=False, root=root, path_glob=LINES).select(
        "id", "quantity", "unit_price", "flag", "dataset", "_rescued_data", "_corrupt_record")


LANDING_RESCUED_SQL = f"""
WITH e AS (SELECT *, {K} AS k FROM events)
SELECT CASE WHEN event_type <> 'error' THEN event_id END AS id, CAST(NULL AS INTEGER) AS quantity,
       CASE WHEN event_type = 'purchase' THEN value END AS unit_price,
       CASE WHEN event_type = 'click' THEN CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END END AS flag, event_type AS dataset,
       CASE WHEN event_type = 'view' THEN '{{"quantity":"' || k || '"}}' WHEN event_type = 'signup' THEN '{{"tags":{{"k":' || k || '}}}}'
            WHEN event_type = 'click' AND k < 10 THEN '{{"quantity":2.5}}' END AS _rescued_data,
       CASE WHEN event_type = 'error' THEN '[{{"id":' || event_id || '}}]' END AS _corrupt_record
FROM e"""


PLANS = {
    "stream_dedup_events": Plan(q_stream_dedup_events, STREAM_DEDUP_EVENTS_SQL, "SRC-06 STR-01,02,05,06,07 SNK-01,02"),
    "stream_dedup_events_forever": Plan(q_stream_dedup_events_forever, STREAM_DEDUP_EVENTS_SQL, "STR-01,02,03 (parity mode)"),
    "stream_hourly_kpi": Plan(q_stream_hourly_kpi, STREAM_HOURLY_KPI_SQL, "STR-08 STR-02 (chained)"),
    "stream_arrival_kpi": Plan(q_stream_arrival_kpi, STREAM_HOURLY_KPI_SQL, "STR-07 STR-08"),
    "stream_routed": Plan(q_stream_routed, STREAM_ROUTED_SQL, "SNK-09 SRC-05"),
    "stream_sessions": Plan(q_stream_sessions, STREAM_SESSIONS_SQL, "STR-09"),
    "landing_silver_job": Plan(q_landing_silver_job, LANDING_SILVER_JOB_SQL,
                               "SNK-09 SRC-01,03,04,05 DQ-01,02 PRJ-08,09 STR-07,10 SNK-01..04"),
    "landing_quarantine": Plan(q_landing_quarantine, LANDING_QUARANTINE_SQL, "DQ-02 SRC-01,04,05 STR-02,04"),
    "stream_evolved": Plan(q_stream_evolved, STREAM_EVOLVED_SQL, "SNK-03 SNK-05"),
    "landing_evolved": Plan(q_landing_evolved, LANDING_EVOLVED_SQL, "SRC-02 SNK-05"),
    "landing_rescued": Plan(q_landing_rescued, LANDING_RESCUED_SQL, "SRC-04 SRC-05"),
}
