"""Landing sources (SRC-01..05), sinks (SNK-06/07/09/10) and streaming
semantics (STR-01..09) with two AvailableNow runs on one checkpoint."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from retail_spark.schemas import FACT_EVENT_RAW_V1, read_schema
from retail_spark.sources.landing import evolve_schema, read_landing
from retail_spark.streaming.jobs import run_job
from retail_spark.streaming.sinks import StreamTarget, clear_targets, preview, write_routed_jsonl, write_snapshot_jsonl
from retail_spark.streaming.windows import windowed_kpis


def fact(event_id, ts, event_type="page_view", **extra):
    rec = {
        "event_id": event_id, "event_ts": ts, "event_type": event_type, "session_id": "S1",
        "device_type": "mobile", "platform": "ios", "referrer": "", "currency": "usd", "attributes": {"flow_id": "F1"},
    }
    rec.update(extra)
    return rec


def land(root, dataset, day, hour, records, name):
    d = os.path.join(root, dataset, f"dt={day}", f"hour={hour}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"batch_{name}.jsonl"), "w") as fh:
        for r in records:
            fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def test_rescued_corrupt_and_fan_in(spark, scratch):
    root = os.path.join(scratch, "landing")
    land(root, "page_view", "2026-03-16", "10", [fact("e1", "2026-03-16T10:00:00+00:00", mystery="?")], "a")
    land(root, "order_placed", "2026-03-16", "11", [fact("e2", "2026-03-16T11:00:00+00:00", "order_placed", quantity="two"), "{not json"], "b")
    df = read_landing(spark, root, read_schema(FACT_EVENT_RAW_V1), streaming=False, root=root)
    got = {r.event_id: r for r in df.collect()}
    assert json.loads(got["e1"]._rescued_data) == {"mystery": "?"}
    assert json.loads(got["e2"]._rescued_data) == {"quantity": "two"} and got["e2"].quantity is None
    assert got["e1"].dataset == "page_view" and got["e2"].dt == "2026-03-16" and got["e2"].hour == "11"
    assert got[None]._corrupt_record == "{not json"
    assert got["e1"].source_file.endswith(".jsonl")


def test_schema_evolution_adds_columns(spark, scratch):
    root, loc = os.path.join(scratch, "evo"), os.path.join(scratch, "schema")
    land(root, "x", "2026-03-16", "10", [{"event_id": "a", "n": 1}], "1")
    s1 = evolve_schema(spark, root, loc)
    land(root, "x", "2026-03-16", "11", [{"event_id": "b", "n": "text", "extra": True}], "2")
    s2 = evolve_schema(spark, root, loc)
    assert s1.fieldNames() == ["event_id", "n"]
    assert s2.fieldNames() == ["event_id", "n", "extra"] and s2["n"].dataType == s1["n"].dataType  # never narrowed
    df = read_landing(spark, root, s2, streaming=False)
    got = {r.event_id: r for r in df.collect()}
    assert got["a"].extra is None and got["b"].n is None and json.loads(got["b"]._rescued_data) == {"n": "text"}


def _silver_ids(spark, path):
    return sorted(r.event_id for r in spark.read.parquet(path).select("event_id").collect())


def test_job_two_runs_dedup_quarantine_and_reprocess(spark, scratch):
    root = os.path.join(scratch, "land")
    out, ck, q = (os.path.join(scratch, n) for n in ("silver", "ck", "quarantine"))
    land(root, "page_view", "2026-03-16", "10",
         [fact("e1", "2026-03-16T10:00:00+00:00"), fact("e2", "2026-03-16T10:01:00+00:00"),
          fact(None, "2026-03-16T10:02:00+00:00"), fact(None, "2026-03-16T10:03:00+00:00"),
          fact("e3", "2026-03-16T10:04:00+00:00", event_type="teleport")], "1")
    run_job(spark, "fact_event_raw", root, output_path=out, checkpoint_location=ck, quarantine_path=q)
    assert _silver_ids(spark, out) == ["e1", "e2"]
    land(root, "page_view", "2026-03-16", "11", [fact("e1", "2026-03-16T10:00:00+00:00"), fact("e4", "2026-03-16T11:00:00+00:00")], "2")
    run_job(spark, "fact_event_raw", root, output_path=out, checkpoint_location=ck, quarantine_path=q)
    assert _silver_ids(spark, out) == ["e1", "e2", "e4"]  # cross-run duplicate removed
    bad = spark.read.parquet(q)
    assert bad.count() == 3  # both NULL ids kept (not collapsed) + the enum violation
    assert bad.where(F.array_contains("violations", "enum:event_type")).count() == 1
    # reprocess: reset target side, re-read everything -> same result as a fresh run
    run_job(spark, "fact_event_raw", root, output_path=out, checkpoint_location=ck, quarantine_path=q, reprocess=True, reprocess_roots=[scratch])
    assert _silver_ids(spark, out) == ["e1", "e2", "e4"]
    assert spark.read.parquet(q).count() == 3


@pytest.mark.parametrize("mode,expected", [("within_watermark", ["fut", "now"]), ("forever", ["fut"])])
def test_future_dated_event_poisoning(spark, scratch, mode, expected):
    root = os.path.join(scratch, "poison")
    out, ck = os.path.join(scratch, "s"), os.path.join(scratch, "c")
    land(root, "shipment_delivered", "2026-04-10", "00", [fact("fut", "2026-04-10T00:00:00+00:00", "shipment_delivered")], "1")
    run_job(spark, "fact_event_raw", root, output_path=out, checkpoint_location=ck, dedup=mode)
    time.sleep(0.01)
    land(root, "page_view", "2026-03-16", "10", [fact("now", "2026-03-16T10:00:00+00:00")], "2")
    run_job(spark, "fact_event_raw", root, output_path=out, checkpoint_location=ck, dedup=mode)
    # event-time watermark (parity mode) drops the present-time event after a +25-day one
    assert _silver_ids(spark, out) == expected


def test_routed_and_snapshot_sinks_and_preview(spark, scratch):
    df = spark.createDataFrame(
        [("e1", "page_view", "2026-03-16T10:00:00+00:00"), ("e2", "order_placed", "2026-03-16T11:30:00+00:00")],
        "event_id string, event_type string, event_ts string",
    )
    root = os.path.join(scratch, "routed")
    write_routed_jsonl(df, root)
    assert os.path.isdir(os.path.join(root, "dataset=order_placed", "dt=2026-03-16", "hour=11"))
    snap = write_snapshot_jsonl(df, os.path.join(scratch, "snap"), "customers", ingest_date="2026-03-16")
    assert os.path.isdir(os.path.join(snap, "ingest_date=2026-03-16"))
    with pytest.raises(ValueError):
        write_snapshot_jsonl(df.limit(0), os.path.join(scratch, "snap"), "empty")
    stream = spark.readStream.schema(df.schema).json(os.path.join(root, "dataset=page_view", "dt=2026-03-16", "hour=10"))
    assert preview(stream).count() == 1
    gone = os.path.join(scratch, "absent")
    assert clear_targets(spark, [root, gone], [scratch]) == {root: True, gone: False}
    for outside in ("/", scratch, scratch + "-other/x"):
        with pytest.raises(ValueError):
            clear_targets(spark, [outside], [scratch])
    for wrong in ({}, {"path": "a", "mode": "overwrite"}, {"path": "ck"}):
        with pytest.raises(ValueError):
            StreamTarget("ck", **wrong)


def test_future_event_keeps_later_orders(spark, scratch):
    """STR-08: an event stamped 25 days ahead doesn't make the next run's order late."""
    path, out = os.path.join(scratch, "ev"), os.path.join(scratch, "kpi")
    schema = "event_id string, event_ts timestamp, ingest_ts timestamp, event_type string, event_amount decimal(18,2)"

    def deliver(*rows):
        spark.createDataFrame(rows, "i string, e string, a string, t string, m double").selectExpr(
            "i event_id", "to_timestamp(e) event_ts", "to_timestamp(a) ingest_ts", "t event_type", "cast(m as decimal(18,2)) event_amount"
        ).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        StreamTarget(out + "_ck", path=out).run(windowed_kpis(stream, ingest_column="ingest_ts", dedup_key="event_id"))

    deliver(("d1", "2026-04-10 10:00:00", "2026-03-16 10:00:00", "shipment_delivered", 0.0))
    deliver(("o1", "2026-03-16 11:10:00", "2026-03-16 11:11:00", "order_placed", 99.0),
            ("p1", "2026-03-16 15:00:00", "2026-03-16 15:00:00", "page_view", 0.0))
    deliver(("p2", "2026-03-16 18:00:00", "2026-03-16 18:00:00", "page_view", 0.0))
    assert spark.read.parquet(out).agg(F.sum("gmv")).first()[0] == 99


def test_stream_windows_equal_batch(spark, scratch):
    rows = [("2026-03-16 10:05:00", "session_started", 0.0), ("2026-03-16 10:20:00", "order_placed", 10.5),
            ("2026-03-16 11:10:00", "order_placed", 4.5), ("2026-03-16 13:00:00", "page_view", 0.0)]
    df = spark.createDataFrame(rows, "ts string, event_type string, amt double").select(
        F.to_timestamp("ts").alias("event_ts"), "event_type", F.col("amt").cast("decimal(18,2)").alias("event_amount")
    )
    path = os.path.join(scratch, "ev")
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    out = os.path.join(scratch, "kpi")
    q = windowed_kpis(stream).writeStream.format("parquet").option("checkpointLocation", out + "_ck").trigger(availableNow=True).start(out)
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = sorted(tuple(r) for r in windowed_kpis(df).where(F.col("window_end") <= F.lit("2026-03-16 12:00:00").cast("timestamp")).collect())
    assert streamed == batch and len(streamed) == 2  # the 13:00 window is still open


def test_skip_existing_files_and_table_streams(spark, scratch):
    from retail_spark.sources.tables import read_catalog_stream
    root = os.path.join(scratch, "skip")
    land(root, "page_view", "2026-03-16", "10", [fact("old", "2026-03-16T10:00:00+00:00")], "1")
    ck = os.path.join(scratch, "ck_skip")
    out = os.path.join(scratch, "skip_out")
    where = dict(include_existing_files=False, checkpoint_location=ck, output_path=out, quarantine_path=out + "_q")
    run_job(spark, "fact_event_raw", root, **where)
    time.sleep(1.1)  # file modification times have 1 s resolution on some file systems
    land(root, "page_view", "2026-03-16", "11", [fact("new", "2026-03-16T11:00:00+00:00")], "2")
    run_job(spark, "fact_event_raw", root, **where)
    assert _silver_ids(spark, out) == ["new"]  # files present before the first run are skipped

    # SNK-03 (external catalog table) then SRC-07 (stream the table back)
    src = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path = os.path.join(scratch, "tbl_src")
    src.write.parquet(path)
    stream = spark.readStream.schema(src.schema).parquet(path)
    table_path = os.path.join(scratch, "tbl")
    StreamTarget(os.path.join(scratch, "tbl_ck"), path=table_path, table="retail_stream_tbl", name="silver_tbl_available_now").run(stream)
    assert sorted(r.k for r in spark.table("retail_stream_tbl").collect()) == ["a", "b"]
    back = read_catalog_stream(spark, "retail_stream_tbl")
    out2 = os.path.join(scratch, "tbl_back")
    StreamTarget(os.path.join(scratch, "tbl_back_ck"), path=out2).run(back)
    assert spark.read.parquet(out2).count() == 2
    spark.sql("DROP TABLE IF EXISTS retail_stream_tbl")


def test_windowed_kpis_dedup_key_batch(spark):
    rows = [("e1", "2026-03-16 10:05:00", "order_placed", 10.5), ("e2", "2026-03-16 10:20:00", "session_started", 0.0)]
    df = spark.createDataFrame(rows, "event_id string, ts string, event_type string, amt double").select(
        "event_id", F.to_timestamp("ts").alias("event_ts"), "event_type", F.col("amt").cast("decimal(18,2)").alias("event_amount")
    )
    once = sorted(tuple(r) for r in windowed_kpis(df).collect())
    twice = sorted(tuple(r) for r in windowed_kpis(df.unionByName(df), dedup_key="event_id").collect())
    assert once == twice and once[0][2:5] == (2, 1, 1)


def test_table_takes_new_columns_and_refuses_changed_ones(spark, scratch):
    """SNK-05: a catalog table grows by the stream's new columns; another type or a forbidden column stops before the write."""
    from dataclasses import replace

    from retail_spark.streaming.sinks import StreamTarget

    target = StreamTarget(f"{scratch}/ck", path=f"{scratch}/table", table="grown_table", partitions=("day",))

    def deliver(target, rows, schema):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{scratch}/in")
        target.run(spark.readStream.schema(schema).parquet(f"{scratch}/in"))

    spark.sql("DROP TABLE IF EXISTS grown_table")
    deliver(target, [(1, "a", "d1")], "id long, name string, day string")
    with pytest.raises(ValueError, match="other types"):
        target.evolve(spark.createDataFrame([], "id string, day string"))
    with pytest.raises(ValueError, match="no columns"):
        replace(target, merge_schema=False).evolve(spark.createDataFrame([], "id long, `odd ``name` int, day string"))
    deliver(target, [(2, 2.5, [1, 2], "d1")], "ID long, score double, `tag list` array<int>, day string")
    got = {r["id"]: (r["name"], r["score"], r["tag list"], r["day"]) for r in target.read(spark).collect()}
    assert got == {1: ("a", None, None, "d1"), 2: (None, 2.5, [1, 2], "d1")}
    assert target.evolve(spark.createDataFrame([], "id long, day string")) == []
    folder = replace(target, table=None)
    assert {"name", "score"} <= set(folder.read(spark).columns)
    spark.sql("DROP TABLE grown_table")
