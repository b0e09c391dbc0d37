"""The landing job: one parse, idempotent batches, schema evolution by one rule (SRC-02, SRC-04, DQ-02)."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_spark.schemas import FACT_EVENT_RAW_V1, read_schema
from retail_spark.sources import landing as L
from retail_spark.streaming.jobs import BatchWriter, run_job

from .test_sources_streaming import fact, land

AT = "2026-03-16T10:00:00+00:00"


def where(scratch):
    return dict(output_path=f"{scratch}/silver", quarantine_path=f"{scratch}/quarantine", checkpoint_location=f"{scratch}/ck")


def ids(df):
    return sorted((r.event_id or "") for r in df.select("event_id").collect())


class DiesBetweenWrites(BatchWriter):
    """Stops after a batch's Silver was written and before its quarantine."""

    def _write(self, rows, path, *partitions):
        if path.startswith(self.quarantine):
            raise RuntimeError("the job was killed")
        super()._write(rows, path, *partitions)


def test_killed_batch_adds_nothing_when_run_again(spark, scratch):
    root = f"{scratch}/land"
    land(root, "page_view", "2026-03-16", "10", [fact("a", AT), fact("a", AT), fact(None, AT), fact(None, AT)], "1")
    run_job(spark, "fact_event_raw", root, **where(scratch))
    land(root, "page_view", "2026-03-16", "11", [fact("a", AT), fact("b", AT), fact("c", AT, event_type="teleport")], "2")
    with pytest.raises(Exception, match="killed"):
        run_job(spark, "fact_event_raw", root, writer=DiesBetweenWrites, **where(scratch))
    assert len([d for d in os.listdir(f"{scratch}/silver") if d.startswith("load=")]) == 2  # the dead batch's Silver is there
    res = run_job(spark, "fact_event_raw", root, **where(scratch))
    assert ids(res.silver(spark)) == ["a", "b"]
    assert ids(res.quarantine(spark)) == ["", "", "c"]
    res = run_job(spark, "fact_event_raw", root, **where(scratch))  # nothing new
    assert ids(res.silver(spark)) == ["a", "b"] and res.quarantine(spark).count() == 3
    assert res.silver(spark).select("dataset").distinct().first()[0] == "page_view"


def test_lost_checkpoint_starts_a_job_of_its_own(spark, scratch):
    import shutil

    root = f"{scratch}/land"
    land(root, "page_view", "2026-03-16", "10", [fact("a", AT)], "1")
    run_job(spark, "fact_event_raw", root, **where(scratch))
    shutil.move(f"{scratch}/ck", f"{scratch}/lost")
    res = run_job(spark, "fact_event_raw", root, **where(scratch))
    assert ids(res.silver(spark)) == ["a", "a"]  # read again, and the old batch is not overwritten


def test_evolution_in_the_job(spark, scratch):
    """New keys, nested ones too, become columns; fields of the contract keep their types; strict still rejects."""
    root, loc = f"{scratch}/land", f"{scratch}/schema"
    land(root, "page_view", "2026-03-16", "10", [fact("a", AT, device={"os": "ios"}), fact("b", AT, quantity="two", broken=1)], "1")
    res = run_job(spark, "fact_event_raw", root, schema_location=loc, **where(scratch))
    assert L.load_schema(spark, loc)["device"].dataType.simpleString() == "struct<os:string>"
    assert "broken" not in L.load_schema(spark, loc).fieldNames()  # a rejected row shapes no schema
    land(root, "page_view", "2026-03-16", "11", [fact("c", AT, device={"os": "tv", "screen": {"size": [1, 2.5]}}, odd=None), fact("d", AT, device="old")], "2")
    res = run_job(spark, "fact_event_raw", root, schema_location=loc, **where(scratch))
    got = {r.event_id: r for r in res.silver(spark).collect()}
    assert sorted(got) == ["a", "c", "d"]
    assert got["a"].device.os == "ios" and got["a"].device.screen is None
    assert got["c"].device.screen.size == [1.0, 2.5] and got["c"]._rescued_data is None
    assert got["d"].device is None and json.loads(got["d"]._rescued_data) == {"device": "old"}
    assert [r.violations for r in res.quarantine(spark).collect()] == [["type:quantity"]]
    versions = spark.read.parquet(f"{loc}/versions").count()
    run_job(spark, "fact_event_raw", root, schema_location=loc, **where(scratch))
    assert spark.read.parquet(f"{loc}/versions").count() == versions
    strict = {k: v + "_strict" for k, v in where(scratch).items()}
    res = run_job(spark, "fact_event_raw", root, schema_location=f"{loc}_strict", strict=True, **strict)
    assert {tuple(sorted(r.violations)) for r in res.quarantine(spark).collect()} == {("unexpected:device",), ("type:quantity", "unexpected:broken")}


def test_ledger_reads_new_files_only(spark, scratch, monkeypatch):
    root, loc, seen = f"{scratch}/evo", f"{scratch}/schema", []
    real = L.inferred_schema
    monkeypatch.setattr(L, "inferred_schema", lambda rows, *a: (seen.append(len(rows.inputFiles())), real(rows, *a))[1])
    monkeypatch.setattr(L, "FILES", 2)
    for k in range(3):
        land(root, "x", "2026-03-16", "10", [{"event_id": "a", "n": {f"f{k}": k}}, "{broken", [1]], str(k))
    first = L.evolve_schema(spark, root, loc)
    assert seen == [2, 1] and sorted(first["n"].dataType.fieldNames()) == ["f0", "f1", "f2"]
    land(root, "x", "2026-03-16", "11", [{"event_id": 7, "n": {"f0": "text", "g": [{"h": True}]}}], "3")
    second = L.evolve_schema(spark, root, loc)
    assert seen == [2, 1, 1] and second["n"].dataType["g"].dataType.simpleString() == "array<struct<h:boolean>>"
    assert second["n"].dataType["f0"].dataType == T.LongType() and second["event_id"].dataType == T.StringType()
    assert L.evolve_schema(spark, root, loc) == second and len(seen) == 3
    assert L.evolve_schema(spark, f"{scratch}/evo/x", f"{scratch}/none", path_glob="*.absent", base=first) == first


def test_merge_schemas_at_every_level():
    old = T.StructType.fromDDL("a bigint, s struct<x bigint, y string>, l array<struct<p bigint>>")
    new = T.StructType.fromDDL("s struct<z boolean, x string>, l array<struct<q string, p bigint>>, a struct<b bigint>, n double")
    want = T.StructType.fromDDL("a bigint, s struct<x bigint, y string, z boolean>, l array<struct<p bigint, q string>>, n double")
    assert L.merge_schemas(old, new) == want and L.merge_schemas(want, new) == want and L.merge_schemas(None, new) == new


def test_rescue_from_one_parse(spark, scratch):
    schema = T.StructType.fromDDL("t string, n bigint, d double, b boolean, s struct<x bigint, y string>, l array<double>, w timestamp")
    cases = {
        '{"t":"a","n":1,"d":1,"b":true,"s":{"x":1,"y":2},"l":[1,2.5],"w":"2026-03-16T10:00:00Z"}': None,
        '{"t":5,"n":1.0,"d":"1","b":"true","s":{"x":"1"},"l":[1,"2"],"w":"soon"}': {"n": 1, "d": "1", "b": "true", "s": {"x": "1"}, "l": [1, "2"], "w": "soon"},
        '{"s":{"x":1,"extra":null},"l":{},"n":123456789012345678901}': {"s": {"x": 1, "extra": None}, "l": {}, "n": 123456789012345678901},
        '{"t":null,"n":null,"s":null,"l":null,"o\'dd key":{"k":[null]},"none":null}': {"o'dd key": {"k": [None]}},
        "{}": None,
    }
    broken = ['{"t":', "[1]", "7", "null", '{"t":"a","t":"b"}']
    land(f"{scratch}/r", "x", "2026-03-16", "10", [*cases, *broken, "", "  "], "1")
    df = L.read_landing(spark, f"{scratch}/r", schema, streaming=False, keep_record=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1 and "from_json" not in plan.lower()
    got = df.withColumn("line", F.to_json(L.RECORD)).drop(L.RECORD).collect()
    assert sorted(r._corrupt_record for r in got if r._corrupt_record) == sorted(broken)
    found = {json.dumps(json.loads(r.line), sort_keys=True): r for r in got if r.line}
    for text, rescued in cases.items():
        r = found[json.dumps(json.loads(text), sort_keys=True)] if "1.0" not in text else next(x for x in got if x.t == "5")
        assert (json.loads(r._rescued_data) if r._rescued_data else None) == rescued, text
        if rescued:
            assert all(r[k] is None for k in rescued if k in schema.fieldNames())
    whole = next(r for r in got if r.t == "a")
    assert (whole.n, whole.d, whole.b, whole.s.x, whole.s.y, whole.l) == (1, 1.0, True, 1, "2", [1.0, 2.5]) and whole.w is not None


def test_contract_reads_rescued_types(spark, scratch):
    land(f"{scratch}/r", "x", "2026-03-16", "10", [fact("a", AT, quantity=1.5, unit_price="9", mystery={"a": 1})], "1")
    from retail_spark.operators.quality import contract_violations

    df = L.read_landing(spark, f"{scratch}/r", read_schema(FACT_EVENT_RAW_V1), streaming=False)
    assert sorted(contract_violations(df, FACT_EVENT_RAW_V1).first().violations) == ["type:quantity", "type:unit_price", "unexpected:mystery"]


def test_run_reports_what_it_read_wrote_and_dropped(spark, scratch):
    """An event 25 days ahead makes later ones late in parity mode; each lost row is counted."""
    root = f"{scratch}/land"
    land(root, "x", "2026-04-10", "00", [fact("fut", "2026-04-10T00:00:00+00:00", "shipment_delivered"), "{broken"], "1")
    first = run_job(spark, "fact_event_raw", root, dedup="forever", **where(scratch))
    assert (first.read_rows, first.silver_rows, first.quarantine_rows, first.late_rows) == (2, 1, 1, 0)
    land(root, "x", "2026-03-16", "10", [fact(k, AT) for k in "abc"] + [fact("new", "2026-04-11T00:00:00+00:00"), fact("bad", AT, event_type="teleport")], "2")
    res = run_job(spark, "fact_event_raw", root, dedup="forever", **where(scratch))
    assert ids(res.silver(spark)) == ["fut", "new"] and ids(res.quarantine(spark)) == ["", "bad"]
    assert (res.read_rows, res.silver_rows, res.quarantine_rows, res.late_rows) == (5, 1, 1, 3)
    assert res.read_rows == res.silver_rows + res.quarantine_rows + res.late_rows


def test_routed_stream_runs_a_batch_again_without_copies(spark, scratch):
    from retail_spark.streaming.sinks import stream_routed_jsonl

    schema = "id int, event_type string, event_ts string, note string"
    rows = [(1, "page_view", "2026-03-16 10:05:00", "x"), (2, "order/placed", "2026-03-16 11:00:00", "y"), (3, None, None, "z"), (4, "page_view", "2026-03-16 10:50:00", "w")]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{scratch}/in")
    stream = lambda: spark.readStream.schema(schema).json(f"{scratch}/in")
    stream_routed_jsonl(stream(), f"{scratch}/zone", f"{scratch}/ck", drop_columns=["note"]).awaitTermination()
    assert sorted(os.listdir(f"{scratch}/zone")) == ["order_placed", "page_view", "unknown"]
    assert os.listdir(f"{scratch}/zone/page_view/dt=2026-03-16") == ["hour=10"]
    os.remove(f"{scratch}/ck/commits/0")  # as if the job had died before it noted the batch
    for crc in [f for f in os.listdir(f"{scratch}/ck/commits") if f.endswith(".crc")]:
        os.remove(f"{scratch}/ck/commits/{crc}")
    stream_routed_jsonl(stream(), f"{scratch}/zone", f"{scratch}/ck", drop_columns=["note"]).awaitTermination()
    back = spark.read.option("recursiveFileLookup", "true").json(f"{scratch}/zone")
    assert sorted(r.id for r in back.collect()) == [1, 2, 3, 4] and "note" not in back.columns
