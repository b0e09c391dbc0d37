"""Dimensions (DIM-01..07), master data (SRC-08), joins (JON-02/07/08),
DQ-06/08 and schema merge on read (SNK-05)."""

from __future__ import annotations

import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from retail_spark.operators import dims as D
from retail_spark.operators.joins import enrich, session_attribution, within_interval
from retail_spark.operators.quality import inventory_identity, lead_time_check
from retail_spark.sources.tables import read_master


def _write_json_array(path, records):
    with open(path, "w") as fh:
        json.dump(records, fh, indent=2)


def test_master_data_and_dimensions(spark, scratch):
    cust = os.path.join(scratch, "customers.json")
    prod = os.path.join(scratch, "products.json")
    camp = os.path.join(scratch, "campaigns.json")
    inv = os.path.join(scratch, "inventory.json")
    _write_json_array(cust, [
        {"customer_id": "CUST001", "first_name": "Ana", "last_name": "Li", "email": "a@x", "country": "BR", "segment": "vip", "created_at": "2026-01-01T00:00:00+00:00"},
        {"customer_id": "CUST002", "first_name": "Bo", "last_name": "Ng", "email": "b@x", "country": "JP", "segment": "new", "created_at": "2026-01-02T00:00:00+00:00"},
    ])
    _write_json_array(prod, [
        {"product_id": "PROD001", "sku": "S1", "name": "Lamp", "category": "home", "brand": "Atlas", "price": 10.005, "active": True, "created_at": "2026-01-01T00:00:00+00:00"},
        {"product_id": "PROD002", "sku": "S2", "name": "Mug", "category": "kitchen", "brand": "Orbit", "price": 3.0, "active": False, "created_at": "2026-01-01T00:00:00+00:00"},
    ])
    _write_json_array(camp, [
        {"campaign_id": "CMP-003", "channel": "email", "source": "list", "medium": "mail", "campaign_name": "A", "start_date": "2026-02-05", "end_date": "2026-02-19", "daily_budget": 41.5},
        {"campaign_id": "CMP-007", "channel": "email", "source": "crm", "medium": "email", "campaign_name": "B", "start_date": "2026-05-01", "end_date": "2026-05-31", "daily_budget": 10.0},
    ])
    _write_json_array(inv, [
        {"snapshot_ts": "2026-05-03T00:00:00+00:00", "warehouse_id": "W-EAST", "product_id": "PROD001", "on_hand_qty": 40, "reserved_qty": 15, "available_qty": 25},
        {"snapshot_ts": "2026-05-04T00:00:00+00:00", "warehouse_id": "W-EAST", "product_id": "PROD001", "on_hand_qty": 10, "reserved_qty": 1, "available_qty": 8},
    ])
    dc = {r.customer_id: r for r in D.dim_customers(read_master(spark, cust, "customers")).collect()}
    n = sum(ord(c) * (i + 1) for i, c in enumerate("CUST001"))
    assert dc["CUST001"].birth_year == 1965 + n % 35 and dc["CUST001"].city == "Campinas"
    assert dc["CUST001"].acquisition_channel == D.ACQUISITION_CHANNELS[n % 6]
    assert dc["CUST001"].is_marketing_opt_in == (n % 5 != 0)
    assert dc["CUST002"].city == "Unknown" and dc["CUST002"].signup_ts.startswith("2026-01-02")
    dp = {r.product_id: r for r in D.dim_products(read_master(spark, prod, "products")).collect()}
    assert dp["PROD001"].category_id == "CAT-HOM" and dp["PROD001"].unit_price == Decimal("10.01")
    assert dp["PROD001"].cost == Decimal("5.80") and dp["PROD002"].is_active is False
    assert [r.product_id for r in D.active_products(D.dim_products(read_master(spark, prod, "products"))).collect()] == ["PROD001"]
    sp = D.silver_products(read_master(spark, prod, "products")).first()
    assert sp.created_at is not None and isinstance(sp.price, float)
    cbc = {r.channel: r.campaign_id for r in D.campaign_by_channel(read_master(spark, camp, "campaigns")).collect()}
    assert cbc == {"email": "CMP-007"}
    snaps = read_master(spark, inv, "inventory")
    assert inventory_identity(snaps).where(~F.col("identity_ok")).count() == 1


def test_stream_static_enrichment_and_attribution(spark, scratch):
    dim = spark.createDataFrame([("P1", "home")], "product_id string, category string")
    path = os.path.join(scratch, "facts")
    facts = spark.createDataFrame([("e1", "P1"), ("e2", "P9")], "event_id string, product_id string")
    facts.write.parquet(path)
    stream = spark.readStream.schema(facts.schema).parquet(path)
    out = os.path.join(scratch, "enriched")
    q = enrich(stream, dim, "product_id").writeStream.format("parquet").option("checkpointLocation", out + "_ck").trigger(availableNow=True).start(out)
    q.awaitTermination()
    got = {r.event_id: r.category for r in spark.read.parquet(out).collect()}
    assert got == {"e1": "home", "e2": None}
    ev = spark.createDataFrame(
        [("s1", "session_started", "email"), ("s1", "order_placed", None), ("s2", "page_view", None)],
        "session_id string, event_type string, channel string",
    )
    att = {(r.session_id, r.event_type): r.session_channel for r in session_attribution(ev).collect()}
    assert att[("s1", "order_placed")] == "email" and att[("s2", "page_view")] is None
    # events without a session are kept, with no attributes
    loose = spark.createDataFrame([(None, "page_view", "email"), (None, "session_started", "ads")], ev.schema)
    assert [r.session_channel for r in session_attribution(ev.unionByName(loose)).where("session_id IS NULL").collect()] == [None, None]


def test_interval_join_and_lead_time(spark):
    fact = spark.createDataFrame([("o1", "c1", "2026-04-10"), ("o2", "c1", "2026-06-10"), ("o3", "c2", "2026-04-10")], "order_id string, campaign_id string, ts string")
    ranges = spark.createDataFrame([("c1", "2026-04-01", "2026-04-30")], "campaign_id string, s string, e string").select(
        "campaign_id", F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date")
    )
    got = sorted(r.order_id for r in within_interval(fact, ranges, ts_column="ts", key="campaign_id").collect())
    assert got == ["o1"]
    ship = spark.createDataFrame([("o1", "2026-04-10 00:00:00")], "order_id string, ts string").select("order_id", F.to_timestamp("ts").alias("event_ts"))
    dlv = spark.createDataFrame([("o1", "2026-04-12 00:00:00", 48.0), ("o2", "2026-04-12 00:00:00", 5.0)], "order_id string, ts string, h double").select(
        "order_id", F.to_timestamp("ts").alias("event_ts"), F.col("h").alias("delivery_lead_time_hours")
    )
    chk = {r.order_id: r.lead_time_ok for r in lead_time_check(dlv, ship).collect()}
    assert chk == {"o1": True, "o2": None}


def test_schema_merge_on_read(spark, scratch):
    base = os.path.join(scratch, "silver")
    spark.createDataFrame([("e1",)], "event_id string").write.parquet(os.path.join(base, "event_date=2026-03-16"))
    spark.createDataFrame([("e2", 5)], "event_id string, n int").write.parquet(os.path.join(base, "event_date=2026-03-17"))
    merged = spark.read.option("mergeSchema", "true").parquet(base)
    assert set(merged.columns) == {"event_id", "n", "event_date"} and merged.count() == 2


def test_create_schema(spark):
    from retail_spark.streaming.sinks import create_schema

    create_schema(spark, "retail_silver_test")
    create_schema(spark, "retail_silver_test")  # idempotent
    assert spark.catalog.databaseExists("retail_silver_test")
    spark.sql("DROP SCHEMA retail_silver_test")
