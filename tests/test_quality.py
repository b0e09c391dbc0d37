"""Contract check and quarantine (DQ-01/02), lifecycle (DQ-05), RI (DQ-03)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from retail_spark.operators.quality import (
    contract_violations,
    lifecycle_violations,
    orphans,
    split_quarantine,
    valid_references,
)
from retail_spark.schemas import CLICKS_V1, FACT_EVENT_RAW_V1


def test_contract_codes(spark):
    df = spark.createDataFrame(
        [
            ("e1", "click", "2026-03-16T10:00:00+00:00", "g", "c", "s", "home", "open", "f", 5, None),
            ("e2", "view", "not a time", "g", None, "s", "home", "open", "f", 101, '{"scroll_depth_pct":"x","zzz":1}'),
        ],
        "event_id string, event_type string, occurred_at string, generator_instance_id string, customer_id string, "
        "session_id string, page string, action string, flow_id string, scroll_depth_pct long, _rescued_data string",
    )
    out = {r.event_id: r.violations for r in contract_violations(df, CLICKS_V1).collect()}
    assert out["e1"] == []
    assert out["e2"] == [
        "const:event_type", "format:occurred_at", "required:customer_id",
        "type:scroll_depth_pct", "maximum:scroll_depth_pct", "unexpected:zzz",
    ]


def test_producer_extra_allowed_unless_strict(spark):
    df = spark.createDataFrame([("e1", '{"warehouse_id":"WH-1"}')], "event_id string, _rescued_data string")
    lax = contract_violations(df, FACT_EVENT_RAW_V1).first().violations
    strict = contract_violations(df, FACT_EVENT_RAW_V1, strict=True).first().violations
    assert "unexpected:warehouse_id" not in lax and "unexpected:warehouse_id" in strict


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None, " "]), st.sampled_from(["click", "view"])), min_size=1, max_size=12))
def test_quarantine_partitions_input(spark, recs):
    df = spark.createDataFrame(recs, "event_id string, event_type string")
    checked = contract_violations(df, CLICKS_V1)
    valid, bad = split_quarantine(checked)
    assert valid.count() + bad.count() == len(recs)
    assert valid.where("event_id IS NULL").count() == 0


def test_lifecycle_out_of_order_and_cancel(spark):
    ev = spark.createDataFrame(
        [("o1", "order_placed", "2026-03-16 10:00:00"), ("o1", "shipment_created", "2026-03-16 09:00:00"),
         ("o2", "order_placed", "2026-03-16 10:00:00"), ("o2", "order_cancelled", "2026-03-16 11:00:00"),
         ("o2", "shipment_created", "2026-03-16 12:00:00"), ("o3", "order_placed", "2026-03-16 10:00:00")],
        "order_id string, event_type string, event_ts string",
    )
    out = {r.order_id: (r.out_of_order, r.shipped_after_cancel) for r in lifecycle_violations(ev).collect()}
    assert out == {"o1": (True, False), "o2": (False, True), "o3": (False, False)}


def test_orphans_and_valid_references(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a",)], "id string")
    assert [r.k for r in orphans(fact, dim, "k", "id").collect()] == ["b"]
    assert [r.k for r in valid_references(fact, dim, "k", "id").collect()] == ["a"]
