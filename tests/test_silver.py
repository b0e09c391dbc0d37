"""Silver transforms (PRJ-03..08): semantics from FIXTURES.md §3-4."""

from decimal import Decimal

from retail_spark.operators.silver import (
    transform_clicks,
    transform_clicks_light,
    transform_fact_event_raw,
    transform_purchases,
    transform_support_tickets,
    transform_transactions,
)


def test_purchases_derived_amounts(spark):
    df = spark.createDataFrame(
        [
            ("e1", " Purchase ", "2026-03-16T10:00:00+00:00", None, "5", None, "2", None, " vip "),
            ("e2", "purchase", "2026-03-16T11:00:00+00:00", "10.00", "0", "3.50", "x", "true", "new"),
        ],
        "event_id string, event_type string, occurred_at string, amount string, discount_amount string, "
        "unit_price string, quantity string, is_first_purchase string, customer_segment string",
    )
    out = {r.event_id: r for r in transform_purchases(df).collect()}
    a, b = out["e1"], out["e2"]
    assert a.net_item_amount == Decimal("-5.00") and a.is_discounted is True
    assert a.is_repeat_purchase is True  # unknown first-purchase counts as repeat
    assert a.event_type == "purchase" and a.customer_segment == "vip"
    assert b.quantity is None and b.gross_item_amount == Decimal("0.00")  # malformed quantity -> NULL -> 0
    assert b.net_item_amount == Decimal("10.00") and b.is_discounted is False and b.is_repeat_purchase is False
    assert str(a.occurred_date) == "2026-03-16" and a.event_hour == 10


def test_transactions_status_groups_and_golden_rows(spark):
    df = spark.createDataFrame(
        [("t1", "authorized"), ("t2", "settled"), ("t3", " PAID "), ("t4", "Declined"), ("t5", None)],
        "event_id string, status string",
    )
    out = {r.event_id: r for r in transform_transactions(df).collect()}
    assert out["t1"].status_group == "other" and out["t2"].status_group == "other"  # observed statuses
    assert out["t3"].is_successful is True and out["t3"].status_group == "successful"
    assert out["t4"].is_failed is True and out["t4"].status_group == "failed"
    assert out["t5"].is_successful is None and out["t5"].is_failed is None and out["t5"].status_group == "other"


def test_support_ticket_flags(spark):
    df = spark.createDataFrame([("k1", " Open "), ("k2", "CLOSED"), ("k3", "  ")], "event_id string, status string")
    out = {r.event_id: r for r in transform_support_tickets(df).collect()}
    assert (out["k1"].is_open, out["k1"].is_resolved) == (True, False)
    assert (out["k2"].is_open, out["k2"].is_resolved) == (False, True)
    assert out["k3"].status is None and out["k3"].is_open is None


def test_clicks_flags_and_missing_columns(spark):
    df = spark.createDataFrame(
        [("c1", None, None, None, None), ("c2", "Search", None, "P1", '{"brand":"Orbit"}'), ("c3", "home", " shoes ", None, None)],
        "event_id string, page string, search_query string, product_id string, search_filters string",
    )
    out = {r.event_id: r for r in transform_clicks(df).collect()}
    assert out["c1"].is_search_interaction is None  # NULL page and NULL query
    assert out["c2"].is_search_interaction is True and out["c2"].has_product_context is True
    assert out["c2"].search_filters_json == '{"brand":"Orbit"}' and "search_filters" not in transform_clicks(df).columns
    assert out["c3"].is_search_interaction is True and out["c3"].search_query == "shoes"
    # columns never seen in landed data still resolve (X6)
    assert out["c1"].recommendation_model is None and out["c1"].is_recommendation_interaction is False


def test_clicks_light_variant(spark):
    df = spark.createDataFrame([("c1", "", "2026-03-16", "1", "12")], "event_id string, campaign_id string, ingest_date string, is_logged_in string, product_impression_count string")
    out = transform_clicks_light(df)
    r = out.first()
    assert r.campaign_id is None and str(r.ingest_date) == "2026-03-16" and r.is_logged_in is True
    assert "product_impression_count" not in out.columns


def test_fact_event_raw_attributes_and_amount(spark):
    df = spark.createDataFrame(
        [
            ("f1", "order_placed", '{"gross_amount": 100.00, "net_amount": 95.5, "order_items": [{"product_id": "P1"}], "query": " ", "search_query": "x"}', None, None),
            ("f2", "page_view", "{}", None, None),
            ("f3", "product_view", '{"brand": " Atlas ", "category_name": "Beauty"}', "3", "2.50"),
        ],
        "event_id string, event_type string, attributes string, quantity string, unit_price string",
    )
    out = {r.event_id: r for r in transform_fact_event_raw(df).collect()}
    assert out["f1"].event_amount == Decimal("95.50") and out["f1"].is_commerce_event is True
    assert out["f1"].order_items_json.replace(" ", "") == '[{"product_id":"P1"}]'
    assert out["f1"].search_query is None  # blank `query` hides `search_query`
    assert out["f2"].event_amount == Decimal("0.00")  # no price and no amounts
    assert out["f3"].brand == "Atlas" and out["f3"].category_name == "beauty" and out["f3"].event_amount == Decimal("7.50")


def test_fact_attributes_struct_and_string_agree(spark):
    s = spark.createDataFrame([("f1", '{"channel":"Email","cart_value":12.5}')], "event_id string, attributes string")
    st = spark.createDataFrame([("f1", ("Email", 12.5))], "event_id string, attributes struct<channel:string,cart_value:double>")
    a = transform_fact_event_raw(s).select("channel", "cart_value").first()
    b = transform_fact_event_raw(st).select("channel", "cart_value").first()
    assert tuple(a) == tuple(b) == ("email", Decimal("12.50"))


def test_batch_dedup_is_deterministic_and_keeps_earliest(spark):
    df = spark.createDataFrame(
        [("e1", "2026-03-16T10:00:05+00:00", "b"), ("e1", "2026-03-16T10:00:01+00:00", "a"), ("e2", None, "x"), ("e2", "2026-03-16T09:00:00+00:00", "y")],
        "event_id string, occurred_at string, action string",
    )
    out = {r.event_id: r.action for r in transform_clicks(df.repartition(3)).collect()}
    assert out == {"e1": "a", "e2": "y"}  # NULL timestamps sort last


def test_dedup_duplicated_keys_only_is_equivalent(spark):
    from retail_spark.streaming.dedup import earliest_per_key

    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 2, "n1"), (None, 1, "n2"), ("c", None, "q"), ("c", 4, "r")],
        "k string, t int, v string",
    )
    full = sorted((tuple(r) for r in earliest_per_key(df, ["k"], ["t"]).collect()), key=str)
    dup_only = sorted((tuple(r) for r in earliest_per_key(df, ["k"], ["t"], only_duplicated_keys=True).collect()), key=str)
    assert full == dup_only and len(full) == 4
