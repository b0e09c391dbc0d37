"""Rows with NULL keys, groups without orders, and sets of every size."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from retail_spark.operators import gold as G
from retail_spark.operators import graph as GR
from retail_spark.operators.quality import order_amount_checks
from retail_spark.streaming.windows import session_gaps, sessionize


def test_null_keys_are_kept(spark):
    ev = spark.createDataFrame([("u", "2026-01-01 00:00:00", "a"), (None, "2026-01-01 00:10:00", "b"), ("u", None, "c")],
                               "customer_id string, t string, event_id string").withColumn("event_ts", F.to_timestamp("t"))
    assert sorted(r.event_id for r in sessionize(ev).collect()) == ["a", "b", "c"]
    gaps = session_gaps(ev.withColumnRenamed("customer_id", "session_id"))
    assert sorted(r.event_id for r in gaps.collect()) == ["a", "b", "c"]
    lines = spark.createDataFrame([("o", 1), ("o", None), (None, 2)], "order_id string, line_number int")
    got = {(r.order_id, r.line_number): (r.order_item_index, r.order_item_count) for r in G.line_positions(lines).collect()}
    assert got == {("o", None): (1, 2), ("o", 1): (2, 2), (None, 2): (1, 1)}


def _facts(spark, rows):
    return spark.createDataFrame(rows, "event_type string, order_id string, session_id string, channel string, gross double, discount double, refund double").select(
        "event_type", "order_id", "session_id", "channel", F.col("gross").cast("decimal(18,2)").alias("gross_amount"),
        F.col("discount").cast("decimal(18,2)").alias("discount_amount"), F.col("gross").cast("decimal(18,2)").alias("net_amount"),
        F.col("refund").cast("decimal(18,2)").alias("refund_amount"))


def test_refunds_net_per_channel(spark):
    ev = _facts(spark, [("order_placed", "1", "s", "email", 108.0, None, None), ("return_completed", "1", "s", None, None, None, 108.0),
                        ("return_completed", None, None, None, None, None, 5.0)])
    total = G.sales_kpis(ev).first()
    parts = {r.channel: r for r in G.sales_kpis(G.attribute_refunds(ev), by=["channel"]).collect()}
    assert parts["email"].net_revenue == 0 and parts[None].net_revenue == Decimal("-5.00")
    assert sum(r.net_revenue for r in parts.values()) == total.net_revenue == -5
    assert total.net_merchandise == -5 and parts[None].net_merchandise == -5


def test_events_without_session_are_no_session(spark):
    ev = spark.createDataFrame([(None, "session_started", "email"), (None, "order_placed", None), ("s", "session_started", "email")],
                               "session_id string, event_type string, channel string").selectExpr(
        "*", "timestamp'2026-01-01' event_ts", "'c' customer_id", "'x' customer_segment_seed")
    row = G.conversion_rate(ev).first()
    assert (row.channel, row.sessions, row.conversion_rate) == ("email", 1, 0.0)


def test_itemsets_of_every_size(spark):
    lines = spark.createDataFrame([(o, p) for o in (1, 2, 3) for p in "abcd"] + [(4, "a"), (4, "z")], "order_id int, product_id string")
    got = {tuple(r["items"]): r["freq"] for r in GR.frequent_itemsets(lines, min_count=3).collect()}
    assert len(got) == 15 and got[("a", "b", "c", "d")] == 3 and got[("a",)] == 4
    assert GR.frequent_itemsets(lines.limit(0), min_count=1).count() == 0


def test_components_converge_and_keep_lone_vertices(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(64)], "src int, dst int")
    alone = spark.createDataFrame([(99,), (None,)], "v int")
    got = {r.vertex: r.label for r in GR.connected_components(chain, vertices=alone).collect()}
    assert got == {**{k: 0 for k in range(65)}, 99: 99}
    assert GR.pagerank(chain.limit(0)).count() == 0


def test_als_on_text_ids_and_null_category(spark):
    inter = spark.createDataFrame([(f"CUST{u:03d}", f"PROD{p:03d}") for u in range(6) for p in range(u, u + 3)], "customer_id string, product_id string")
    users, items = GR.als_factors(inter, rank=4, max_iter=2)
    assert sorted(r.customer_id for r in users.collect()) == [f"CUST{u:03d}" for u in range(6)]
    assert items.count() == 8 and len(items.first().features) == 4
    products = spark.createDataFrame([("p1", None, "b"), ("p2", "c", "b")], "product_id string, category string, brand string")
    units = spark.createDataFrame([("p2", 3)], "product_id string, units int")
    got = {(r.product_id, r.related_id) for r in GR.attribute_similar(products, units).collect()}
    assert got == {("p1", "p2"), ("p2", "p1")}


def test_free_shipping_goes_by_the_cart_value(spark):
    o = spark.createDataFrame([(125.0, 12.5, 0.0), (119.0, 0.0, 0.0)], "g double, d double, s double").select(
        *[F.col(c).cast("decimal(18,2)").alias(n) for c, n in (("g", "gross_amount"), ("d", "discount_amount"), ("s", "shipping_amount"))],
        F.lit(0).cast("decimal(18,2)").alias("tax_amount"), F.lit(0).cast("decimal(18,2)").alias("net_amount"))
    assert [r.shipping_rule_ok for r in order_amount_checks(o).orderBy("gross_amount").collect()] == [False, True]
