"""Driver tables -> canonical raw/Silver shapes.

The driver's parquet tables (TPC-H-like orders/lineitem plus an ``events``
stream) stand in for the landed retail events. Each adapter is a projection
(and at most a grouped aggregation) over whole tables, so the registered
queries run the production operators over data that grows with the scale
factor. Mappings:

* ``events``: event_type vocabulary signup -> session_started, view ->
  product_view, click -> add_to_cart, purchase -> order_placed, error ->
  support_ticket_created; customer = user_id, product = props ``k``;
  sign-ups carry a channel, purchases carry their amount as an order.
* ``orders`` + ``lineitem``: order_placed facts (amounts from the lines),
  per-line shipment / return events, purchases and transactions.
* ``part`` / ``customer``: product and customer master data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.operators.dims import ACQUISITION_CHANNELS
from retail_spark.session import discard, shared_path, stash
from retail_spark.sources.tables import read_table
from retail_spark.streaming.windows import sessionize

# Mapping of the driver event types onto the fact vocabulary,
# ticket statuses by props k (cycled), transaction status by order status,
# country code by region key, and the active-product size limit.
EVENT_VOCAB = {
    "signup": "session_started",
    "view": "product_view",
    "click": "add_to_cart",
    "purchase": "order_placed",
    "error": "support_ticket_created",
}
TICKET_STATUSES = ("new", " OPEN ", "Pending", "resolved", "CLOSED", "  ")
ORDER_STATUS_TO_PAYMENT = {"F": "paid", "P": "pending", "O": "declined"}
REGION_COUNTRY = {0: "BR", 1: "US", 2: "CL", 3: "MX", 4: "DE"}
ACTIVE_MAX_SIZE = 45


def _map(mapping: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def _pick(values: tuple[str, ...], k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(k, F.lit(len(values))) + 1).cast("int"))


def props_k(props: Column | None = None) -> Column:
    return F.get_json_object(F.col("props") if props is None else props, "$.k").cast("int")


def events_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw fact_event_raw records (strings, like landed JSON)."""
    ev = read_table(spark, sf_dir, "events")
    k = props_k()
    channel = _pick(ACQUISITION_CHANNELS, k)
    vtxt = F.col("value").cast("string")
    attrs = (
        F.when(
            F.col("event_type") == "signup",
            F.concat(F.lit('{"k": '), k.cast("string"), F.lit(', "channel": "'), channel, F.lit('", "source": " Web "}')),
        )
        .when(
            F.col("event_type") == "purchase",
            F.concat(F.lit('{"k": '), k.cast("string"), F.lit(', "gross_amount": '), vtxt, F.lit(', "net_amount": '), vtxt,
                     F.lit(', "discount_amount": 0}')),
        )
        .otherwise(F.col("props"))
    )
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("event_ts"),
        _map(EVENT_VOCAB, F.col("event_type")).alias("event_type"),
        F.lit(None).cast("string").alias("session_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        k.cast("string").alias("product_id"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("E"), F.col("event_id").cast("string"))).alias("order_id"),
        F.lit(" Desktop ").alias("device_type"),
        F.lit("web").alias("platform"),
        F.lit("").alias("referrer"),
        F.lit("usd").alias("currency"),
        F.lit("1").alias("quantity"),
        vtxt.alias("unit_price"),
        attrs.alias("attributes"),
    )


def event_facts(spark: SparkSession, sf_dir: str, *, gap_minutes: int = 30) -> DataFrame:
    """Silver facts from ``events`` with gap sessions (STR-09) as session ids."""
    from retail_spark.operators.silver import transform_fact_event_raw

    silver = transform_fact_event_raw(events_input(spark, sf_dir))
    return sessionize(silver, user_column="customer_id", ts_column="event_ts", gap_minutes=gap_minutes)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part with exact decimal money columns."""
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    pt = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_retailprice"])
    return _line_money(
        li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).join(pt, F.col("l_partkey") == F.col("p_partkey"), "left")
    )


def _line_money(lines: DataFrame) -> DataFrame:
    """A line's own money columns, as exact decimals; no other table is needed for them."""
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = F.col("l_discount").cast("decimal(18,2)")
    tax = F.col("l_tax").cast("decimal(18,2)")
    return lines.select(
        "*",
        ext.alias("line_amount"),
        (ext * disc).cast("decimal(18,2)").alias("line_discount"),
        ((ext - (ext * disc).cast("decimal(18,2)")) * tax).cast("decimal(18,2)").alias("line_tax"),
    )


def _order_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: amounts summed from its lines (one grouped
    aggregation, combined map-side) plus customer segment and nation."""
    per_order = _line_money(read_table(spark, sf_dir, "lineitem")).groupBy("l_orderkey").agg(
        F.sum("line_amount").alias("gross_amount"),
        F.sum("line_discount").alias("discount_amount"),
        F.sum("line_tax").alias("tax_amount"),
        F.sum("l_quantity").cast("int").alias("item_count"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("line_amount") - F.col("line_discount"))).alias("refund_amount"),
    )
    od = read_table(spark, sf_dir, "orders")
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    na = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (
        od.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(cu, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(na, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )


_ZERO = "decimal(18,2)"


def _order_fact_struct() -> Column:
    zero = F.lit(0).cast(_ZERO)
    g, d, t = (F.coalesce(c, zero) for c in ("gross_amount", "discount_amount", "tax_amount"))
    return F.struct(
        F.lit("order_placed").alias("event_type"),
        g.alias("gross_amount"),
        d.alias("discount_amount"),
        t.alias("tax_amount"),
        zero.alias("shipping_amount"),
        (g - d + t).cast(_ZERO).alias("net_amount"),
        F.lit(None).cast(_ZERO).alias("refund_amount"),
    )


def _return_fact_struct() -> Column:
    none = F.lit(None).cast(_ZERO)
    return F.struct(
        F.lit("return_completed").alias("event_type"),
        none.alias("gross_amount"),
        none.alias("discount_amount"),
        none.alias("tax_amount"),
        none.alias("shipping_amount"),
        none.alias("net_amount"),
        F.col("refund_amount").cast(_ZERO).alias("refund_amount"),
    )


def _facts(rollup: DataFrame, facts: Column) -> DataFrame:
    """Order attributes + one row per element of the ``facts`` array."""
    return rollup.select(
        F.col("o_orderdate").alias("event_ts"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("campaign_id"),
        F.lower("c_mktsegment").alias("customer_segment_seed"),
        F.col("n_name").alias("nation"),
        F.col("o_orderstatus").alias("order_status"),
        F.year("o_orderdate").alias("order_year"),
        F.explode(facts).alias("f"),
    ).select(
        "f.event_type", "event_ts", "order_id", "customer_id", "campaign_id", "customer_segment_seed", "nation",
        "order_status", "order_year", "f.gross_amount", "f.discount_amount", "f.tax_amount", "f.shipping_amount",
        "f.net_amount", "f.refund_amount",
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_placed facts: one row per order."""
    return _facts(_order_rollup(spark, sf_dir), F.array(_order_fact_struct()))


def return_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """return_completed facts: per order with returned (flag R) lines,
    refund = Σ (line - discount) of those lines."""
    rollup = _order_rollup(spark, sf_dir).where(F.col("refund_amount").isNotNull())
    return _facts(rollup, F.array(_return_fact_struct()))


def sales_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_placed + return_completed facts from a single pass: each order
    row is exploded into its order fact and, when it has returned lines, its
    return fact (no second scan, no union)."""
    facts = F.array_compact(
        F.array(_order_fact_struct(), F.when(F.col("refund_amount").isNotNull(), _return_fact_struct()))
    )
    return _facts(_order_rollup(spark, sf_dir), facts)


def line_lifecycle_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line: a shipment_delivered event and, for returned lines (flag R),
    a return_requested event; carries the line's brand."""
    lines = order_lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("p_brand").alias("brand"), "l_returnflag", "l_shipdate"
    )
    delivered = lines.select("order_id", "brand", F.lit("shipment_delivered").alias("event_type"), F.col("l_shipdate").alias("event_ts"))
    returned = lines.where(F.col("l_returnflag") == "R").select(
        "order_id", "brand", F.lit("return_requested").alias("event_type"), F.col("l_shipdate").alias("event_ts")
    )
    return delivered.unionByName(returned)


#: Lines that ``_purchase_lines`` joins with their parts at once.
LINES = 50_000_000


def _purchase_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order, its customer and their part, kept in files.

    Customers come to orders, which are fewer, and orders to lines; these lie in
    files by part, some parts to a slice, and slices get their parts one after
    another: at most a slice's lines are in a wide shuffle at once.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                "l_discount", "l_tax", "l_returnflag"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    na = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    pt = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_retailprice"])
    named = cu.join(na, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_mktsegment", "n_name")
    orders = od.join(named, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")
    lines = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    top, slices = shared_path(spark, "purchases", unique=True), max(1, math.ceil(li.count() / LINES))
    slice_of = lambda key: F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(slices)).cast("int")
    lines = stash(lines.withColumn("slice", slice_of("l_partkey")), f"{top}/lines", partition_by="slice")
    pt, found = pt.withColumn("slice", slice_of("p_partkey")), []
    for n in range(slices):
        part = pt.where(F.col("slice") == n).drop("slice")
        mine = lines.where(F.col("slice") == n).drop("slice").join(part, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey")
        stash(mine, f"{top}/joined/{n}")
        found.append(f"{top}/joined/{n}")
        discard(spark, f"{top}/lines/slice={n}")
    return spark.read.schema(mine.schema).parquet(*found)


def purchases_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as raw purchase records (strings, padded/cased)."""
    j = _line_money(_purchase_lines(spark, sf_dir))
    s = lambda c: F.col(c).cast("string")
    return j.select(
        F.concat_ws("-", s("l_orderkey"), s("l_linenumber"), s("l_partkey"), s("l_suppkey")).alias("event_id"),
        F.lit("Purchase ").alias("event_type"),
        s("o_orderdate").alias("occurred_at"),
        F.concat(F.lit("gen-"), s("l_suppkey")).alias("generator_instance_id"),
        s("o_custkey").alias("customer_id"),
        F.lower("n_name").alias("customer_country"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("customer_segment"),
        F.concat(F.lit("s-"), s("o_custkey")).alias("session_id"),
        s("l_orderkey").alias("order_id"),
        s("l_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), s("l_partkey")).alias("product_sku"),
        F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("product_brand"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        s("p_retailprice").alias("unit_price"),
        s("l_extendedprice").alias("amount"),
        s("line_discount").alias("discount_amount"),
        (F.col("l_discount").cast("decimal(5,2)") * 100).cast("string").alias("discount_pct"),
        F.when(F.col("l_returnflag") == "R", F.lit(" ret ")).alias("coupon_code"),
        F.lit("usd").alias("currency"),
        F.lit(None).cast("string").alias("order_total_amount"),
        s("l_linenumber").alias("order_item_index"),
        F.lit(None).cast("string").alias("order_item_count"),
        F.concat(F.lit("f-"), s("l_orderkey")).alias("flow_id"),
        F.lower("o_orderpriority").alias("channel"),
        F.col("o_orderpriority").alias("campaign_id"),
        F.lit("").alias("source_medium"),
        F.lit("Desktop").alias("device_type"),
        (F.col("l_linenumber") == 1).alias("is_first_purchase"),
        F.lit(None).cast("string").alias("cross_sell_source"),
    )


def transactions_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as raw payment transactions (F -> paid, P -> pending, O -> declined)."""
    od = read_table(spark, sf_dir, "orders")
    s = lambda c: F.col(c).cast("string")
    return od.select(
        F.concat(F.lit("T"), s("o_orderkey")).alias("event_id"),
        F.lit(" TRANSACTION").alias("event_type"),
        s("o_orderdate").alias("occurred_at"),
        F.lit("gen-1").alias("generator_instance_id"),
        s("o_custkey").alias("customer_id"),
        F.concat(F.lit("s-"), s("o_custkey")).alias("session_id"),
        F.concat(F.lit("tx-"), s("o_orderkey")).alias("transaction_id"),
        s("o_orderkey").alias("order_id"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("payment_method"),
        F.upper(_map(ORDER_STATUS_TO_PAYMENT, F.col("o_orderstatus"))).alias("status"),
        s("o_totalprice").alias("amount"),
        F.concat(F.lit("f-"), s("o_orderkey")).alias("flow_id"),
    )


def tickets_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """error events as raw support tickets; status cycles over props k."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    k = props_k()
    return ev.select(
        F.concat(F.lit("TK"), F.col("event_id").cast("string")).alias("event_id"),
        F.lit("support_ticket").alias("event_type"),
        F.col("ts").cast("string").alias("occurred_at"),
        F.concat(F.lit("ticket-"), F.col("event_id").cast("string")).alias("ticket_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit(" Error ").alias("category"),
        F.when(F.col("value") >= 50, "HIGH").otherwise(" low").alias("priority"),
        _pick(TICKET_STATUSES, k).alias("status"),
    )


def clicks_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """view/click events as raw click records."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click"))
    k = props_k()
    is_view = F.col("event_type") == "view"
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.lit("Click").alias("event_type"),
        F.col("ts").cast("string").alias("occurred_at"),
        F.lit("gen-1").alias("generator_instance_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(is_view, F.lit(" Product ")).otherwise(F.lit("search")).alias("page"),
        F.upper("event_type").alias("action"),
        F.when(is_view, k.cast("string")).alias("product_id"),
        F.when(~is_view, F.concat(F.lit(" q"), k.cast("string"))).alias("search_query"),
        F.when(k >= 50, F.lit("")).otherwise(F.concat(F.lit("c-"), k.cast("string"))).alias("campaign_id"),
        F.col("props").alias("search_filters"),
        k.cast("string").alias("scroll_depth_pct"),
        F.lit("true").alias("is_logged_in"),
        F.col("user_id").cast("string").alias("session_elapsed_ms"),
        k.cast("string").alias("product_impression_count"),
        F.to_date("ts").cast("string").alias("ingest_date"),
    )
