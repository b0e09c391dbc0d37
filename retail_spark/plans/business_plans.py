"""Registered plans: refunds by channel, daily KPI cube, discount allocation,
references, line and shipping rules, and the whole order lifecycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.operators import daily as DK
from retail_spark.operators import dims as D
from retail_spark.operators import gold as G
from retail_spark.operators import quality as Q
from retail_spark.plans import adapters as A
from retail_spark.plans.common import Plan, finalize
from retail_spark.plans.gold_plans import LINES_SQL, products_input
from retail_spark.session import shared_path
from retail_spark.sources.tables import read_table

# ---------------------------------------------------- refunds by channel (AGG-13, JON-01)

ATTRIBUTES = ("channel", "source", "medium")


def channel_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Order and return facts; only orders carry channel, source and medium, as the producer's do."""
    placed = F.col("event_type") == G.ORDER
    priority = F.split("campaign_id", "-")
    return A.sales_facts(spark, sf).withColumns({
        "channel": F.when(placed, F.lower(priority[1])), "source": F.when(placed, priority[0]), "medium": F.when(placed, F.lower("order_status"))})


def q_net_revenue_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-13 (JON-01): refunds take their order's channel, source and medium; a last row holds the total without attribution."""
    facts = channel_facts(spark, sf)
    measures = ["orders", "net_sales", "refunds", "net_revenue", "net_merchandise"]
    parts = G.sales_kpis(G.attribute_refunds(facts, attrs=ATTRIBUTES), by=ATTRIBUTES).select(*ATTRIBUTES, F.lit(False).alias("is_total"), *measures)
    total = G.sales_kpis(facts).select(*[F.lit(None).cast("string").alias(a) for a in ATTRIBUTES], F.lit(True).alias("is_total"), *measures)
    return finalize(parts.unionByName(total))


NET_REVENUE_BY_CHANNEL_SQL = """
WITH l AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS a,
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS d FROM lineitem),
l2 AS (SELECT *, CAST((a - d) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS t FROM l),
p AS (SELECT l_orderkey, SUM(a) AS g, SUM(d) AS d, SUM(t) AS t, SUM(CASE WHEN l_returnflag = 'R' THEN a - d END) AS r FROM l2 GROUP BY l_orderkey),
o AS (SELECT o_orderkey, lower(split_part(o_orderpriority, '-', 2)) AS channel, split_part(o_orderpriority, '-', 1) AS source, lower(o_orderstatus) AS medium,
             COALESCE(g, 0) AS g, COALESCE(d, 0) AS d, COALESCE(t, 0) AS t, COALESCE(r, 0) AS r FROM orders LEFT JOIN p ON o_orderkey = l_orderkey),
s AS (SELECT channel, source, medium, GROUPING(channel) = 1 AS is_total, COUNT(DISTINCT o_orderkey) AS orders, SUM(g - d + t) AS net_sales, SUM(r) AS refunds,
             SUM(g - d) - SUM(r) AS net_merchandise FROM o GROUP BY GROUPING SETS ((channel, source, medium), ()))
SELECT channel, source, medium, is_total, orders, CAST(net_sales AS DOUBLE) AS net_sales, CAST(refunds AS DOUBLE) AS refunds,
       CAST(net_sales - refunds AS DOUBLE) AS net_revenue, CAST(net_merchandise AS DOUBLE) AS net_merchandise FROM s"""


# ------------------------------------------------------------ daily KPI cube (AGG-17)

DIMS = ("channel", "segment")
SETS = ((DK.DAY, "channel", "segment"), (DK.DAY, "channel"), (DK.DAY,), ("channel", "segment"), ("channel",), ())


def daily_facts(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as facts of the cube: purchases place orders, a tenth off where k is below 25; errors refund, by cancellation
    or, from a value of 50, by return."""
    ev = read_table(spark, sf, "events")
    k, kind = A.props_k(), F.col("event_type")
    value = F.col("value").cast("decimal(18,2)")
    off = F.when(k < 25, (value / 10).cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)"))
    placed, refund = kind == "purchase", kind == "error"
    event = F.when(refund & (F.col("value") < 50), "order_cancelled").when(refund, "return_completed").otherwise(A._map(A.EVENT_VOCAB, kind))
    return ev.select(
        F.to_date("ts").alias(DK.DAY), event.alias("event_type"), F.concat(F.lit("E"), F.col("event_id")).alias("order_id"),
        F.col("user_id").alias("customer_id"), A._pick(D.ACQUISITION_CHANNELS, k).alias("channel"),
        F.when(F.col("user_id") < 50, "vip").otherwise("regular").alias("segment"),
        F.when(placed, value).alias("gross_amount"), F.when(placed, off).alias("discount_amount"), F.when(placed, value - off).alias("net_amount"),
        F.when(refund, value).alias("refund_amount"),
    )


def q_daily_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-17: all KPIs by day, channel and segment with subtotals, from cells that were built without refunds and then
    brought up to date for the days of refunds only."""
    root, facts = shared_path(spark, "daily", unique=True), daily_facts(spark, sf)
    refund = F.col("event_type").isin(*DK.REFUNDS)
    DK.refresh(facts.where(~refund), root, dims=DIMS)
    DK.refresh(facts, root, dims=DIMS, days=facts.where(refund))
    return finalize(DK.report(spark, root, dims=DIMS, sets=SETS))


def _daily_sql() -> str:
    channels = "[" + ", ".join(f"'{c}'" for c in D.ACQUISITION_CHANNELS) + "]"
    n = len(D.ACQUISITION_CHANNELS)
    return f"""
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(CAST(value AS VARCHAR) AS DECIMAL(18,2)) AS v FROM events),
f AS (SELECT CAST(ts AS DATE) AS event_date, {channels}[((k % {n}) + {n}) % {n} + 1] AS channel, CASE WHEN user_id < 50 THEN 'vip' ELSE 'regular' END AS segment,
             event_type, value, user_id, event_id, v,
             CASE WHEN k < 25 THEN CAST(CAST((CAST(v * 100 AS BIGINT) + 5) // 10 AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS off FROM e),
c AS (
  SELECT event_date, channel, segment, CAST(GROUPING(event_date, channel, segment) AS INTEGER) AS grouping_level, COUNT(*) AS events,
         COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN event_id END) AS orders,
         COUNT(*) FILTER (event_type = 'error' AND value >= 50) AS returns,
         COALESCE(SUM(v) FILTER (event_type = 'purchase'), 0) AS gmv, COALESCE(SUM(off) FILTER (event_type = 'purchase'), 0) AS discount,
         COALESCE(SUM(v - off) FILTER (event_type = 'purchase'), 0) AS net_sales, COALESCE(SUM(v) FILTER (event_type = 'error'), 0) AS refunds,
         COUNT(DISTINCT user_id) AS customers
  FROM f GROUP BY GROUPING SETS ((event_date, channel, segment), (event_date, channel), (event_date), (channel, segment), (channel), ()))
SELECT event_date, channel, segment, grouping_level, CAST(events AS BIGINT) AS events, orders, CAST(returns AS BIGINT) AS returns, CAST(gmv AS DOUBLE) AS gmv,
       CAST(discount AS DOUBLE) AS discount, CAST(net_sales AS DOUBLE) AS net_sales, CAST(refunds AS DOUBLE) AS refunds, customers,
       CAST(gmv AS DOUBLE) / NULLIF(orders, 0) AS aov, CAST(net_sales - refunds AS DOUBLE) AS net_revenue,
       CAST(discount AS DOUBLE) / NULLIF(CAST(gmv AS DOUBLE), 0) AS discount_rate FROM c"""


# ------------------------------------------------------- discount allocation (AGG-15)

def _allocated_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with its part of the order's discount; the order's is what its lines' rates come to together."""
    lines = A.order_lines(spark, sf).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").cast("int").alias("quantity"), "line_amount", "line_discount", F.year("o_orderdate").alias("order_year"), F.col("p_brand").alias("brand"))
    orders = lines.groupBy("order_id").agg(F.sum("line_discount").alias("discount_amount"))
    return G.allocate_discount(lines, orders, sort=("line_number", "part", "supplier", "line_amount"))


def q_discount_allocation(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-15: every line's part of its order's discount, in whole cents that add up to it."""
    return finalize(_allocated_lines(spark, sf).select("order_id", "line_number", "part", "supplier", "line_amount", "allocated_discount"))


def q_allocated_margin(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-15: gross margin by brand, net of allocated discounts."""
    lines = _allocated_lines(spark, sf).withColumn("product_id", F.col("part").cast("string"))
    return finalize(G.gross_margin(lines, D.dim_products(products_input(spark, sf)), by=["brand"]))


ALLOCATED_SQL = f"""{LINES_SQL},
c AS (SELECT *, CAST(line_amount * 100 AS HUGEINT) AS own, SUM(CAST(line_discount * 100 AS HUGEINT)) OVER (PARTITION BY l_orderkey) AS cents,
             SUM(CAST(line_amount * 100 AS HUGEINT)) OVER (PARTITION BY l_orderkey) AS al FROM lines),
q AS (SELECT *, cents * own // al AS part, cents * own % al AS rest FROM c),
r AS (SELECT *, cents - SUM(part) OVER (PARTITION BY l_orderkey) AS spare,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY rest DESC, l_linenumber, l_partkey, l_suppkey, line_amount) AS place FROM q),
allocated AS (SELECT *, CAST(CAST(part + CASE WHEN place <= spare THEN 1 ELSE 0 END AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)) AS allocated_discount FROM r)"""

DISCOUNT_ALLOCATION_SQL = f"""WITH {ALLOCATED_SQL}
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS part, l_suppkey AS supplier, CAST(line_amount AS DOUBLE) AS line_amount,
       CAST(allocated_discount AS DOUBLE) AS allocated_discount FROM allocated"""

ALLOCATED_MARGIN_SQL = f"""WITH {ALLOCATED_SQL},
cost AS (SELECT p_partkey, p_brand, CAST(ROUND(CAST(p_retailprice * {D.COST_RATIO} AS DECIMAL(18,4)), 2) AS DECIMAL(18,2)) AS cost FROM part),
j AS (SELECT a.*, b.p_brand AS brand, cost FROM allocated a LEFT JOIN cost b ON a.l_partkey = b.p_partkey),
s AS (SELECT brand, SUM(line_amount - allocated_discount) AS n, SUM(CAST(l_quantity AS INTEGER) * COALESCE(cost, 0)) AS c FROM j GROUP BY brand)
SELECT brand, CAST(n AS DOUBLE) AS net_line_revenue, CAST(c AS DOUBLE) AS cogs, CAST(n - c AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) AS gross_margin FROM s"""


# ------------------------------------------------------------ references (DQ-03)

def q_reference_report(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-03: orders, active parts and suppliers in credit as references of the order lines."""
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"])
    parts = read_table(spark, sf, "part", ["p_partkey", "p_size"]).where(F.col("p_size") <= A.ACTIVE_MAX_SIZE)
    suppliers = read_table(spark, sf, "supplier", ["s_suppkey", "s_acctbal"]).where("s_acctbal >= 0")
    return Q.reference_report(lines, {
        "order": ("l_orderkey", read_table(spark, sf, "orders", ["o_orderkey"]), "o_orderkey"),
        "active_part": ("l_partkey", parts, "p_partkey"), "supplier_in_credit": ("l_suppkey", suppliers, "s_suppkey")})


def _reference_sql() -> str:
    each = []
    for name, key, there in (("order", "l_orderkey", "SELECT o_orderkey FROM orders"), ("active_part", "l_partkey", f"SELECT p_partkey FROM part WHERE p_size <= {A.ACTIVE_MAX_SIZE}"),
                             ("supplier_in_credit", "l_suppkey", "SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0")):
        missing = f"{key} IS NOT NULL AND {key} NOT IN ({there})"
        each.append(f"""SELECT '{name}' AS reference, COUNT(*) AS rows, COUNT(*) FILTER ({key} IS NULL) AS null_rows, COUNT(*) FILTER ({missing}) AS orphan_rows,
       COUNT(DISTINCT {key}) AS keys, COUNT(DISTINCT CASE WHEN {missing} THEN {key} END) AS orphan_keys FROM lineitem""")
    return "\nUNION ALL ".join(each)


# --------------------------------------------- amounts, shipping, lead times (DQ-04, DQ-08)

def q_line_amount_checks(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-04: line amount against quantity times the unit price in cents."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"])
    lines = li.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("quantity"),
                      F.col("l_extendedprice").cast("decimal(18,2)").alias("line_amount"))
    lines = lines.withColumn("unit_price", F.round(F.col("line_amount") / F.col("quantity"), 2).cast("decimal(18,2)"))
    return finalize(Q.line_amount_checks(lines))


LINE_AMOUNT_CHECKS_SQL = """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS quantity, CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(18,2)) AS line_amount FROM lineitem),
c AS (SELECT *, CAST(line_amount * 100 AS BIGINT) AS cents FROM l),
u AS (SELECT *, (2 * cents + quantity) // (2 * quantity) AS unit FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, quantity, CAST(line_amount AS DOUBLE) AS line_amount, unit / 100.0 AS unit_price,
       quantity * unit / 100.0 AS expected_amount, abs(cents - quantity * unit) <= 1 AS line_ok FROM u"""


def q_order_shipping_checks(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-08: orders with shipping by priority: urgent ones pay 9.99, the rest nothing; from 120.00 it should be free."""
    paid = F.when(F.col("campaign_id") == "1-URGENT", F.lit("9.99")).otherwise(F.lit("0.00")).cast("decimal(18,2)")
    orders = A.order_facts(spark, sf).withColumn("shipping_amount", paid)
    # net amounts of high priority orders leave the shipping out
    orders = orders.withColumn("net_amount", F.col("net_amount") + F.when(F.col("order_status") == "F", F.col("shipping_amount")).otherwise(0))
    return finalize(Q.order_amount_checks(orders).select("order_id", "shipping_amount", "tax_ok", "net_ok", "shipping_rule_ok"))


ORDER_SHIPPING_CHECKS_SQL = """
WITH l AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS a,
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS d FROM lineitem),
l2 AS (SELECT *, CAST((a - d) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS t FROM l),
p AS (SELECT l_orderkey, SUM(a) AS g, SUM(d) AS d, SUM(t) AS t FROM l2 GROUP BY l_orderkey),
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, COALESCE(g, 0) AS g, COALESCE(d, 0) AS d, COALESCE(t, 0) AS t, o_orderstatus,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 9.99 ELSE 0 END AS s FROM orders LEFT JOIN p ON o_orderkey = l_orderkey),
n AS (SELECT *, g - d + t + CASE WHEN o_orderstatus = 'F' THEN s ELSE 0 END AS net FROM o)
SELECT order_id, CAST(s AS DOUBLE) AS shipping_amount, abs(t - ROUND((g - d) * 0.08, 2)) <= 0.01 AS tax_ok, abs(net - (g - d + s + t)) <= 0.01 AS net_ok,
       (s = 0) = (g >= 120.00) AS shipping_rule_ok FROM n"""


def q_lead_time_checks(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-08: reported lead times (days by quantity) against delivery less first shipment of the order."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"])
    key, at = F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("timestamp")
    shipments = li.select(key, at.alias("event_ts"))
    days = F.ceil(F.col("l_quantity") / 10).cast("int")
    deliveries = li.select(key, "l_linenumber", "l_partkey", (at + F.make_dt_interval(days=days)).alias("event_ts"), (days * 24.0).alias("delivery_lead_time_hours"))
    return finalize(Q.lead_time_check(deliveries, shipments))


LEAD_TIME_CHECKS_SQL = """
WITH s AS (SELECT l_orderkey, MIN(l_shipdate) AS shipped_ts FROM lineitem GROUP BY l_orderkey),
d AS (SELECT l_orderkey AS order_id, l_linenumber, l_partkey, l_shipdate + to_days(CAST(ceil(l_quantity / 10) AS INTEGER)) AS event_ts,
             CAST(ceil(l_quantity / 10) AS INTEGER) * 24.0 AS delivery_lead_time_hours FROM lineitem),
a AS (SELECT d.*, shipped_ts, (epoch_us(event_ts) - epoch_us(shipped_ts)) / 3600e6 AS actual_lead_time_hours FROM d JOIN s ON order_id = l_orderkey)
SELECT order_id, l_linenumber, l_partkey, event_ts, CAST(delivery_lead_time_hours AS DOUBLE) AS delivery_lead_time_hours, shipped_ts, actual_lead_time_hours,
       abs(actual_lead_time_hours - delivery_lead_time_hours) <= 1.0 AS lead_time_ok FROM a"""


# -------------------------------------------------------------- lifecycle (DQ-05)

# Stages of the made-up lifecycle, minutes after the order date or days after the ship date.
ORDER_STAGES = {"payment_attempted": -20, "payment_succeeded": -10, "order_placed": 0}
LINE_STAGES = {"shipment_created": 0, "shipment_delivered": 3, "return_requested": 10, "return_completed": 20}


def lifecycle_stage_events(spark: SparkSession, sf: str) -> DataFrame:
    """All nine stages of the orders: checkouts that name their cart only, payments of unspecified priority that name their
    order only, late checkouts of low priority, cancellations of pending orders, and each line's shipment and return."""
    none = F.lit(None).cast("string")

    def stage(name: str, at: Column, order: Column, cart: Column, when: Column | None = None) -> Column:
        made = F.struct(F.lit(name).alias("event_type"), at.alias("event_ts"), order.alias("order_id"), cart.alias("cart_id"))
        return made if when is None else F.when(when, made)

    od = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    order, cart, at = F.col("o_orderkey").cast("string"), F.concat(F.lit("C"), F.col("o_orderkey")), F.col("o_orderdate").cast("timestamp")
    minutes = lambda n: F.make_dt_interval(mins=n)
    late = F.when(F.col("o_orderpriority") == "5-LOW", 30).otherwise(-30)
    stages = [stage("checkout_started", at + minutes(late), none, cart)]
    pay_cart = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", cart)
    stages += [stage(n, at + minutes(F.lit(m)), order, cart if n == G.ORDER else pay_cart) for n, m in ORDER_STAGES.items()]
    stages += [stage("order_cancelled", at + minutes(F.lit(24 * 60)), order, none, F.col("o_orderstatus") == "P")]
    placed = od.select(F.explode(F.array_compact(F.array(*stages))).alias("e")).select("e.*")
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate", "l_returnflag"])
    line, shipped = F.col("l_orderkey").cast("string"), F.col("l_shipdate").cast("timestamp")
    stages = [stage(n, shipped + F.make_dt_interval(days=F.lit(d)), line, none, F.col("l_returnflag") == "R" if n.startswith("return") else None) for n, d in LINE_STAGES.items()]
    return placed.unionByName(li.select(F.explode(F.array_compact(F.array(*stages))).alias("e")).select("e.*"))


def q_lifecycle_stages(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-05: checkouts find their order through the cart, then every stage of every order is checked."""
    return finalize(Q.lifecycle_violations(Q.resolve_orders(lifecycle_stage_events(spark, sf))))


def _lifecycle_sql() -> str:
    names = (*Q.LIFECYCLE_STAGES, "order_cancelled")
    order = {"checkout_started": "o_orderdate + CASE WHEN o_orderpriority = '5-LOW' THEN INTERVAL 30 MINUTE ELSE INTERVAL (-30) MINUTE END",
             "order_cancelled": "CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY END",
             **{n: f"o_orderdate + INTERVAL ({m}) MINUTE" for n, m in ORDER_STAGES.items()}}
    line = {n: f"MIN({'CASE WHEN l_returnflag = ' + chr(39) + 'R' + chr(39) + ' THEN l_shipdate END' if n.startswith('return') else 'l_shipdate'}) + INTERVAL ({d}) DAY"
            for n, d in LINE_STAGES.items()}
    pairs = [f"COALESCE({b}_ts < {a}_ts, false)" for i, a in enumerate(Q.LIFECYCLE_STAGES) for b in Q.LIFECYCLE_STAGES[i + 1:]]
    return f"""
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, {', '.join(f'{e} AS {n}_ts' for n, e in order.items())} FROM orders),
l AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, {', '.join(f'{e} AS {n}_ts' for n, e in line.items())} FROM lineitem GROUP BY l_orderkey),
per AS (SELECT order_id, {', '.join(f'{n}_ts' for n in names)} FROM o FULL JOIN l USING (order_id))
SELECT *, ({' OR '.join(pairs)}) AS out_of_order, COALESCE(shipment_created_ts > order_cancelled_ts, false) AS shipped_after_cancel FROM per"""


PLANS = {
    "net_revenue_by_channel": Plan(q_net_revenue_by_channel, NET_REVENUE_BY_CHANNEL_SQL, "AGG-13 JON-01"),
    "daily_kpis": Plan(q_daily_kpis, _daily_sql(), "AGG-17 AGG-04..06 AGG-14"),
    "discount_allocation": Plan(q_discount_allocation, DISCOUNT_ALLOCATION_SQL, "AGG-15"),
    "allocated_margin": Plan(q_allocated_margin, ALLOCATED_MARGIN_SQL, "AGG-15 JON-02"),
    "reference_report": Plan(q_reference_report, _reference_sql(), "DQ-03 JON-03"),
    "line_amount_checks": Plan(q_line_amount_checks, LINE_AMOUNT_CHECKS_SQL, "DQ-04"),
    "order_shipping_checks": Plan(q_order_shipping_checks, ORDER_SHIPPING_CHECKS_SQL, "DQ-04 DQ-08"),
    "lead_time_checks": Plan(q_lead_time_checks, LEAD_TIME_CHECKS_SQL, "DQ-08"),
    "lifecycle_stages": Plan(q_lifecycle_stages, _lifecycle_sql(), "DQ-05 JON-04"),
}
