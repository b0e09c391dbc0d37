"""Registered Gold / dimension / window plans (AGG-01..17, DIM-01..07,
JON-01/02/07, WIN-02..06, SET-01, STR-09, SRT-01, FN-19..21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.functions.columns import stable_number
from retail_spark.operators import dims as D
from retail_spark.operators import gold as G
from retail_spark.operators.joins import within_interval
from retail_spark.streaming.windows import session_gaps
from retail_spark.plans import adapters as A
from retail_spark.plans.common import Plan, finalize, sql_case_map, sql_pick
from retail_spark.sources.tables import read_table

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# ----------------------------------------------------------- SQL building blocks

LINES_SQL = """
lines AS (
  SELECT l.*, o.*, p.p_brand, p.p_type, p.p_retailprice,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS line_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS line_discount
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey LEFT JOIN part p ON l_partkey = p_partkey),
lines2 AS (
  SELECT *, CAST((line_amount - line_discount) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS line_tax FROM lines)"""

SALES_FACTS_SQL = LINES_SQL + """,
per_order AS (
  SELECT l_orderkey, SUM(line_amount) AS g, SUM(line_discount) AS d, SUM(line_tax) AS t FROM lines2 GROUP BY l_orderkey),
ofacts AS (
  SELECT 'order_placed' AS event_type, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS campaign_id,
         lower(c_mktsegment) AS customer_segment_seed, n_name AS nation, o_orderstatus AS order_status,
         CAST(year(o_orderdate) AS INTEGER) AS order_year,
         COALESCE(g, 0) AS gross_amount, COALESCE(d, 0) AS discount_amount,
         COALESCE(g, 0) - COALESCE(d, 0) + COALESCE(t, 0) AS net_amount, CAST(NULL AS DECIMAL(18,2)) AS refund_amount
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
refunds AS (
  SELECT l_orderkey, SUM(line_amount - line_discount) AS r FROM lines2 WHERE l_returnflag = 'R' GROUP BY l_orderkey),
rfacts AS (
  SELECT 'return_completed' AS event_type, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS campaign_id,
         lower(c_mktsegment) AS customer_segment_seed, n_name AS nation, o_orderstatus AS order_status,
         CAST(year(o_orderdate) AS INTEGER) AS order_year,
         CAST(NULL AS DECIMAL(18,2)) AS gross_amount, CAST(NULL AS DECIMAL(18,2)) AS discount_amount,
         CAST(NULL AS DECIMAL(18,2)) AS net_amount, CAST(r AS DECIMAL(18,2)) AS refund_amount
  FROM refunds JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
facts AS (SELECT * FROM ofacts UNION ALL SELECT * FROM rfacts)"""


def _kpis_sql(by: list[str], cols: list[str] | None = None) -> str:
    g = ", ".join(by)
    sel = f"""
  CAST(SUM(CASE WHEN event_type = 'order_placed' THEN gross_amount END) AS DOUBLE) AS gmv,
  COUNT(DISTINCT CASE WHEN event_type = 'order_placed' THEN order_id END) AS orders,
  CAST(SUM(CASE WHEN event_type = 'order_placed' THEN discount_amount END) AS DOUBLE) AS discount,
  CAST(SUM(CASE WHEN event_type = 'order_placed' THEN net_amount END) AS DOUBLE) AS net_sales,
  CAST(COALESCE(SUM(CASE WHEN event_type IN ('order_cancelled', 'return_completed') THEN refund_amount END), 0) AS DOUBLE) AS refunds,
  CAST(SUM(CASE WHEN event_type = 'order_placed' THEN gross_amount END) AS DOUBLE)
      / NULLIF(CAST(COUNT(DISTINCT CASE WHEN event_type = 'order_placed' THEN order_id END) AS DOUBLE), 0) AS aov,
  CAST(SUM(CASE WHEN event_type = 'order_placed' THEN net_amount END)
       - COALESCE(SUM(CASE WHEN event_type IN ('order_cancelled', 'return_completed') THEN refund_amount END), 0) AS DOUBLE) AS net_revenue,
  CAST(SUM(CASE WHEN event_type = 'order_placed' THEN gross_amount END)
       - SUM(CASE WHEN event_type = 'order_placed' THEN discount_amount END)
       - COALESCE(SUM(CASE WHEN event_type IN ('order_cancelled', 'return_completed') THEN refund_amount END), 0) AS DOUBLE) AS net_merchandise,
  CAST(SUM(CASE WHEN event_type = 'order_placed' THEN discount_amount END) AS DOUBLE)
      / NULLIF(CAST(SUM(CASE WHEN event_type = 'order_placed' THEN gross_amount END) AS DOUBLE), 0) AS discount_rate"""
    inner = f"SELECT {g + ',' if g else ''} {sel} FROM facts {'GROUP BY ' + g if g else ''}"
    if cols:
        return f"WITH {SALES_FACTS_SQL}\nSELECT {', '.join(cols)} FROM ({inner})"
    return f"WITH {SALES_FACTS_SQL}\n{inner}"


# sessionised events (STR-09) in SQL: lag + running sum per user
EVENT_SESSIONS_SQL = f"""
e0 AS (
  SELECT CAST(event_id AS VARCHAR) AS eid, ts, CAST(user_id AS VARCHAR) AS uid,
         {sql_case_map('event_type', A.EVENT_VOCAB)} AS event_type, {K} AS k, value
  FROM events),
e1 AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000 THEN 1 ELSE 0 END AS new_s
  FROM e0 WINDOW w AS (PARTITION BY uid ORDER BY ts, eid)),
e2 AS (
  SELECT *, SUM(new_s) OVER (PARTITION BY uid ORDER BY ts, eid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn FROM e1),
es AS (
  SELECT *, uid || '-' || CAST(epoch_us(MIN(ts) OVER (PARTITION BY uid, sn)) // 1000000 AS VARCHAR) AS session_id,
         CASE WHEN event_type = 'session_started' THEN {sql_pick(D.ACQUISITION_CHANNELS, 'k')} END AS channel,
         CAST(k AS VARCHAR) AS product_id
  FROM e2)"""


# ----------------------------------------------------------------- sales plans

def q_gmv_orders_aov(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-04/05/06 (+13/14) by customer segment - the flagship."""
    return finalize(G.sales_kpis(A.sales_facts(spark, sf), by=["customer_segment_seed"]))


def q_net_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-13: net revenue / net merchandise by order year."""
    k = G.sales_kpis(A.sales_facts(spark, sf), by=["order_year"])
    return finalize(k.select("order_year", "net_sales", "refunds", "net_revenue", "net_merchandise"))


def q_discount_rate(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-14: discount rate by campaign (order priority)."""
    k = G.sales_kpis(A.sales_facts(spark, sf), by=["campaign_id"])
    return finalize(k.select("campaign_id", "gmv", "discount", "discount_rate"))


def campaigns_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Campaign dimension derived from the order priorities present."""
    od = read_table(spark, sf, "orders", ["o_orderpriority"])
    return od.select(F.col("o_orderpriority").alias("campaign_id")).distinct().withColumn(
        "campaign_name", F.concat(F.lit("Campaign "), F.col("campaign_id"))
    )


def q_revenue_by_campaign(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-03 + JON-02: net revenue of every campaign."""
    return finalize(G.revenue_by_campaign(A.order_facts(spark, sf), campaigns_dim(spark, sf)))


def q_top_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """SRT-01: the 3 campaigns of most net revenue."""
    return finalize(G.revenue_by_campaign(A.order_facts(spark, sf), campaigns_dim(spark, sf), top_n=3))


TOP_CAMPAIGNS_SQL = f"""WITH {SALES_FACTS_SQL}
SELECT campaign_id, CAST(SUM(net_amount) AS DOUBLE) AS revenue, COUNT(DISTINCT order_id) AS orders,
       'Campaign ' || campaign_id AS campaign_name
FROM ofacts GROUP BY campaign_id ORDER BY revenue DESC, campaign_id LIMIT 3"""


def q_kpi_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-17: GMV / orders / discount with nation and segment subtotals."""
    r = G.kpi_rollup(A.order_facts(spark, sf), ["nation", "customer_segment_seed"])
    return finalize(r.withColumn("grouping_level", F.col("grouping_level").cast("int")))


KPI_ROLLUP_SQL = f"""WITH {SALES_FACTS_SQL}
SELECT nation, customer_segment_seed, CAST(GROUPING(nation, customer_segment_seed) AS INTEGER) AS grouping_level,
       CAST(SUM(gross_amount) AS DOUBLE) AS gmv, COUNT(DISTINCT order_id) AS orders, CAST(SUM(discount_amount) AS DOUBLE) AS discount
FROM ofacts GROUP BY ROLLUP (nation, customer_segment_seed)"""


# ------------------------------------------------------------- event plans

def q_sessions_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-01 on gap sessions."""
    return finalize(G.sessions_by_channel(A.event_facts(spark, sf)))


SESSIONS_BY_CHANNEL_SQL = f"""WITH {EVENT_SESSIONS_SQL}
SELECT channel, COUNT(DISTINCT session_id) AS sessions FROM es WHERE event_type = 'session_started' GROUP BY channel"""


def q_conversion_rate(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-02 (+AGG-16, JON-01): converted sessions ÷ sessions by session channel."""
    return finalize(G.conversion_rate(A.event_facts(spark, sf), by=["channel"]))


CONVERSION_RATE_SQL = f"""WITH {EVENT_SESSIONS_SQL},
s AS (SELECT session_id, MIN(channel) AS channel, bool_or(event_type = 'order_placed') AS converted FROM es GROUP BY session_id)
SELECT channel, COUNT(*) AS sessions, COUNT(*) FILTER (WHERE converted) AS converted_sessions,
       CAST(COUNT(*) FILTER (WHERE converted) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS conversion_rate
FROM s GROUP BY channel"""


def q_sessionize(spark: SparkSession, sf: str) -> DataFrame:
    """STR-09 + AGG-16: one row per 30-minute gap session."""
    r = G.session_rollup(A.event_facts(spark, sf))
    return finalize(r)


SESSIONIZE_SQL = f"""WITH {EVENT_SESSIONS_SQL}
SELECT session_id, MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) AS events, MIN(channel) AS channel,
       CAST(NULL AS VARCHAR) AS customer_segment, MIN(uid) AS customer_id,
       COUNT(*) FILTER (WHERE event_type = 'product_view') AS product_views,
       COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_carts,
       COUNT(*) FILTER (WHERE event_type = 'checkout_started') AS checkouts,
       COUNT(*) FILTER (WHERE event_type = 'order_placed') AS orders,
       bool_or(event_type = 'order_placed') AS converted
FROM es GROUP BY session_id"""


def q_session_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-04: step order and gap to the previous event within a session."""
    events = A.event_facts(spark, sf).select("event_id", "session_id", "event_ts")
    return finalize(session_gaps(events).select("event_id", "session_id", "step_index", "gap_seconds"))


SESSION_GAPS_SQL = f"""WITH {EVENT_SESSIONS_SQL}
SELECT eid AS event_id, session_id,
       CAST(row_number() OVER w AS INTEGER) AS step_index,
       epoch_us(ts) / 1000000.0 - epoch_us(lag(ts) OVER w) / 1000000.0 AS gap_seconds
FROM es WINDOW w AS (PARTITION BY session_id ORDER BY ts, eid)"""


def q_product_views(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-07."""
    return finalize(G.product_views(A.event_facts(spark, sf)))


PRODUCT_VIEWS_SQL = f"""WITH {EVENT_SESSIONS_SQL}
SELECT product_id, COUNT(*) FILTER (WHERE event_type = 'product_view') AS product_views, CAST(0 AS BIGINT) AS product_page_views
FROM es WHERE product_id IS NOT NULL GROUP BY product_id"""


def q_view_to_cart(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-08."""
    return finalize(G.view_to_cart(A.event_facts(spark, sf)))


VIEW_TO_CART_SQL = f"""WITH {EVENT_SESSIONS_SQL},
p AS (SELECT product_id, session_id, bool_or(event_type = 'product_view') AS viewed, bool_or(event_type = 'add_to_cart') AS carted
      FROM es WHERE product_id IS NOT NULL AND event_type IN ('product_view', 'add_to_cart') GROUP BY product_id, session_id)
SELECT product_id, COUNT(*) FILTER (WHERE viewed) AS view_sessions, COUNT(*) FILTER (WHERE carted) AS cart_sessions,
       CAST(COUNT(*) FILTER (WHERE carted) AS DOUBLE) / NULLIF(CAST(COUNT(*) FILTER (WHERE viewed) AS DOUBLE), 0) AS view_to_cart_rate
FROM p GROUP BY product_id"""


# -------------------------------------------------------------- order plans

def order_item_events(spark: SparkSession, sf: str) -> DataFrame:
    """order_placed facts carrying ``order_items_json`` (one item per line)."""
    lines = A.order_lines(spark, sf)
    item = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
        F.col("line_amount").alias("line_amount"),
    )
    return lines.select(
        F.lit("order_placed").alias("event_type"),
        F.col("o_orderdate").alias("event_ts"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.to_json(F.array(item)).alias("order_items_json"),
    )


def q_product_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-09 + FN-21: explode order item JSON, revenue and units per product."""
    return finalize(G.product_revenue(order_item_events(spark, sf)))


PRODUCT_REVENUE_SQL = """
SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units, COUNT(DISTINCT CAST(l_orderkey AS VARCHAR)) AS orders
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey"""


def inventory_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem rows as inventory snapshots: warehouse = supplier, product =
    part, time = ship date; returned lines hold one unit back."""
    li = read_table(spark, sf, "lineitem", ["l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_linenumber", "l_returnflag"])
    q = F.col("l_quantity").cast("int")
    return li.select(
        F.col("l_shipdate").alias("snapshot_ts"),
        F.concat(F.lit("WH-"), F.col("l_suppkey").cast("string")).alias("warehouse_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        (q + F.col("l_linenumber")).alias("on_hand_qty"),
        F.col("l_linenumber").alias("reserved_qty"),
        (q - F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("available_qty"),
    )


INVENTORY_SQL = """
inv AS (
  SELECT l_shipdate AS snapshot_ts, 'WH-' || CAST(l_suppkey AS VARCHAR) AS warehouse_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INTEGER) + l_linenumber AS on_hand_qty, l_linenumber AS reserved_qty,
         CAST(l_quantity AS INTEGER) - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS available_qty
  FROM lineitem)"""


def q_inventory_available(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-10 + WIN-02."""
    return finalize(G.inventory_available(inventory_snapshots(spark, sf)))


INVENTORY_AVAILABLE_SQL = f"""WITH {INVENTORY_SQL},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY warehouse_id, product_id
             ORDER BY snapshot_ts DESC, available_qty DESC, on_hand_qty DESC, reserved_qty DESC) AS rn FROM inv) WHERE rn = 1)
SELECT product_id, CAST(SUM(available_qty) AS BIGINT) AS available_qty, CAST(SUM(on_hand_qty) AS BIGINT) AS on_hand_qty,
       MAX(snapshot_ts) AS as_of
FROM latest GROUP BY product_id"""


PROMISED_SLA_DAYS = 60


def delivery_facts(spark: SparkSession, sf: str) -> DataFrame:
    """shipment_delivered facts: lead time = ship date - order date (hours)
    for lines shipped on or after the order date."""
    lines = A.order_lines(spark, sf)
    hours = F.datediff("l_shipdate", "o_orderdate").cast("double") * F.lit(24.0)
    return lines.where(F.col("l_shipdate") >= F.col("o_orderdate")).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
        hours.alias("delivery_lead_time_hours"),
        F.lit(PROMISED_SLA_DAYS).alias("promised_sla_days"),
    )


def q_delivery_lead_time(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-11: avg / exact p50 / p90 lead time and SLA breach share by priority."""
    return finalize(G.delivery_lead_time(delivery_facts(spark, sf), by=["priority"], exact=True))


DELIVERY_LEAD_TIME_SQL = f"""
WITH d AS (
  SELECT o_orderpriority AS priority, CAST(datediff('day', o_orderdate, l_shipdate) AS DOUBLE) * 24.0 AS h
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate)
SELECT priority, COUNT(h) AS deliveries, AVG(h) AS avg_hours, quantile_cont(h, 0.5) AS p50_hours, quantile_cont(h, 0.9) AS p90_hours,
       CAST(COUNT(*) FILTER (WHERE h > {PROMISED_SLA_DAYS} * 24.0) AS DOUBLE) / NULLIF(CAST(COUNT(h) AS DOUBLE), 0) AS sla_breach_share
FROM d GROUP BY priority"""


def q_return_rate(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-12: returned ÷ delivered orders by brand."""
    return finalize(G.return_rate(A.line_lifecycle_facts(spark, sf), by=["brand"]))


RETURN_RATE_SQL = """
WITH po AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, p_brand AS brand, TRUE AS delivered, bool_or(l_returnflag = 'R') AS returned
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey, p_brand)
SELECT brand, COUNT(*) FILTER (WHERE delivered) AS delivered_orders, COUNT(*) FILTER (WHERE delivered AND returned) AS returned_orders,
       CAST(COUNT(*) FILTER (WHERE delivered AND returned) AS DOUBLE) / NULLIF(CAST(COUNT(*) FILTER (WHERE delivered) AS DOUBLE), 0) AS return_rate
FROM po GROUP BY brand"""


def products_input(spark: SparkSession, sf: str) -> DataFrame:
    """part as raw product master data (category = type, active by size)."""
    p = read_table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") <= A.ACTIVE_MAX_SIZE).alias("active"),
        F.lit(None).cast("string").alias("created_at"),
    )


def q_gross_margin(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-15: margin after allocated discounts and cost (0.58 x price) by year."""
    lines = A.order_lines(spark, sf).select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "line_amount",
        F.col("line_discount").alias("allocated_discount"),
        F.year("o_orderdate").alias("order_year"),
    )
    return finalize(G.gross_margin(lines, D.dim_products(products_input(spark, sf)), by=["order_year"]))


GROSS_MARGIN_SQL = f"""WITH {LINES_SQL},
cost AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id,
                CAST(ROUND(CAST(p_retailprice * {D.COST_RATIO} AS DECIMAL(18,4)), 2) AS DECIMAL(18,2)) AS cost FROM part),
j AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(l_quantity AS INTEGER) AS quantity, line_amount, line_discount, cost
      FROM lines LEFT JOIN cost ON CAST(l_partkey AS VARCHAR) = cost.product_id)
SELECT order_year, CAST(SUM(line_amount - COALESCE(line_discount, 0)) AS DOUBLE) AS net_line_revenue,
       CAST(SUM(quantity * COALESCE(cost, 0)) AS DOUBLE) AS cogs,
       CAST(SUM(line_amount - COALESCE(line_discount, 0)) - SUM(quantity * COALESCE(cost, 0)) AS DOUBLE)
         / NULLIF(CAST(SUM(line_amount - COALESCE(line_discount, 0)) AS DOUBLE), 0) AS gross_margin
FROM j GROUP BY order_year"""


# ---------------------------------------------------------------- dimensions

def customers_input(spark: SparkSession, sf: str) -> DataFrame:
    """customer as raw customer master data; created_at = first order time."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    first = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"]).groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order")
    )
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        first, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    return j.select(
        F.col("c_name").alias("customer_id"),
        F.split("c_name", "#").getItem(0).alias("first_name"),
        F.split("c_name", "#").getItem(1).alias("last_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        A._map(A.REGION_COUNTRY, F.col("n_regionkey")).alias("country"),
        F.lower("c_mktsegment").alias("segment"),
        F.date_format("first_order", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
    )


CUSTOMERS_INPUT_SQL = f"""
cin AS (
  SELECT c_name AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         {sql_case_map('n_regionkey', A.REGION_COUNTRY, quote_keys=False)} AS country,
         lower(c_mktsegment) AS segment, strftime(f.first_order, '%Y-%m-%dT%H:%M:%S') AS created_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f ON c_custkey = f.o_custkey)"""


def _stable_sql(s: str) -> str:
    return f"CAST(list_sum(list_transform(range(1, length({s}) + 1), lambda i: ascii(substr({s}, i, 1)) * i)) AS BIGINT)"


def q_stable_number(spark: SparkSession, sf: str) -> DataFrame:
    """FN-19."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    return c.select("c_custkey", "c_name", stable_number("c_name").alias("stable_number"))


STABLE_NUMBER_SQL = f"SELECT c_custkey, c_name, {_stable_sql('c_name')} AS stable_number FROM customer"


def q_dim_customers(spark: SparkSession, sf: str) -> DataFrame:
    """DIM-01."""
    return finalize(D.dim_customers(customers_input(spark, sf)))


def _dim_customers_sql() -> str:
    n = _stable_sql("customer_id")
    city = sql_case_map("country", {k: v[0] for k, v in D.COUNTRY_LOCATIONS.items()})
    state = sql_case_map("country", {k: v[1] for k, v in D.COUNTRY_LOCATIONS.items()})
    return f"""WITH {CUSTOMERS_INPUT_SQL},
c2 AS (SELECT *, {n} AS n, COALESCE(country, 'US') AS ctry FROM cin)
SELECT customer_id, COALESCE(first_name, '') AS first_name, COALESCE(last_name, '') AS last_name, COALESCE(email, '') AS email,
       COALESCE(created_at, '') AS signup_ts, CAST({D.BIRTH_YEAR_BASE} + (n % {D.BIRTH_YEAR_SPAN}) AS INTEGER) AS birth_year,
       COALESCE({city.replace('CASE country', 'CASE ctry')}, 'Unknown') AS city,
       COALESCE({state.replace('CASE country', 'CASE ctry')}, 'Unknown') AS state,
       COALESCE(country, '') AS country,
       {sql_pick(D.ACQUISITION_CHANNELS, 'n')} AS acquisition_channel,
       COALESCE(segment, 'active') AS customer_segment_seed,
       (n % {D.OPT_OUT_MODULUS}) <> 0 AS is_marketing_opt_in
FROM c2"""


def q_dim_products(spark: SparkSession, sf: str) -> DataFrame:
    """DIM-02 + FLT-13: product dimension of the active products."""
    return finalize(D.active_products(D.dim_products(products_input(spark, sf))))


DIM_PRODUCTS_SQL = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS product_name, p_brand AS brand,
       'CAT-' || upper(substr(lower(p_type), 1, 3)) AS category_id, lower(p_type) AS category_name,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,4)), 2) AS DOUBLE) AS unit_price,
       CAST(ROUND(CAST(p_retailprice * {D.COST_RATIO} AS DECIMAL(18,4)), 2) AS DOUBLE) AS cost,
       p_size <= {A.ACTIVE_MAX_SIZE} AS is_active, '' AS created_ts
FROM part WHERE p_size <= {A.ACTIVE_MAX_SIZE}"""


def q_silver_dims(spark: SparkSession, sf: str) -> DataFrame:
    """DIM-06: observed Silver customers (typed created_at)."""
    return finalize(D.silver_customers(customers_input(spark, sf)))


SILVER_DIMS_SQL = f"WITH {CUSTOMERS_INPUT_SQL}\nSELECT * REPLACE (TRY_CAST(created_at AS TIMESTAMP) AS created_at) FROM cin"


def campaign_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Campaigns per (priority, year): first half of each order year."""
    od = read_table(spark, sf, "orders", ["o_orderpriority", "o_orderdate"])
    y = F.year("o_orderdate")
    return od.select(F.col("o_orderpriority").alias("campaign_id"), y.alias("campaign_year")).distinct().select(
        "campaign_id",
        "campaign_year",
        F.concat(F.lit("CMP-"), F.col("campaign_year").cast("string"), F.lit("-"), F.substring("campaign_id", 1, 1)).alias("campaign_code"),
        F.lower("campaign_id").alias("channel"),
        F.make_date("campaign_year", F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date("campaign_year", F.lit(6), F.lit(30)).alias("end_date"),
    )


def q_campaign_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    """DIM-07: last campaign per channel."""
    c = campaign_ranges(spark, sf).select("channel", F.col("campaign_code").alias("campaign_id"))
    return D.campaign_by_channel(c)


CAMPAIGN_BY_CHANNEL_SQL = """
SELECT lower(o_orderpriority) AS channel, MAX('CMP-' || CAST(year(o_orderdate) AS VARCHAR) || '-' || substr(o_orderpriority, 1, 1)) AS campaign_id
FROM orders GROUP BY lower(o_orderpriority)"""


def q_campaign_window(spark: SparkSession, sf: str) -> DataFrame:
    """JON-07: orders matched to their campaign's date range (equi + range)."""
    od = read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_orderdate"]).withColumnRenamed(
        "o_orderpriority", "campaign_id"
    )
    r = campaign_ranges(spark, sf).select("campaign_id", "campaign_year", "campaign_code", "start_date", "end_date")
    return finalize(within_interval(od, r, ts_column="o_orderdate", key="campaign_id"))


CAMPAIGN_WINDOW_SQL = """
WITH r AS (SELECT DISTINCT o_orderpriority AS campaign_id, CAST(year(o_orderdate) AS INTEGER) AS campaign_year FROM orders)
SELECT o.o_orderkey, o.o_orderpriority AS campaign_id, o.o_orderdate, r.campaign_year,
       'CMP-' || CAST(r.campaign_year AS VARCHAR) || '-' || substr(r.campaign_id, 1, 1) AS campaign_code,
       make_date(r.campaign_year, 1, 1) AS start_date, make_date(r.campaign_year, 6, 30) AS end_date
FROM orders o JOIN r ON o.o_orderpriority = r.campaign_id
 AND CAST(o.o_orderdate AS DATE) BETWEEN make_date(r.campaign_year, 1, 1) AND make_date(r.campaign_year, 6, 30)"""


def q_first_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-05: first order per customer."""
    od = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return G.first_purchase_flags(od, customer="o_custkey", ts="o_orderdate", order="o_orderkey")


FIRST_PURCHASE_SQL = """
SELECT o_custkey, o_orderkey, o_orderdate,
       o_orderkey = first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS is_first_purchase
FROM orders"""


def q_order_line_index(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-06: line index and count per order."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    return G.line_positions(li, order="l_orderkey", sort=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])


ORDER_LINE_INDEX_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS INTEGER) AS order_item_index,
       COUNT(*) OVER (PARTITION BY l_orderkey) AS order_item_count
FROM lineitem"""


def q_union_datasets(spark: SparkSession, sf: str) -> DataFrame:
    """SET-01 / SRC-05: per-event-type datasets with different columns,
    fanned in with unionByName(allowMissingColumns)."""
    ev = read_table(spark, sf, "events")
    k = A.props_k()
    parts = [
        ev.where(F.col("event_type") == "signup").select("event_id", "ts", "user_id", "event_type"),
        ev.where(F.col("event_type") == "view").select("event_id", "ts", "user_id", "event_type", k.alias("k")),
        ev.where(F.col("event_type") == "click").select("event_id", "ts", "user_id", "event_type", k.alias("k"), "value"),
        ev.where(F.col("event_type") == "purchase").select("event_id", "ts", "user_id", "event_type", "value"),
        ev.where(F.col("event_type") == "error").select("event_id", "ts", "user_id", "event_type", "props"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


UNION_DATASETS_SQL = f"""
SELECT event_id, ts, user_id, event_type FROM events WHERE event_type = 'signup'
UNION ALL BY NAME SELECT event_id, ts, user_id, event_type, {K} AS k FROM events WHERE event_type = 'view'
UNION ALL BY NAME SELECT event_id, ts, user_id, event_type, {K} AS k, value FROM events WHERE event_type = 'click'
UNION ALL BY NAME SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'purchase'
UNION ALL BY NAME SELECT event_id, ts, user_id, event_type, props FROM events WHERE event_type = 'error'"""


PLANS = {
    "gmv_orders_aov": Plan(q_gmv_orders_aov, _kpis_sql(["customer_segment_seed"]), "AGG-04,05,06,13,14 JON-02"),
    "net_revenue": Plan(q_net_revenue, _kpis_sql(["order_year"], ["order_year", "net_sales", "refunds", "net_revenue", "net_merchandise"]), "AGG-13"),
    "discount_rate": Plan(q_discount_rate, _kpis_sql(["campaign_id"], ["campaign_id", "gmv", "discount", "discount_rate"]), "AGG-14"),
    "revenue_by_campaign": Plan(q_revenue_by_campaign, TOP_CAMPAIGNS_SQL.rsplit(" ORDER BY", 1)[0], "AGG-03 JON-02"),
    "top_campaigns": Plan(q_top_campaigns, TOP_CAMPAIGNS_SQL, "SRT-01"),
    "kpi_rollup": Plan(q_kpi_rollup, KPI_ROLLUP_SQL, "AGG-17"),
    "sessions_by_channel": Plan(q_sessions_by_channel, SESSIONS_BY_CHANNEL_SQL, "AGG-01 STR-09"),
    "conversion_rate": Plan(q_conversion_rate, CONVERSION_RATE_SQL, "AGG-02 AGG-16 JON-01"),
    "sessionize": Plan(q_sessionize, SESSIONIZE_SQL, "STR-09 AGG-16"),
    "session_gaps": Plan(q_session_gaps, SESSION_GAPS_SQL, "WIN-04"),
    "product_views": Plan(q_product_views, PRODUCT_VIEWS_SQL, "AGG-07"),
    "view_to_cart": Plan(q_view_to_cart, VIEW_TO_CART_SQL, "AGG-08"),
    "product_revenue": Plan(q_product_revenue, PRODUCT_REVENUE_SQL, "AGG-09 FN-21"),
    "inventory_available": Plan(q_inventory_available, INVENTORY_AVAILABLE_SQL, "AGG-10 WIN-02"),
    "delivery_lead_time": Plan(q_delivery_lead_time, DELIVERY_LEAD_TIME_SQL, "AGG-11"),
    "return_rate": Plan(q_return_rate, RETURN_RATE_SQL, "AGG-12"),
    "gross_margin": Plan(q_gross_margin, GROSS_MARGIN_SQL, "AGG-15 DIM-02 JON-02"),
    "stable_number": Plan(q_stable_number, STABLE_NUMBER_SQL, "FN-19"),
    "dim_customers": Plan(q_dim_customers, _dim_customers_sql(), "DIM-01 FN-19"),
    "dim_products": Plan(q_dim_products, DIM_PRODUCTS_SQL, "DIM-02 FLT-13 FN-20"),
    "silver_dims": Plan(q_silver_dims, SILVER_DIMS_SQL, "DIM-06"),
    "campaign_by_channel": Plan(q_campaign_by_channel, CAMPAIGN_BY_CHANNEL_SQL, "DIM-07"),
    "campaign_window": Plan(q_campaign_window, CAMPAIGN_WINDOW_SQL, "JON-07"),
    "first_purchase": Plan(q_first_purchase, FIRST_PURCHASE_SQL, "WIN-05"),
    "order_line_index": Plan(q_order_line_index, ORDER_LINE_INDEX_SQL, "WIN-06"),
    "union_datasets": Plan(q_union_datasets, UNION_DATASETS_SQL, "SET-01 SRC-05"),
}
