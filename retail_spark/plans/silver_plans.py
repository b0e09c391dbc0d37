"""Registered Silver plans (PRJ-01..10, FN-01..21, FLT-01..12, WIN-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.functions.columns import cleaned_string
from retail_spark.operators import silver as S
from retail_spark.operators.dims import ACQUISITION_CHANNELS
from retail_spark.plans import adapters as A
from retail_spark.plans.common import (
    Plan,
    finalize,
    sql_case_map,
    sql_in,
    sql_metadata,
    sql_pick,
    sql_select_clean,
)
from retail_spark.sources.tables import read_table
from retail_spark.streaming.dedup import earliest_per_key

# ---------------------------------------------------------------- inputs (SQL)

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

EVENTS_INPUT_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(ts AS VARCHAR) AS event_ts,
       {sql_case_map('event_type', A.EVENT_VOCAB)} AS event_type,
       CAST(NULL AS VARCHAR) AS session_id,
       CAST(user_id AS VARCHAR) AS customer_id,
       CAST({K} AS VARCHAR) AS product_id,
       CASE WHEN event_type = 'purchase' THEN 'E' || CAST(event_id AS VARCHAR) END AS order_id,
       ' Desktop ' AS device_type, 'web' AS platform, '' AS referrer, 'usd' AS currency,
       '1' AS quantity,
       CAST(value AS VARCHAR) AS unit_price,
       CASE WHEN event_type = 'signup'
              THEN '{{"k": ' || CAST({K} AS VARCHAR) || ', "channel": "' || {sql_pick(ACQUISITION_CHANNELS, K)} || '", "source": " Web "}}'
            WHEN event_type = 'purchase'
              THEN '{{"k": ' || CAST({K} AS VARCHAR) || ', "gross_amount": ' || CAST(value AS VARCHAR)
                   || ', "net_amount": ' || CAST(value AS VARCHAR) || ', "discount_amount": 0}}'
            ELSE props END AS attributes
FROM events
"""
EVENTS_INPUT_COLS = ["event_id", "event_ts", "event_type", "session_id", "customer_id", "product_id", "order_id",
                     "device_type", "platform", "referrer", "currency", "quantity", "unit_price", "attributes"]


def _fact_sql() -> str:
    """DuckDB rendering of transform_fact_event_raw over EVENTS_INPUT_SQL."""
    clean = sql_select_clean("ev_in", S.FACT_ENVELOPE_CLEAN, EVENTS_INPUT_COLS, ["attributes AS attributes_json"])
    ext = []
    from retail_spark.plans.common import SQL_KIND

    for name, keys, kind in S.FACT_ATTRIBUTES:
        raw = (
            "COALESCE(" + ", ".join(f"json_extract_string(attributes_json, '$.{k}')" for k in keys) + ")"
            if len(keys) > 1
            else f"json_extract_string(attributes_json, '$.{keys[0]}')"
        )
        ext.append(f"{raw if kind == 'raw' else SQL_KIND[kind].format(raw)} AS {name}")
    line_amt = "CAST(CAST(COALESCE(unit_price, 0) * COALESCE(quantity, 0) AS DECIMAL(18,2)) AS DOUBLE)"
    derived = [
        f"COALESCE(net_amount, gross_amount, attempted_amount, refund_amount, {line_amt}) AS event_amount",
        f"event_type IN {sql_in(S.COMMERCE_EVENTS)} AS is_commerce_event",
        f"event_type IN {sql_in(S.FULFILLMENT_EVENTS)} AS is_fulfillment_event",
        f"event_type IN {sql_in(S.RETURN_EVENTS)} AS is_return_event",
        f"event_type = '{S.SUPPORT_EVENT}' AS is_support_event",
        "customer_id AS graph_customer_id",
        "product_id AS graph_product_id",
        "order_id AS graph_order_id",
        "event_type AS graph_interaction_type",
        sql_metadata("event_ts", "event_date"),
    ]
    # unit_price in c1 is DOUBLE (decimal converted); recompute the line amount from decimals
    c1 = clean.replace(
        "CAST(TRY_CAST(unit_price AS DECIMAL(18,2)) AS DOUBLE) AS unit_price",
        "TRY_CAST(unit_price AS DECIMAL(18,2)) AS unit_price",
    )
    return f"""
WITH ev_in AS ({EVENTS_INPUT_SQL}),
c1 AS ({c1}),
c2 AS (SELECT * EXCLUDE (attributes), {', '.join(ext)} FROM c1)
SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price), {', '.join(derived)} FROM c2
"""


def q_silver_events(spark: SparkSession, sf: str) -> DataFrame:
    return finalize(S.transform_fact_event_raw(A.events_input(spark, sf)))


PURCHASES_INPUT_SQL = """
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS event_id,
       'Purchase ' AS event_type,
       CAST(o_orderdate AS VARCHAR) AS occurred_at,
       'gen-' || CAST(l_suppkey AS VARCHAR) AS generator_instance_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       lower(n_name) AS customer_country,
       ' ' || c_mktsegment || ' ' AS customer_segment,
       's-' || CAST(o_custkey AS VARCHAR) AS session_id,
       CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       'SKU-' || CAST(l_partkey AS VARCHAR) AS product_sku,
       p_type AS product_category,
       p_brand AS product_brand,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
       CAST(p_retailprice AS VARCHAR) AS unit_price,
       CAST(l_extendedprice AS VARCHAR) AS amount,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS VARCHAR) AS discount_amount,
       CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS VARCHAR) AS discount_pct,
       CASE WHEN l_returnflag = 'R' THEN ' ret ' END AS coupon_code,
       'usd' AS currency,
       CAST(NULL AS VARCHAR) AS order_total_amount,
       CAST(l_linenumber AS VARCHAR) AS order_item_index,
       CAST(NULL AS VARCHAR) AS order_item_count,
       'f-' || CAST(l_orderkey AS VARCHAR) AS flow_id,
       lower(o_orderpriority) AS channel,
       o_orderpriority AS campaign_id,
       '' AS source_medium,
       'Desktop' AS device_type,
       l_linenumber = 1 AS is_first_purchase,
       CAST(NULL AS VARCHAR) AS cross_sell_source
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
"""
PURCHASES_INPUT_COLS = ["event_id", "event_type", "occurred_at", "generator_instance_id", "customer_id", "customer_country",
                        "customer_segment", "session_id", "order_id", "product_id", "product_sku", "product_category",
                        "product_brand", "quantity", "unit_price", "amount", "discount_amount", "discount_pct",
                        "coupon_code", "currency", "order_total_amount", "order_item_index", "order_item_count",
                        "flow_id", "channel", "campaign_id", "source_medium", "device_type", "is_first_purchase",
                        "cross_sell_source"]


def _purchases_sql() -> str:
    c1 = sql_select_clean("p_in", S.PURCHASES_CLEAN, PURCHASES_INPUT_COLS)
    # money kinds stay decimal in c1 for the derived amounts
    for m in ("unit_price", "amount", "discount_amount", "order_total_amount"):
        c1 = c1.replace(f"CAST(TRY_CAST({m} AS DECIMAL(18,2)) AS DOUBLE) AS {m}", f"TRY_CAST({m} AS DECIMAL(18,2)) AS {m}")
    zero = "CAST(0 AS DECIMAL(18,2))"
    derived = [
        f"CAST(CAST(COALESCE(amount, {zero}) - COALESCE(discount_amount, {zero}) AS DECIMAL(18,2)) AS DOUBLE) AS net_item_amount",
        f"CAST(CAST(COALESCE(unit_price, {zero}) * COALESCE(quantity, 0) AS DECIMAL(18,2)) AS DOUBLE) AS gross_item_amount",
        f"COALESCE(discount_amount, {zero}) > {zero} AS is_discounted",
        "NOT COALESCE(is_first_purchase, false) AS is_repeat_purchase",
        "customer_id AS graph_customer_id",
        "product_id AS graph_product_id",
        "order_id AS graph_order_id",
        sql_metadata("occurred_at", "occurred_date"),
    ]
    money_out = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in ("unit_price", "amount", "discount_amount", "order_total_amount"))
    # batch dedup: earliest by time, then the remaining columns in schema order
    tie = ", ".join(f"{c} NULLS FIRST" for c in PURCHASES_INPUT_COLS if c != "event_id")
    return f"""
WITH p_in AS ({PURCHASES_INPUT_SQL}),
c1 AS ({c1}),
d AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY occurred_at IS NULL, occurred_at, {tie}) AS rn FROM c1)
      WHERE rn = 1)
SELECT * REPLACE ({money_out}), {', '.join(derived)} FROM d
"""


def q_silver_purchases(spark: SparkSession, sf: str) -> DataFrame:
    return finalize(S.transform_purchases(A.purchases_input(spark, sf), only_duplicated_keys=True))


TRANSACTIONS_INPUT_SQL = f"""
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS event_id,
       ' TRANSACTION' AS event_type,
       CAST(o_orderdate AS VARCHAR) AS occurred_at,
       'gen-1' AS generator_instance_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       's-' || CAST(o_custkey AS VARCHAR) AS session_id,
       'tx-' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
       CAST(o_orderkey AS VARCHAR) AS order_id,
       ' ' || o_orderpriority AS payment_method,
       upper({sql_case_map('o_orderstatus', A.ORDER_STATUS_TO_PAYMENT)}) AS status,
       CAST(o_totalprice AS VARCHAR) AS amount,
       'f-' || CAST(o_orderkey AS VARCHAR) AS flow_id
FROM orders
"""
TRANSACTIONS_INPUT_COLS = ["event_id", "event_type", "occurred_at", "generator_instance_id", "customer_id", "session_id",
                           "transaction_id", "order_id", "payment_method", "status", "amount", "flow_id"]


def _transactions_sql() -> str:
    c1 = sql_select_clean("t_in", S.TRANSACTIONS_CLEAN, TRANSACTIONS_INPUT_COLS)
    succ, fail = sql_in(S.SUCCESS_STATUSES), sql_in(S.FAILED_STATUSES)
    return f"""
WITH t_in AS ({TRANSACTIONS_INPUT_SQL}),
c1 AS ({c1})
SELECT *, status IN {succ} AS is_successful, status IN {fail} AS is_failed,
       CASE WHEN status IN {succ} THEN 'successful' WHEN status IN {fail} THEN 'failed' ELSE 'other' END AS status_group,
       {sql_metadata('occurred_at', 'occurred_date')}
FROM c1
"""


def q_silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return finalize(S.transform_transactions(A.transactions_input(spark, sf)))


TICKETS_INPUT_SQL = f"""
SELECT 'TK' || CAST(event_id AS VARCHAR) AS event_id,
       'support_ticket' AS event_type,
       CAST(ts AS VARCHAR) AS occurred_at,
       'ticket-' || CAST(event_id AS VARCHAR) AS ticket_id,
       CAST(user_id AS VARCHAR) AS customer_id,
       ' Error ' AS category,
       CASE WHEN value >= 50 THEN 'HIGH' ELSE ' low' END AS priority,
       {sql_pick(A.TICKET_STATUSES, K)} AS status
FROM events WHERE event_type = 'error'
"""
TICKETS_INPUT_COLS = ["event_id", "event_type", "occurred_at", "ticket_id", "customer_id", "category", "priority", "status"]


def _tickets_sql() -> str:
    c1 = sql_select_clean("k_in", S.SUPPORT_TICKETS_CLEAN, TICKETS_INPUT_COLS)
    return f"""
WITH k_in AS ({TICKETS_INPUT_SQL}),
c1 AS ({c1})
SELECT *, status IN {sql_in(S.OPEN_TICKET_STATUSES)} AS is_open, status IN {sql_in(S.RESOLVED_TICKET_STATUSES)} AS is_resolved,
       {sql_metadata('occurred_at', 'occurred_date')}
FROM c1
"""


def q_silver_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return finalize(S.transform_support_tickets(A.tickets_input(spark, sf)))


CLICKS_INPUT_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       'Click' AS event_type,
       CAST(ts AS VARCHAR) AS occurred_at,
       'gen-1' AS generator_instance_id,
       CAST(user_id AS VARCHAR) AS customer_id,
       CASE WHEN event_type = 'view' THEN ' Product ' ELSE 'search' END AS page,
       upper(event_type) AS action,
       CASE WHEN event_type = 'view' THEN CAST({K} AS VARCHAR) END AS product_id,
       CASE WHEN event_type <> 'view' THEN ' q' || CAST({K} AS VARCHAR) END AS search_query,
       CASE WHEN {K} >= 50 THEN '' ELSE 'c-' || CAST({K} AS VARCHAR) END AS campaign_id,
       props AS search_filters,
       CAST({K} AS VARCHAR) AS scroll_depth_pct,
       'true' AS is_logged_in,
       CAST(user_id AS VARCHAR) AS session_elapsed_ms,
       CAST({K} AS VARCHAR) AS product_impression_count,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS ingest_date
FROM events WHERE event_type IN ('view', 'click')
"""
CLICKS_INPUT_COLS = ["event_id", "event_type", "occurred_at", "generator_instance_id", "customer_id", "page", "action",
                     "product_id", "search_query", "campaign_id", "search_filters", "scroll_depth_pct", "is_logged_in",
                     "session_elapsed_ms", "product_impression_count", "ingest_date"]


def _clicks_sql() -> str:
    c1 = sql_select_clean("k_in", S.CLICKS_CLEAN, CLICKS_INPUT_COLS, ["search_filters AS search_filters_json"])
    return f"""
WITH k_in AS ({CLICKS_INPUT_SQL}),
c1 AS ({c1})
SELECT * EXCLUDE (search_filters),
       product_id IS NOT NULL AS has_product_context,
       (page = 'search') OR (search_query IS NOT NULL) AS is_search_interaction,
       recommendation_request_id IS NOT NULL AS is_recommendation_interaction,
       experiment_id IS NOT NULL AS is_experiment_interaction,
       product_id AS graph_target_product_id,
       action AS graph_interaction_type,
       {sql_metadata('occurred_at', 'occurred_date')}
FROM c1
"""


def q_silver_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return finalize(S.transform_clicks(A.clicks_input(spark, sf)))


def _clicks_light_sql() -> str:
    return f"""
WITH k_in AS ({CLICKS_INPUT_SQL})
SELECT * EXCLUDE (product_impression_count) REPLACE (
    TRY_CAST(occurred_at AS TIMESTAMP) AS occurred_at,
    NULLIF(campaign_id, '') AS campaign_id,
    CAST(ingest_date AS DATE) AS ingest_date,
    TRY_CAST(is_logged_in AS BOOLEAN) AS is_logged_in,
    TRY_CAST(session_elapsed_ms AS INTEGER) AS session_elapsed_ms),
    CAST(NULL AS INTEGER) AS component_load_time_ms,
    CAST(NULL AS INTEGER) AS page_load_time_ms,
    CAST(NULL AS INTEGER) AS time_on_previous_page_ms
FROM k_in
"""


def q_silver_clicks_light(spark: SparkSession, sf: str) -> DataFrame:
    return finalize(S.transform_clicks_light(A.clicks_input(spark, sf)))


def q_clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    """FN-01..04 on padded / re-cased / blanked customer fields."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    raw_name = F.when(F.col("c_acctbal") < 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    raw_seg = F.concat(F.lit(" "), F.initcap("c_mktsegment"), F.lit("\t"))
    return c.select(
        "c_custkey",
        cleaned_string(raw_name).alias("name_clean"),
        cleaned_string(raw_name, upper_case=True).alias("name_upper"),
        cleaned_string(raw_seg, lower_case=True).alias("segment_lower"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment_nullif"),
        F.coalesce(cleaned_string(raw_name), F.lit("unknown")).alias("name_or_unknown"),
        F.when(F.col("c_acctbal") < 0, F.lit("debtor")).otherwise(F.lit("ok")).alias("balance_class"),
    )


CLEAN_STRINGS_SQL = """
WITH c AS (
  SELECT c_custkey, c_mktsegment, c_acctbal,
         CASE WHEN c_acctbal < 0 THEN '   ' ELSE '  ' || c_name || ' ' END AS raw_name,
         ' ' || (upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2))) || chr(9) AS raw_seg
  FROM customer)
SELECT c_custkey,
       NULLIF(TRIM(raw_name), '') AS name_clean,
       UPPER(NULLIF(TRIM(raw_name), '')) AS name_upper,
       LOWER(NULLIF(TRIM(raw_seg), '')) AS segment_lower,
       NULLIF(c_mktsegment, 'BUILDING') AS segment_nullif,
       COALESCE(NULLIF(TRIM(raw_name), ''), 'unknown') AS name_or_unknown,
       CASE WHEN c_acctbal < 0 THEN 'debtor' ELSE 'ok' END AS balance_class
FROM c
"""


def q_dedup_lines(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-01: one row per (l_orderkey, l_linenumber), earliest by ship date,
    ties broken by the remaining columns in schema order."""
    li = read_table(spark, sf, "lineitem")
    return finalize(earliest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


DEDUP_LINES_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate NULLS LAST, l_orderkey, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_linenumber,
               l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
               l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1
"""


PLANS = {
    "silver_events": Plan(q_silver_events, _fact_sql(), "PRJ-01,02,08,09,10 FN-01,05..09,12,14,17,18 FLT-09..12"),
    "silver_purchases": Plan(q_silver_purchases, _purchases_sql(), "PRJ-05 FN-06,15,16 FLT-04,05"),
    "silver_transactions": Plan(q_silver_transactions, _transactions_sql(), "PRJ-06 FLT-06,07"),
    "silver_tickets": Plan(q_silver_tickets, _tickets_sql(), "PRJ-07 FLT-08"),
    "silver_clicks": Plan(q_silver_clicks, _clicks_sql(), "PRJ-03 FLT-01..03 FN-13"),
    "silver_clicks_light": Plan(q_silver_clicks_light, _clicks_light_sql(), "PRJ-04 FN-04,08"),
    "clean_strings": Plan(q_clean_strings, CLEAN_STRINGS_SQL, "FN-01..04"),
    "dedup_lines": Plan(q_dedup_lines, DEDUP_LINES_SQL, "WIN-01 SET-02"),
}
