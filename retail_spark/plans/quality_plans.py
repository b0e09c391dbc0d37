"""Registered data-quality plans (DQ-01..07, JON-03, JON-04)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.operators import quality as Q
from retail_spark.plans.adapters import ACTIVE_MAX_SIZE
from retail_spark.plans.common import Plan, finalize
from retail_spark.plans.gold_plans import INVENTORY_SQL, inventory_snapshots
from retail_spark.schemas import PURCHASES_V1, Contract
from retail_spark.sources.tables import read_table
from retail_spark.streaming.dedup import duplicate_report

# ------------------------------------------------- contract check over lineitem

AMOUNT_EXPR = "l_extendedprice * (1 - l_discount) - l_tax * 20000"


def purchase_records(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem rows as typed purchase records (contract read types), with
    the producer-side faults the data implies: returned lines labelled
    'return' (const), zero-based line index (minimum), tax-heavy lines with
    a negative amount (minimum), customers in debt without a session
    (required) and open lines carrying a warehouse key the purchase contract
    does not define (rescued as unexpected)."""
    li = read_table(spark, sf, "lineitem")
    od = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    cu = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).join(cu, F.col("o_custkey") == F.col("c_custkey"), "left")
    s = lambda c: F.col(c).cast("string")
    return j.select(
        F.concat_ws("-", s("l_orderkey"), s("l_linenumber"), s("l_partkey"), s("l_suppkey")).alias("event_id"),
        F.when(F.col("l_returnflag") == "R", F.lit("return")).otherwise(F.lit("purchase")).alias("event_type"),
        s("o_orderdate").alias("occurred_at"),
        F.concat(F.lit("gen-"), s("l_suppkey")).alias("generator_instance_id"),
        s("o_custkey").alias("customer_id"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("s-"), s("o_custkey"))).alias("session_id"),
        s("l_orderkey").alias("order_id"),
        s("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.expr(AMOUNT_EXPR).alias("amount"),
        (F.col("l_discount") * 100).alias("discount_pct"),
        (F.col("l_linenumber") - 1).cast("long").alias("order_item_index"),
        F.concat(F.lit("f-"), s("l_orderkey")).alias("flow_id"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit('{"warehouse_id":"WH-'), s("l_suppkey"), F.lit('"}'))).alias(
            "_rescued_data"
        ),
    )


PURCHASE_RECORDS_SQL = f"""
recs AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS event_id,
         CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'purchase' END AS event_type,
         CAST(o_orderdate AS VARCHAR) AS occurred_at,
         'gen-' || CAST(l_suppkey AS VARCHAR) AS generator_instance_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN c_acctbal >= 0 THEN 's-' || CAST(o_custkey AS VARCHAR) END AS session_id,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity,
         {AMOUNT_EXPR} AS amount,
         l_discount * 100 AS discount_pct,
         CAST(l_linenumber - 1 AS BIGINT) AS order_item_index,
         'f-' || CAST(l_orderkey AS VARCHAR) AS flow_id,
         CASE WHEN l_linestatus = 'O' THEN '{{"warehouse_id":"WH-' || CAST(l_suppkey AS VARCHAR) || '"}}' END AS _rescued_data
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""
RECORD_COLS = {"event_id", "event_type", "occurred_at", "generator_instance_id", "customer_id", "session_id", "order_id",
               "product_id", "quantity", "amount", "discount_pct", "order_item_index", "flow_id"}


def _num(v: float) -> str:
    return repr(float(v)) if not float(v).is_integer() else str(int(v))


def sql_violations(contract: Contract, present: set[str], strict: bool = False) -> str:
    """DuckDB rendering of operators.quality.contract_violations as a list."""
    resc = "COALESCE(json_keys(_rescued_data), [])"
    checks = []
    for f in contract.fields:
        c = f.name if f.name in present else "NULL"
        in_r = f"list_contains({resc}, '{f.name}')"
        if f.name in contract.required:
            checks.append(f"CASE WHEN {c} IS NULL AND NOT {in_r} THEN 'required:{f.name}' END")
        checks.append(f"CASE WHEN {in_r} THEN 'type:{f.name}' END")
        if f.type == "datetime":
            checks.append(f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL THEN 'format:{f.name}' END")
        if f.const is not None:
            checks.append(f"CASE WHEN {c} IS NOT NULL AND {c} <> '{f.const}' THEN 'const:{f.name}' END")
        if f.enum is not None:
            vals = ", ".join(f"'{v}'" for v in f.enum)
            checks.append(f"CASE WHEN {c} IS NOT NULL AND {c} NOT IN ({vals}) THEN 'enum:{f.name}' END")
        if f.minimum is not None:
            checks.append(f"CASE WHEN {c} < {_num(f.minimum)} THEN 'minimum:{f.name}' END")
        if f.maximum is not None:
            checks.append(f"CASE WHEN {c} > {_num(f.maximum)} THEN 'maximum:{f.name}' END")
    allowed = contract.field_names + ([] if strict else list(contract.extra_allowed))
    allowed_sql = "[" + ", ".join(f"'{a}'" for a in allowed) + "]"
    unexpected = f"list_transform(list_filter({resc}, lambda k: NOT list_contains({allowed_sql}, k)), lambda k: 'unexpected:' || k)"
    base = f"list_filter([{', '.join(checks)}], lambda x: x IS NOT NULL)"
    return f"list_concat({base}, {unexpected})"


def q_contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-01: contract violations per purchase record (codes joined by ',')."""
    v = Q.contract_violations(purchase_records(spark, sf), PURCHASES_V1)
    return v.select("event_id", F.concat_ws(",", Q.VIOLATIONS).alias("violation_codes"), F.size(Q.VIOLATIONS).alias("n_violations"))


CONTRACT_VIOLATIONS_SQL = f"""WITH {PURCHASE_RECORDS_SQL},
v AS (SELECT event_id, {sql_violations(PURCHASES_V1, RECORD_COLS)} AS vs FROM recs)
SELECT event_id, array_to_string(vs, ',') AS violation_codes, CAST(len(vs) AS INTEGER) AS n_violations FROM v"""


def q_quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-02: quarantined rows per violation code (valid ∪ quarantined = input)."""
    checked = Q.contract_violations(purchase_records(spark, sf), PURCHASES_V1)
    valid, bad = Q.split_quarantine(Q.violation_kinds(checked), key="event_id")
    counts = Q.quarantine_counts(bad, rows="n")
    total_valid = valid.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(F.lit("<valid>").alias("violation"), "rows")
    return counts.unionByName(total_valid)


QUARANTINE_COUNTS_SQL = f"""WITH {PURCHASE_RECORDS_SQL},
v AS (SELECT event_id, {sql_violations(PURCHASES_V1, RECORD_COLS)} AS vs FROM recs)
SELECT violation, COUNT(*) AS rows FROM (SELECT unnest(vs) AS violation FROM v WHERE len(vs) > 0) GROUP BY violation
UNION ALL
SELECT '<valid>' AS violation, COUNT(*) AS rows FROM v WHERE len(vs) = 0"""


def q_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-03 / JON-03: order lines whose part is not an active product."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    active = read_table(spark, sf, "part", ["p_partkey", "p_size"]).where(F.col("p_size") <= ACTIVE_MAX_SIZE)
    return Q.orphans(li, active, "l_partkey", "p_partkey")


ORPHANS_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_size <= {ACTIVE_MAX_SIZE} AND p_partkey = l_partkey)"""


def q_dup_report(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-07: (l_orderkey, l_linenumber) keys carried by more than one line."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    return duplicate_report(li, ["l_orderkey", "l_linenumber"])


DUP_REPORT_SQL = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""


def q_order_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-04: Σ lines (price x (1 - discount) x (1 + tax), cents) vs order total."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount", "l_tax"])
    one = F.lit(Decimal("1.00"))
    amt = (
        F.col("l_extendedprice").cast("decimal(18,2)") * (one - F.col("l_discount").cast("decimal(18,2)"))
        * (one + F.col("l_tax").cast("decimal(18,2)"))
    ).cast("decimal(18,2)")
    lines = li.select(F.col("l_orderkey").alias("order_id"), amt.alias("line_amount"))
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("gross_amount")
    )
    return finalize(Q.reconcile_orders(lines, orders))


ORDER_RECONCILE_SQL = """
WITH l AS (
  SELECT l_orderkey AS order_id,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1.00 - CAST(l_discount AS DECIMAL(18,2))) * (1.00 + CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS a
  FROM lineitem),
p AS (SELECT order_id, SUM(a) AS lines_total, COUNT(*) AS line_count FROM l GROUP BY order_id)
SELECT o_orderkey AS order_id, o_totalprice AS order_total, CAST(p.lines_total AS DOUBLE) AS lines_total, p.line_count,
       CAST(COALESCE(p.lines_total, 0) AS DOUBLE) - o_totalprice AS diff,
       abs(CAST(COALESCE(p.lines_total, 0) AS DOUBLE) - o_totalprice) <= 0.01 AS is_balanced
FROM orders LEFT JOIN p ON o_orderkey = p.order_id"""


def q_inventory_identity(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-06: snapshots where available ≠ on hand - reserved."""
    checked = Q.inventory_identity(inventory_snapshots(spark, sf))
    return checked.where(~F.col("identity_ok"))


INVENTORY_IDENTITY_SQL = f"""WITH {INVENTORY_SQL}
SELECT *, available_qty = on_hand_qty - reserved_qty AS identity_ok FROM inv WHERE NOT (available_qty = on_hand_qty - reserved_qty)"""


def lifecycle_events(spark: SparkSession, sf: str) -> DataFrame:
    """order_placed at the order date and shipment_created at each line's ship date."""
    od = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate"])
    placed = od.select(F.col("o_orderkey").alias("order_id"), F.lit("order_placed").alias("event_type"), F.col("o_orderdate").alias("event_ts"))
    shipped = li.select(F.col("l_orderkey").alias("order_id"), F.lit("shipment_created").alias("event_type"), F.col("l_shipdate").alias("event_ts"))
    return placed.unionByName(shipped)


def q_lifecycle_order(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-05 / JON-04: per-order stage times and ordering violations."""
    return finalize(Q.lifecycle_violations(lifecycle_events(spark, sf)))


def _lifecycle_sql() -> str:
    stages = list(Q.LIFECYCLE_STAGES)
    aggs = [f"MIN(CASE WHEN event_type = '{s}' THEN event_ts END) AS {s}_ts" for s in (*stages, "order_cancelled")]
    pairs = [f"COALESCE({b}_ts < {a}_ts, false)" for i, a in enumerate(stages) for b in stages[i + 1:]]
    return f"""
WITH ev AS (
  SELECT o_orderkey AS order_id, 'order_placed' AS event_type, o_orderdate AS event_ts FROM orders
  UNION ALL SELECT l_orderkey, 'shipment_created', l_shipdate FROM lineitem),
per AS (SELECT order_id, {', '.join(aggs)} FROM ev WHERE order_id IS NOT NULL GROUP BY order_id)
SELECT *, ({' OR '.join(pairs)}) AS out_of_order, COALESCE(shipment_created_ts > order_cancelled_ts, false) AS shipped_after_cancel FROM per"""


def q_order_amount_checks(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-04/08: tax, net and free-shipping identities on order facts."""
    from retail_spark.plans.adapters import order_facts

    o = Q.order_amount_checks(order_facts(spark, sf))
    return o.select("order_id", "tax_ok", "net_ok", "shipping_rule_ok")


ORDER_AMOUNT_CHECKS_SQL = """
WITH l AS (
  SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS a,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS d, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
l2 AS (SELECT *, CAST((a - d) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS t FROM l),
p AS (SELECT l_orderkey, SUM(a) AS g, SUM(d) AS d, SUM(t) AS t FROM l2 GROUP BY l_orderkey),
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, COALESCE(g, 0) AS g, COALESCE(d, 0) AS d, COALESCE(t, 0) AS t,
             CAST(0 AS DECIMAL(18,2)) AS s FROM orders LEFT JOIN p ON o_orderkey = l_orderkey),
o2 AS (SELECT *, g - d + t AS n FROM o)
SELECT order_id,
       abs(t - ROUND((g - d) * 0.08, 2)) <= 0.01 AS tax_ok,
       abs(n - ((g - d) + s + t)) <= 0.01 AS net_ok,
       (s = 0) = (g >= 120.00) AS shipping_rule_ok
FROM o2"""


PLANS = {
    "contract_violations": Plan(q_contract_violations, CONTRACT_VIOLATIONS_SQL, "DQ-01"),
    "quarantine_counts": Plan(q_quarantine_counts, QUARANTINE_COUNTS_SQL, "DQ-02"),
    "orphans": Plan(q_orphans, ORPHANS_SQL, "DQ-03 JON-03 FLT-13"),
    "dup_report": Plan(q_dup_report, DUP_REPORT_SQL, "DQ-07"),
    "order_reconcile": Plan(q_order_reconcile, ORDER_RECONCILE_SQL, "DQ-04"),
    "order_amount_checks": Plan(q_order_amount_checks, ORDER_AMOUNT_CHECKS_SQL, "DQ-04 DQ-08"),
    "inventory_identity": Plan(q_inventory_identity, INVENTORY_IDENTITY_SQL, "DQ-06"),
    "lifecycle_order": Plan(q_lifecycle_order, _lifecycle_sql(), "DQ-05 JON-04"),
}
