"""Data-quality operators (DQ-01..08, JON-03).

The contract check compiles a contract (schemas.Contract) into one
projection that adds ``violations array<string>``; nothing runs per row in
Python. Quarantine is a filter on that column, so on a stream it is two
writes of the same micro-batch (streaming.jobs).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_spark.schemas import Contract
from retail_spark.session import ensure_shared_dir
from retail_spark.sources.landing import CORRUPT, RESCUED

VIOLATIONS = "violations"

# Reconciliation constants of the event producer.
TAX_RATE = Decimal("0.08")
FREE_SHIPPING_MIN_CART = Decimal("120.00")
MONEY_TOLERANCE = Decimal("0.01")


def contract_violations(df: DataFrame, contract: Contract, *, strict: bool = False) -> DataFrame:
    """DQ-01: add ``violations`` (empty array = valid).

    Codes: ``required:<f>``, ``type:<f>`` (value did not fit the type and
    was rescued), ``format:<f>`` (unparseable date-time), ``const:<f>``,
    ``enum:<f>``, ``minimum:<f>``, ``maximum:<f>``, ``unexpected:<key>``,
    ``malformed_json``. ``strict`` also rejects the producer-only extras
    (X2).

    Rows without rescued data, most of them, only run the checks that such a
    row can fail: no look-up of rescued keys, and none of types and unknown keys.
    """
    present = set(df.columns)
    has_rescued = RESCUED in present
    if has_rescued:
        df = df.withColumn("__rescued_keys", F.json_object_keys(RESCUED))
    keys = F.col("__rescued_keys")

    def checks(rescued: bool) -> list[Column]:
        out: list[Column] = []
        for f in contract.fields:
            known = f.name in present
            c = F.col(f.name) if known else F.lit(None)
            in_rescue = F.array_contains(keys, f.name) if rescued else None
            if f.name in contract.required:
                missing = c.isNull() if known else F.lit(True)
                out.append(F.when(missing & ~in_rescue if rescued else missing, F.lit(f"required:{f.name}")))
            if rescued:
                out.append(F.when(in_rescue, F.lit(f"type:{f.name}")))
            if not known:
                continue
            if f.type == "datetime":
                out.append(F.when(c.isNotNull() & F.try_to_timestamp(c.cast("string")).isNull(), F.lit(f"format:{f.name}")))
            if f.const is not None:
                out.append(F.when(c != F.lit(f.const), F.lit(f"const:{f.name}")))
            if f.enum is not None:
                out.append(F.when(~c.isin(*f.enum), F.lit(f"enum:{f.name}")))
            if f.minimum is not None:
                out.append(F.when(c < F.lit(f.minimum), F.lit(f"minimum:{f.name}")))
            if f.maximum is not None:
                out.append(F.when(c > F.lit(f.maximum), F.lit(f"maximum:{f.name}")))
        if CORRUPT in present:
            out.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json")))
        return out

    def codes(rescued: bool) -> Column:
        found = checks(rescued)
        none = F.array().cast("array<string>")
        # rows without any, most of them, don't go through the array
        return F.when(F.coalesce(*found).isNull(), none).otherwise(F.array_compact(F.array(*found))) if found else none

    violations = codes(False)
    if has_rescued:
        full = codes(True)
        if not contract.additional_properties:
            allowed = contract.field_names + ([] if strict else list(contract.extra_allowed))
            unexpected = F.filter(keys, lambda k: ~F.array_contains(F.array(*[F.lit(n) for n in allowed]), k))
            full = F.concat(full, F.transform(unexpected, lambda k: F.concat(F.lit("unexpected:"), k)))
        violations = F.when(keys.isNull(), violations).otherwise(full)
    return df.withColumn(VIOLATIONS, violations).drop("__rescued_keys")


def split_quarantine(df: DataFrame, *, key: str | None = "event_id") -> tuple[DataFrame, DataFrame]:
    """DQ-02: (valid, quarantined) by ``violations``; NULL keys are quarantined
    too (the reference would collapse them into one row, STR-04)."""
    bad = F.size(F.col(VIOLATIONS)) > 0
    if key:
        cleaned = F.nullif(F.trim(F.col(key)), F.lit(""))
        bad = bad | cleaned.isNull()
        reason = F.when(cleaned.isNull(), F.array_union(F.col(VIOLATIONS), F.array(F.lit(f"null_key:{key}"))))
        df = df.withColumn(VIOLATIONS, F.coalesce(reason, F.col(VIOLATIONS)))
    return df.where(~bad), df.where(bad)


def violation_kinds(checked: DataFrame, *, key: str = "event_id") -> DataFrame:
    """DQ-02 in one pass: (``key``, violations, n) - the rows of each list of violations, with and without a key,
    one of their keys for all of them. Few rows, on which :func:`split_quarantine` does what it does on all."""
    blank = F.nullif(F.trim(F.col(key)), F.lit("")).isNull()
    kinds = checked.select(VIOLATIONS, key, blank.alias("__blank")).groupBy(VIOLATIONS, "__blank").agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n"))
    ensure_shared_dir(checked.sparkSession)
    return kinds.drop("__blank").checkpoint(eager=True)


def quarantine_counts(df: DataFrame, *, rows: str | None = None) -> DataFrame:
    """Count of quarantined rows per violation code; ``rows`` names a column of the rows that a row stands for."""
    return (
        df.select(F.explode(VIOLATIONS).alias("violation"), (F.col(rows) if rows else F.lit(1)).cast("long").alias("rows"))
        .groupBy("violation")
        .agg(F.sum("rows").alias("rows"))
    )


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """DQ-03 / JON-03: fact rows whose non-null key is missing from the dim."""
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("__k")).where(F.col("__k").isNotNull())
    return fact.where(F.col(fact_key).isNotNull()).join(keys, F.col(fact_key) == F.col("__k"), "left_anti")


def valid_references(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """JON-03 valid side: fact rows whose key exists in the dim."""
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("__k"))
    return fact.join(keys, F.col(fact_key) == F.col("__k"), "left_semi")


def reference_report(fact: DataFrame, references: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """DQ-03: for each reference of ``fact`` its rows, NULLs, orphans, and distinct keys, from one scan and one join.

    ``references`` maps a name to (fact column, dimension, its key). All keys of
    a row are unpivoted at once and counted by (reference, key) before they
    meet the dimensions' keys, so a frequent key is one row there. A dimension
    may name a key twice; NULL names none.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(n).alias("reference"), F.col(c).cast("string").alias("key")) for n, (c, _, _) in references.items()]))
    used = fact.select(keys.alias("k")).groupBy("k.reference", "k.key").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for n, (_, dim, key) in references.items():
        part = dim.where(F.col(key).isNotNull()).select(F.lit(n).alias("reference"), F.col(key).cast("string").alias("key"))
        known = part if known is None else known.unionByName(part)
    met = used.join(known.distinct().withColumn("known", F.lit(True)), ["reference", "key"], "left")
    is_null = F.col("key").isNull()
    orphan = ~is_null & F.col("known").isNull()
    count = lambda when, what: F.coalesce(F.sum(F.when(when, what)), F.lit(0)).cast("bigint")
    return met.groupBy("reference").agg(
        F.sum("n").alias("rows"), count(is_null, F.col("n")).alias("null_rows"), count(orphan, F.col("n")).alias("orphan_rows"),
        count(~is_null, F.lit(1)).alias("keys"), count(orphan, F.lit(1)).alias("orphan_keys"),
    )


def line_amount_checks(lines: DataFrame, *, tolerance: Decimal = MONEY_TOLERANCE) -> DataFrame:
    """DQ-04: line amount = quantity x unit price. ``line_ok`` is NULL where one of the three is."""
    expected = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    return lines.withColumns({"expected_amount": expected, "line_ok": F.abs(F.col("line_amount") - expected) <= F.lit(tolerance)})


def reconcile_orders(
    lines: DataFrame,
    orders: DataFrame,
    *,
    key: str = "order_id",
    line_amount: str = "line_amount",
    order_amount: str = "gross_amount",
    tolerance: Decimal = MONEY_TOLERANCE,
) -> DataFrame:
    """DQ-04: Σ line amounts per order vs the order's amount.

    Lines are aggregated (map-side combined) before the join; one row per
    order with ``lines_total``, ``order_total``, ``diff`` and ``is_balanced``.
    """
    per_order = lines.groupBy(key).agg(
        F.sum(line_amount).alias("lines_total"), F.count(F.lit(1)).alias("line_count")
    )
    joined = orders.select(key, F.col(order_amount).alias("order_total")).join(per_order, key, "left")
    diff = F.coalesce(F.col("lines_total"), F.lit(0)) - F.col("order_total")
    return joined.withColumns({"diff": diff, "is_balanced": F.abs(diff) <= F.lit(tolerance)})


def order_amount_checks(orders: DataFrame) -> DataFrame:
    """DQ-04/08 on order_placed rows: tax = 8% of (gross - discount),
    net = gross - discount + shipping + tax, free shipping iff the cart value, i.e. gross, is ≥ 120."""
    g, d, s, t, n = (F.col(c) for c in ("gross_amount", "discount_amount", "shipping_amount", "tax_amount", "net_amount"))
    base = g - d
    return orders.withColumns(
        {
            "tax_ok": F.abs(t - F.round(base * F.lit(TAX_RATE), 2)) <= F.lit(MONEY_TOLERANCE),
            "net_ok": F.abs(n - (base + s + t)) <= F.lit(MONEY_TOLERANCE),
            "shipping_rule_ok": (s == F.lit(0)) == (g >= F.lit(FREE_SHIPPING_MIN_CART)),
        }
    )


def resolve_orders(events: DataFrame, *, order: str = "order_id", cart: str = "cart_id") -> DataFrame:
    """``events`` with the order of a cart's events that came before the order had an id.

    Checkouts name their cart only; payments and orders name both. Each cart's
    order (the smallest id, should there be several) is one row, joined to the
    events without an order. Events of carts that never led to an order keep none.
    """
    linked = events.where(F.col(order).isNotNull() & F.col(cart).isNotNull())
    linked = linked.groupBy(F.col(cart).alias("__cart")).agg(F.min(order).alias("__order"))
    open_ = events.where(F.col(order).isNull())
    found = open_.join(linked, F.col(cart) == F.col("__cart"), "left").withColumn(order, F.col("__order")).select(*events.columns)
    return events.where(F.col(order).isNotNull()).unionByName(found)


# Lifecycle stages in their required order.
LIFECYCLE_STAGES = (
    "checkout_started",
    "payment_attempted",
    "payment_succeeded",
    "order_placed",
    "shipment_created",
    "shipment_delivered",
    "return_requested",
    "return_completed",
)


def lifecycle_violations(
    events: DataFrame,
    *,
    key: str = "order_id",
    type_column: str = "event_type",
    ts_column: str = "event_ts",
    stages: Sequence[str] = LIFECYCLE_STAGES,
    cancel_stage: str = "order_cancelled",
) -> DataFrame:
    """DQ-05 / JON-04: one row per order with the first time of each stage,
    ``out_of_order`` (a later stage before an earlier one) and
    ``shipped_after_cancel``. One conditional aggregation, no self-joins."""
    aggs = [
        F.min(F.when(F.col(type_column) == F.lit(s), F.col(ts_column))).alias(f"{s}_ts") for s in (*stages, cancel_stage)
    ]
    per = events.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    pairs = []
    for i, a in enumerate(stages):
        for b in stages[i + 1:]:
            pairs.append(F.coalesce(F.col(f"{b}_ts") < F.col(f"{a}_ts"), F.lit(False)))
    out_of_order = pairs[0]
    for p in pairs[1:]:
        out_of_order = out_of_order | p
    shipped_after_cancel = F.coalesce(F.col("shipment_created_ts") > F.col(f"{cancel_stage}_ts"), F.lit(False))
    return per.withColumns({"out_of_order": out_of_order, "shipped_after_cancel": shipped_after_cancel})


def inventory_identity(inventory: DataFrame) -> DataFrame:
    """DQ-06: available = on_hand - reserved."""
    return inventory.withColumn(
        "identity_ok",
        F.col("available_qty") == F.col("on_hand_qty") - F.col("reserved_qty"),
    )


def lead_time_check(deliveries: DataFrame, shipments: DataFrame, *, key: str = "order_id", tolerance_hours: float = 1.0) -> DataFrame:
    """DQ-08: reported delivery lead time vs delivered - shipped."""
    ship = shipments.groupBy(key).agg(F.min("event_ts").alias("shipped_ts"))
    out = deliveries.join(ship, key, "left")
    actual = (F.col("event_ts").cast("double") - F.col("shipped_ts").cast("double")) / F.lit(3600.0)
    return out.withColumns(
        {"actual_lead_time_hours": actual, "lead_time_ok": F.abs(actual - F.col("delivery_lead_time_hours")) <= F.lit(tolerance_hours)}
    )
