"""Silver entity transforms (PRJ-01..10, FLT-01..12).

Each transform is a pure DataFrame -> DataFrame function that works on a
batch or a streaming input:

1. conform: columns the contract names but the input lacks become typed
   NULLs (X6), so a column never seen in landed data still resolves;
2. one projection of cleaning + casts (``withColumns`` replaces in place,
   columns the transform does not name pass through unchanged);
3. one projection of derived flags / graph keys over the *cleaned* values;
4. standard metadata (date / hour / year / source file / processed-at);
5. dedup on ``event_id`` (streaming: watermark state; batch: deterministic
   earliest row, see streaming.dedup).

Malformed numbers and timestamps become NULL through ``try_cast`` /
``try_to_timestamp`` instead of failing the job under ANSI mode; the
contract check (operators.quality) reports them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_spark.functions.columns import (
    MONEY,
    as_json_text,
    cleaned_string,
    line_amount,
    money,
    parse_ts,
    percent,
    try_bool,
    try_double,
    try_int,
    zero_money,
)
from retail_spark.streaming.dedup import deduplicate

# kind -> (type used for a missing column, expression builder)
_KINDS = {
    "ts": ("string", parse_ts),
    "str": ("string", lambda c: cleaned_string(c)),
    "lower": ("string", lambda c: cleaned_string(c, lower_case=True)),
    "upper": ("string", lambda c: cleaned_string(c, upper_case=True)),
    "int": ("string", try_int),
    "bool": ("boolean", try_bool),
    "money": ("string", money),
    "pct": ("string", percent),
    "double": ("string", try_double),
}


def _of(kind: str, names: Sequence[str]) -> list[tuple[str, str]]:
    """(column, cleaning kind) for each of ``names``."""
    return [(n, kind) for n in names]


def clean_columns(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Conform (missing -> typed NULL) and clean/cast ``spec`` columns in one projection."""
    present = set(df.columns)
    exprs: dict[str, Column] = {}
    for name, kind in spec:
        missing_type, build = _KINDS[kind]
        src = F.col(name) if name in present else F.lit(None).cast(missing_type)
        exprs[name] = build(src)
    return df.withColumns(exprs)


def add_standard_metadata(
    df: DataFrame, *, timestamp_column: str, date_column: str, processed_at: bool = True
) -> DataFrame:
    """PRJ-09: event date / hour / year (session time zone), source file, processed-at."""
    ts = F.col(timestamp_column)
    cols: dict[str, Column] = {
        date_column: F.to_date(ts),
        "event_hour": F.hour(ts),
        "event_year": F.year(ts),
    }
    if "source_file" not in df.columns:
        # the landing reader captures _metadata.file_path at the scan (FN-11)
        cols["source_file"] = F.lit(None).cast("string")
    if processed_at:
        cols["silver_processed_at"] = F.current_timestamp()
    return df.withColumns(cols)


# ---------------------------------------------------------------------------
# Per-entity cleaning modes and status vocabularies.
# ---------------------------------------------------------------------------

CLICKS_CLEAN = [
    *_of("ts", ("occurred_at",)),
    *_of("str", (
        "event_id", "generator_instance_id", "customer_id", "session_id", "product_id", "flow_id",
        "campaign_id", "app_version", "experiment_id", "component_id", "search_query",
        "recommendation_request_id", "seed_product_id"
    )),
    *_of("lower", (
        "event_type", "customer_segment", "page", "action", "source", "channel", "source_medium", "referrer",
        "device_type", "os", "locale", "experiment_variant", "journey_step", "onboarding_step",
        "component_type", "sort_order", "recommendation_model", "recommendation_source"
    )),
    *_of("upper", ("customer_country",)),
    *_of("bool", ("is_logged_in",)),
    *_of("int", (
        "event_position", "recommendation_rank", "page_load_time_ms", "component_load_time_ms",
        "time_on_previous_page_ms", "session_elapsed_ms", "scroll_depth_pct", "product_impression_count"
    )),
]

PURCHASES_CLEAN = [
    *_of("ts", ("occurred_at",)),
    *_of("str", (
        "event_id", "generator_instance_id", "customer_id", "session_id", "order_id", "product_id",
        "product_sku", "product_brand", "flow_id", "campaign_id"
    )),
    *_of("lower", (
        "event_type", "customer_segment", "product_category", "channel", "source_medium", "device_type",
        "cross_sell_source"
    )),
    *_of("upper", ("customer_country", "coupon_code", "currency")),
    *_of("int", ("quantity", "order_item_count", "order_item_index")),
    *_of("money", ("unit_price", "amount", "discount_amount", "order_total_amount")),
    *_of("pct", ("discount_pct",)),
    *_of("bool", ("is_first_purchase",)),
]

TRANSACTIONS_CLEAN = [
    *_of("ts", ("occurred_at",)),
    *_of("str", (
        "event_id", "generator_instance_id", "customer_id", "session_id", "transaction_id", "order_id",
        "flow_id"
    )),
    *_of("lower", ("event_type", "payment_method", "status")),
    *_of("money", ("amount",)),
]

SUPPORT_TICKETS_CLEAN = [
    *_of("ts", ("occurred_at",)),
    *_of("str", ("event_id", "ticket_id", "customer_id")),
    *_of("lower", ("event_type", "category", "priority", "status")),
]

FACT_ENVELOPE_CLEAN = [
    *_of("ts", ("event_ts",)),
    *_of("str", (
        "event_id", "session_id", "customer_id", "product_id", "cart_id", "order_id", "campaign_id"
    )),
    *_of("lower", ("event_type", "device_type", "platform", "page_type", "referrer")),
    *_of("upper", ("currency",)),
    *_of("int", ("quantity",)),
    *_of("money", ("unit_price",)),
]

SUCCESS_STATUSES = ("success", "succeeded", "approved", "paid")
FAILED_STATUSES = ("failed", "declined", "rejected")
OPEN_TICKET_STATUSES = ("new", "open", "pending")
RESOLVED_TICKET_STATUSES = ("resolved", "closed")
COMMERCE_EVENTS = ("add_to_cart", "remove_from_cart", "checkout_started", "order_placed")
FULFILLMENT_EVENTS = ("shipment_created", "shipment_delivered")
RETURN_EVENTS = ("return_requested", "return_completed")
SUPPORT_EVENT = "support_ticket_created"

# attributes keys extracted by the fact transform: (output, json key(s), kind)
# kind: clean-mode for strings, or a cast for numbers; search_query is the
# coalesce of `query` then `search_query`, taken before cleaning.
FACT_ATTRIBUTES = (
    ("flow_id", ("flow_id",), "str"),
    ("channel", ("channel",), "lower"),
    ("source", ("source",), "lower"),
    ("medium", ("medium",), "lower"),
    ("customer_segment_seed", ("customer_segment_seed",), "lower"),
    ("step_index", ("step_index",), "int"),
    ("search_query", ("query", "search_query"), "str"),
    ("results_category", ("results_category",), "lower"),
    ("category_name", ("category_name",), "lower"),
    ("brand", ("brand",), "str"),
    ("cart_item_count", ("cart_item_count",), "int"),
    ("cart_value", ("cart_value",), "money"),
    ("distinct_items", ("distinct_items",), "int"),
    ("payment_method", ("payment_method",), "lower"),
    ("attempted_amount", ("attempted_amount",), "money"),
    ("gross_amount", ("gross_amount",), "money"),
    ("discount_amount", ("discount_amount",), "money"),
    ("shipping_amount", ("shipping_amount",), "money"),
    ("tax_amount", ("tax_amount",), "money"),
    ("net_amount", ("net_amount",), "money"),
    ("item_count", ("item_count",), "int"),
    ("distinct_skus", ("distinct_skus",), "int"),
    ("reason", ("reason",), "lower"),
    ("refund_amount", ("refund_amount",), "money"),
    ("return_resolution", ("return_resolution",), "lower"),
    ("ticket_reason", ("ticket_reason",), "lower"),
    ("priority", ("priority",), "lower"),
    ("delivery_lead_time_hours", ("delivery_lead_time_hours",), "double"),
    ("promised_sla_days", ("promised_sla_days",), "int"),
    ("order_items_json", ("order_items",), "raw"),
    # emitted by the producer but not extracted upstream; additive columns
    ("warehouse_id_attr", ("warehouse_id",), "str"),
    ("shipment_carrier", ("shipment_carrier",), "lower"),
    ("requested_amount", ("requested_amount",), "money"),
)


def _finish(df: DataFrame, *, timestamp_column: str, date_column: str, dedup: str) -> DataFrame:
    df = add_standard_metadata(df, timestamp_column=timestamp_column, date_column=date_column)
    return deduplicate(df, timestamp_column=timestamp_column, mode=dedup)


def transform_clicks(df: DataFrame, *, dedup: str = "within_watermark") -> DataFrame:
    """PRJ-03: clicks -> silver.clicks."""
    filters = as_json_text(df, "search_filters") if "search_filters" in df.columns else F.lit(None).cast("string")
    df = clean_columns(df, CLICKS_CLEAN).withColumn("search_filters_json", filters)
    df = df.withColumns(
        {
            "has_product_context": F.col("product_id").isNotNull(),
            "is_search_interaction": (F.col("page") == F.lit("search")) | F.col("search_query").isNotNull(),
            "is_recommendation_interaction": F.col("recommendation_request_id").isNotNull(),
            "is_experiment_interaction": F.col("experiment_id").isNotNull(),
            "graph_target_product_id": F.col("product_id"),
            "graph_interaction_type": F.col("action"),
        }
    )
    if "search_filters" in df.columns:
        df = df.drop("search_filters")
    return _finish(df, timestamp_column="occurred_at", date_column="occurred_date", dedup=dedup)


def transform_clicks_light(df: DataFrame) -> DataFrame:
    """PRJ-04: the light clicks variant (no cleaning, no dedup, no metadata).

    ``ingest_date`` comes from the snapshot layout; event files land under
    ``dt=`` (X10), which is used when ``ingest_date`` is absent.
    """
    date_src = "ingest_date" if "ingest_date" in df.columns else ("dt" if "dt" in df.columns else None)
    present = set(df.columns)

    def src(name: str, t: str = "string") -> Column:
        return F.col(name) if name in present else F.lit(None).cast(t)

    cols = {
        "occurred_at": parse_ts(src("occurred_at")),
        "campaign_id": F.nullif(src("campaign_id"), F.lit("")),
        "ingest_date": F.to_date(F.col(date_src).cast("string")) if date_src else F.lit(None).cast("date"),
        "is_logged_in": try_bool(src("is_logged_in", "boolean")),
        "component_load_time_ms": try_int(src("component_load_time_ms")),
        "page_load_time_ms": try_int(src("page_load_time_ms")),
        "session_elapsed_ms": try_int(src("session_elapsed_ms")),
        "time_on_previous_page_ms": try_int(src("time_on_previous_page_ms")),
    }
    out = df.withColumns(cols)
    return out.drop("product_impression_count") if "product_impression_count" in out.columns else out


def transform_purchases(df: DataFrame, *, dedup: str = "within_watermark", only_duplicated_keys: bool = False) -> DataFrame:
    """PRJ-05: purchases -> silver.purchases (derived amounts read the decimal casts).

    A batch is deduplicated before columns are derived from others, which can't
    break a tie; with ``only_duplicated_keys`` it is read twice (streaming.dedup).
    """
    df = clean_columns(df, PURCHASES_CLEAN)
    if not df.isStreaming:
        df = deduplicate(df, timestamp_column="occurred_at", mode=dedup, only_duplicated_keys=only_duplicated_keys)
        dedup = "none"
    zero = zero_money()
    df = df.withColumns(
        {
            "net_item_amount": (F.coalesce("amount", zero) - F.coalesce("discount_amount", zero)).cast(MONEY),
            "gross_item_amount": line_amount("unit_price", "quantity"),
            "is_discounted": F.coalesce("discount_amount", zero) > zero,
            "is_repeat_purchase": ~F.coalesce(F.col("is_first_purchase"), F.lit(False)),
            "graph_customer_id": F.col("customer_id"),
            "graph_product_id": F.col("product_id"),
            "graph_order_id": F.col("order_id"),
        }
    )
    return _finish(df, timestamp_column="occurred_at", date_column="occurred_date", dedup=dedup)


def status_flags(
    status: Column,
    success: Sequence[str] = SUCCESS_STATUSES,
    failed: Sequence[str] = FAILED_STATUSES,
) -> dict[str, Column]:
    """FLT-06/07: success/failed flags (NULL status -> NULL) and status group."""
    return {
        "is_successful": status.isin(*success),
        "is_failed": status.isin(*failed),
        "status_group": F.when(status.isin(*success), F.lit("successful"))
        .when(status.isin(*failed), F.lit("failed"))
        .otherwise(F.lit("other")),
    }


def transform_transactions(
    df: DataFrame,
    *,
    dedup: str = "within_watermark",
    success: Sequence[str] = SUCCESS_STATUSES,
    failed: Sequence[str] = FAILED_STATUSES,
) -> DataFrame:
    """PRJ-06: transactions -> silver.transactions."""
    df = clean_columns(df, TRANSACTIONS_CLEAN)
    df = df.withColumns(status_flags(F.col("status"), success, failed))
    return _finish(df, timestamp_column="occurred_at", date_column="occurred_date", dedup=dedup)


def transform_support_tickets(df: DataFrame, *, dedup: str = "within_watermark") -> DataFrame:
    """PRJ-07: support tickets -> silver.support_tickets."""
    df = clean_columns(df, SUPPORT_TICKETS_CLEAN)
    df = df.withColumns(
        {
            "is_open": F.col("status").isin(*OPEN_TICKET_STATUSES),
            "is_resolved": F.col("status").isin(*RESOLVED_TICKET_STATUSES),
        }
    )
    return _finish(df, timestamp_column="occurred_at", date_column="occurred_date", dedup=dedup)


ATTRIBUTE_KEYS = tuple(sorted({k for _, keys, _ in FACT_ATTRIBUTES for k in keys}))
ATTRIBUTES_AS_TEXT = T.StructType([T.StructField(k, T.StringType()) for k in ATTRIBUTE_KEYS])


def _attribute_expr(parsed: Column, keys: tuple[str, ...], kind: str) -> Column:
    """One attribute from the parsed struct (every key read as JSON text:
    strings unquoted, numbers/booleans as written, objects/arrays as JSON)."""
    raw = F.coalesce(*[parsed.getField(k) for k in keys]) if len(keys) > 1 else parsed.getField(keys[0])
    if kind == "raw":
        return raw
    return _KINDS[kind][1](raw)


def event_flags(event_type: Column) -> dict[str, Column]:
    """FLT-09..12 over the cleaned event type."""
    return {
        "is_commerce_event": event_type.isin(*COMMERCE_EVENTS),
        "is_fulfillment_event": event_type.isin(*FULFILLMENT_EVENTS),
        "is_return_event": event_type.isin(*RETURN_EVENTS),
        "is_support_event": event_type == F.lit(SUPPORT_EVENT),
    }


def transform_fact_event_raw(df: DataFrame, *, dedup: str = "within_watermark") -> DataFrame:
    """PRJ-08: fact_event_raw -> silver.fact_event_raw.

    ``attributes`` may be a JSON string (schema inference), struct, map or
    variant; it is turned into JSON text once (``attributes_json``) and each
    wanted key is read from it with ``get_json_object``.
    """
    attrs = as_json_text(df, "attributes") if "attributes" in df.columns else F.lit(None).cast("string")
    df = clean_columns(df, FACT_ENVELOPE_CLEAN).withColumn("attributes_json", attrs)
    # one JSON parse per row for all ~35 keys (instead of one
    # get_json_object scan of the text per key)
    df = df.withColumn("__attrs", F.from_json(F.col("attributes_json"), ATTRIBUTES_AS_TEXT))
    parsed = F.col("__attrs")
    extracted = {name: _attribute_expr(parsed, keys, kind) for name, keys, kind in FACT_ATTRIBUTES}
    df = df.withColumns(extracted).drop("__attrs")
    df = df.withColumns(
        {
            "event_amount": F.coalesce(
                F.col("net_amount"),
                F.col("gross_amount"),
                F.col("attempted_amount"),
                F.col("refund_amount"),
                line_amount("unit_price", "quantity"),
            ),
            **event_flags(F.col("event_type")),
            "graph_customer_id": F.col("customer_id"),
            "graph_product_id": F.col("product_id"),
            "graph_order_id": F.col("order_id"),
            "graph_interaction_type": F.col("event_type"),
        }
    )
    if "attributes" in df.columns:
        df = df.drop("attributes")
    return _finish(df, timestamp_column="event_ts", date_column="event_date", dedup=dedup)


TRANSFORMS = {
    "clicks": transform_clicks,
    "purchases": transform_purchases,
    "transactions": transform_transactions,
    "support_tickets": transform_support_tickets,
    "fact_event_raw": transform_fact_event_raw,
}
