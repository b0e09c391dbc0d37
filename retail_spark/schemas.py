"""Event contracts, master-data schemas and the order-items JSON shape.

Contracts are plain data: the contract check (operators.quality) compiles
them into one Spark projection; the read schemas below are derived from them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str  # string | datetime | integer | number | boolean | object
    nullable: bool = False  # JSON-schema ["<type>", "null"]
    minimum: float | None = None
    maximum: float | None = None
    const: str | None = None
    enum: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    required: tuple[str, ...]
    fields: tuple[Field, ...]
    additional_properties: bool = False
    timestamp_column: str = "occurred_at"
    date_column: str = "occurred_date"
    extra_allowed: tuple[str, ...] = field(default_factory=tuple)

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]


def _s(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, "string") for n in names)


# ---------------------------------------------------------------------------
# The five v1 event contracts (field names, JSON types,
# required keys, const/enum values and numeric bounds), as published with
# the event producer. Order follows the contract documents.
# ---------------------------------------------------------------------------

EVENT_TYPES_V1 = (
    "session_started",
    "page_view",
    "product_view",
    "search_performed",
    "add_to_cart",
    "remove_from_cart",
    "checkout_started",
    "payment_attempted",
    "payment_succeeded",
    "payment_failed",
    "order_placed",
    "order_cancelled",
    "shipment_created",
    "shipment_delivered",
    "return_requested",
    "return_completed",
    "support_ticket_created",
)

CLICKS_V1 = Contract(
    name="clicks",
    required=("event_id", "event_type", "occurred_at", "generator_instance_id", "customer_id",
              "session_id", "page", "action", "flow_id"),
    fields=(
        Field("event_id", "string"),
        Field("event_type", "string", const="click"),
        Field("occurred_at", "datetime"),
        *_s("generator_instance_id", "customer_id", "customer_country", "customer_segment", "session_id"),
        Field("product_id", "string", nullable=True),
        *_s("page", "action", "flow_id", "source", "channel", "campaign_id", "source_medium", "referrer",
            "device_type", "os", "app_version", "locale"),
        Field("is_logged_in", "boolean"),
        *_s("experiment_id", "experiment_variant", "journey_step", "onboarding_step", "component_id",
            "component_type"),
        Field("event_position", "integer", minimum=0),
        Field("search_query", "string"),
        Field("search_filters", "object"),
        *_s("sort_order", "recommendation_model", "recommendation_source", "recommendation_request_id"),
        Field("recommendation_rank", "integer", minimum=1),
        Field("seed_product_id", "string", nullable=True),
        Field("page_load_time_ms", "integer", minimum=0),
        Field("component_load_time_ms", "integer", minimum=0),
        Field("time_on_previous_page_ms", "integer", minimum=0),
        Field("session_elapsed_ms", "integer", minimum=0),
        Field("scroll_depth_pct", "integer", minimum=0, maximum=100),
        Field("product_impression_count", "integer", minimum=0),
    ),
)

PURCHASES_V1 = Contract(
    name="purchases",
    required=("event_id", "event_type", "occurred_at", "generator_instance_id", "customer_id",
              "session_id", "order_id", "product_id", "quantity", "amount", "flow_id"),
    fields=(
        Field("event_id", "string"),
        Field("event_type", "string", const="purchase"),
        Field("occurred_at", "datetime"),
        *_s("generator_instance_id", "customer_id", "customer_country", "customer_segment", "session_id",
            "order_id", "product_id", "product_sku", "product_category", "product_brand"),
        Field("quantity", "integer", minimum=1),
        Field("unit_price", "number", minimum=0),
        Field("amount", "number", minimum=0),
        Field("discount_amount", "number", minimum=0),
        Field("discount_pct", "number", minimum=0, maximum=100),
        *_s("coupon_code", "currency"),
        Field("order_total_amount", "number", minimum=0),
        Field("order_item_count", "integer", minimum=1),
        Field("order_item_index", "integer", minimum=1),
        *_s("flow_id", "channel", "campaign_id", "source_medium", "device_type"),
        Field("is_first_purchase", "boolean"),
        Field("cross_sell_source", "string"),
    ),
)

TRANSACTIONS_V1 = Contract(
    name="transactions",
    required=("event_id", "event_type", "occurred_at", "generator_instance_id", "customer_id",
              "session_id", "transaction_id", "order_id", "payment_method", "status", "amount", "flow_id"),
    fields=(
        Field("event_id", "string"),
        Field("event_type", "string", const="transaction"),
        Field("occurred_at", "datetime"),
        *_s("generator_instance_id", "customer_id", "session_id", "transaction_id", "order_id",
            "payment_method", "status"),
        Field("amount", "number", minimum=0),
        Field("flow_id", "string"),
    ),
)

SUPPORT_TICKETS_V1 = Contract(
    name="support_tickets",
    required=("event_id", "event_type", "occurred_at", "ticket_id", "customer_id", "category",
              "priority", "status"),
    fields=(
        Field("event_id", "string"),
        Field("event_type", "string", const="support_ticket"),
        Field("occurred_at", "datetime"),
        *_s("ticket_id", "customer_id", "category", "priority", "status"),
    ),
)

FACT_EVENT_RAW_V1 = Contract(
    name="fact_event_raw",
    required=("event_id", "event_ts", "event_type", "session_id", "device_type", "platform", "referrer",
              "currency", "attributes"),
    fields=(
        Field("event_id", "string"),
        Field("event_ts", "datetime"),
        Field("event_type", "string", enum=EVENT_TYPES_V1),
        Field("session_id", "string"),
        Field("customer_id", "string", nullable=True),
        Field("product_id", "string", nullable=True),
        Field("cart_id", "string", nullable=True),
        Field("order_id", "string", nullable=True),
        Field("campaign_id", "string", nullable=True),
        Field("device_type", "string"),
        Field("platform", "string"),
        Field("page_type", "string", nullable=True),
        Field("referrer", "string"),
        Field("quantity", "integer", nullable=True, minimum=1),
        Field("unit_price", "number", nullable=True, minimum=0),
        Field("currency", "string"),
        Field("attributes", "object"),
    ),
    timestamp_column="event_ts",
    date_column="event_date",
    # X2: the producer also emits warehouse_id; allowed unless strict=True.
    extra_allowed=("warehouse_id",),
)

CONTRACTS: dict[str, Contract] = {
    c.name: c for c in (CLICKS_V1, PURCHASES_V1, TRANSACTIONS_V1, SUPPORT_TICKETS_V1, FACT_EVENT_RAW_V1)
}

_JSON_TO_SPARK = {
    "string": T.StringType(),
    "datetime": T.StringType(),  # parsed by the transform (try_to_timestamp)
    "object": T.StringType(),  # JSON reader keeps an object's raw text for a string field
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def read_schema(contract: Contract, *, include_extra: bool = True) -> T.StructType:
    """Landing-zone read schema for a contract: every field nullable."""
    fields = [T.StructField(f.name, _JSON_TO_SPARK[f.type], True) for f in contract.fields]
    if include_extra:
        fields += [T.StructField(n, T.StringType(), True) for n in contract.extra_allowed]
    return T.StructType(fields)


# Fields of order_placed attributes.order_items[] (FN-21)
ORDER_ITEMS_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("sku", T.StringType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("unit_price", T.DecimalType(18, 2)),
            T.StructField("line_amount", T.DecimalType(18, 2)),
        ]
    )
)

# Fields of the master data files (SRC-08), one JSON array of objects per file.
CUSTOMERS_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ("customer_id", "first_name", "last_name", "email", "country", "segment", "created_at")]
)
PRODUCTS_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("product_id", "sku", "name", "category", "brand")]
    + [T.StructField("price", T.DoubleType()), T.StructField("active", T.BooleanType()),
       T.StructField("created_at", T.StringType())]
)
CAMPAIGNS_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ("campaign_id", "channel", "source", "medium", "campaign_name")]
    + [T.StructField("start_date", T.DateType()), T.StructField("end_date", T.DateType()),
       T.StructField("daily_budget", T.DoubleType())]
)
WAREHOUSES_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("warehouse_id", "warehouse_name", "region")]
)
INVENTORY_SCHEMA = T.StructType(
    [T.StructField("snapshot_ts", T.TimestampType()), T.StructField("warehouse_id", T.StringType()),
     T.StructField("product_id", T.StringType())]
    + [T.StructField(n, T.IntegerType()) for n in ("on_hand_qty", "reserved_qty", "available_qty")]
)

MASTER_SCHEMAS = {
    "customers": CUSTOMERS_SCHEMA,
    "products": PRODUCTS_SCHEMA,
    "campaigns": CAMPAIGNS_SCHEMA,
    "warehouses": WAREHOUSES_SCHEMA,
    "inventory": INVENTORY_SCHEMA,
}
