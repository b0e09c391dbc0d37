"""Gold business metrics (AGG-01..17).

Inputs are Silver ``fact_event_raw``-shaped DataFrames (event_type,
event_ts, session_id, customer_id, product_id, order_id, channel, money
columns, ...). Every metric is a grouped aggregation that Spark combines
map-side; distinct counts are pre-reduced to (group, id) pairs before the
shuffle. Money sums stay decimal (exact) and ratios are computed at the end
with ``try_divide`` (NULL when the denominator is 0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_spark.schemas import ORDER_ITEMS_SCHEMA

ORDER = "order_placed"


def _t(name: str, type_column: str = "event_type") -> Column:
    return F.col(type_column) == F.lit(name)


def orders_only(events: DataFrame, type_column: str = "event_type") -> DataFrame:
    return events.where(_t(ORDER, type_column))


def sessions_by_channel(events: DataFrame, *, by: Sequence[str] = ("channel",)) -> DataFrame:
    """AGG-01: distinct sessions started, per channel."""
    return (
        events.where(_t("session_started"))
        .groupBy(*by)
        .agg(F.count_distinct("session_id").alias("sessions"))
    )


def session_rollup(events: DataFrame, *, session_column: str = "session_id", ts_column: str = "event_ts") -> DataFrame:
    """AGG-16: one row per session - first/last time, counts per funnel step,
    session attributes from its start event, conversion flag. Events
    without a session id belong to no session."""
    events = events.where(F.col(session_column).isNotNull())
    t = F.col("event_type")
    start = _t("session_started")
    return events.groupBy(session_column).agg(
        F.min(ts_column).alias("first_ts"),
        F.max(ts_column).alias("last_ts"),
        F.count(F.lit(1)).alias("events"),
        F.min(F.when(start, F.col("channel"))).alias("channel"),
        F.min(F.when(start, F.col("customer_segment_seed"))).alias("customer_segment"),
        F.min("customer_id").alias("customer_id"),
        F.count_if(t == "product_view").alias("product_views"),
        F.count_if(t == "add_to_cart").alias("add_to_carts"),
        F.count_if(t == "checkout_started").alias("checkouts"),
        F.count_if(t == ORDER).alias("orders"),
        F.bool_or(t == ORDER).alias("converted"),
    )


def conversion_rate(events: DataFrame, *, by: Sequence[str] = ("channel",)) -> DataFrame:
    """AGG-02: sessions with at least one order ÷ sessions, per ``by``
    (session attributes, e.g. channel / customer_segment / session_date)."""
    sessions = session_rollup(events).withColumn("session_date", F.to_date("first_ts"))
    return (
        sessions.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("sessions"), F.count_if("converted").alias("converted_sessions"))
        .withColumn("conversion_rate", F.try_divide(F.col("converted_sessions").cast("double"), F.col("sessions").cast("double")))
    )


def revenue_by_campaign(events: DataFrame, campaigns: DataFrame | None = None, *, top_n: int | None = None) -> DataFrame:
    """AGG-03 (+JON-02, SRT-01): Σ net amount of orders by campaign; the top
    ``top_n`` by revenue (ties by campaign id) when given."""
    rev = orders_only(events).groupBy("campaign_id").agg(
        F.sum("net_amount").alias("revenue"), F.count_distinct("order_id").alias("orders")
    )
    if campaigns is not None:
        rev = rev.join(campaigns, "campaign_id", "left")
    if top_n:
        # SRT-01: distributed top-k (per-partition top-k, then a k-row merge)
        return rev.orderBy(F.desc("revenue"), F.asc("campaign_id")).limit(top_n)
    return rev


def sales_kpis(events: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """AGG-04/05/06/13/14: GMV, orders, AOV, net revenue, discount rate.

    GMV = Σ gross of orders; orders = distinct order ids; AOV = GMV ÷ orders;
    net revenue = Σ net of orders - Σ refunds (cancellations, completed
    returns); net merchandise = gross - discount - refunds; discount rate =
    Σ discount ÷ Σ gross.
    """
    is_order = _t(ORDER)
    refund_evt = F.col("event_type").isin("order_cancelled", "return_completed")
    def total(when: Column, column: str) -> Column:
        # a group without such rows, or with NULL amounts only, has a total of 0
        return F.coalesce(F.sum(F.when(when, F.col(column))), F.lit(0).cast("decimal(18,2)"))

    agg = events.groupBy(*by).agg(
        total(is_order, "gross_amount").alias("gmv"),
        F.count_distinct(F.when(is_order, F.col("order_id"))).alias("orders"),
        total(is_order, "discount_amount").alias("discount"),
        total(is_order, "net_amount").alias("net_sales"),
        total(refund_evt, "refund_amount").alias("refunds"),
    )
    return agg.withColumns(
        {
            "aov": F.try_divide(F.col("gmv").cast("double"), F.col("orders").cast("double")),
            "net_revenue": F.col("net_sales") - F.col("refunds"),
            "net_merchandise": F.col("gmv") - F.col("discount") - F.col("refunds"),
            "discount_rate": F.try_divide(F.col("discount").cast("double"), F.col("gmv").cast("double")),
        }
    )


def attribute_refunds(events: DataFrame, *, attrs: Sequence[str] = ("channel",)) -> DataFrame:
    """Refund events take the attributes of their order (JON-01 for AGG-13).

    Only orders and session starts carry a channel, so without this a
    channel's refunds would be counted under none. One row an order (combined
    map-side) is joined back on the order id; rows without an order keep theirs.
    """
    refund = F.col("event_type").isin("order_cancelled", "return_completed") & F.col("order_id").isNotNull()
    per_order = orders_only(events).where(F.col("order_id").isNotNull()).groupBy(F.col("order_id").alias("__order")).agg(
        *[F.min(a).alias(f"__{a}") for a in attrs]
    )
    refunds = events.where(refund).join(per_order, F.col("order_id") == F.col("__order"), "left")
    refunds = refunds.withColumns({a: F.coalesce(F.col(a), F.col(f"__{a}")) for a in attrs}).select(*events.columns)
    return events.where(~F.coalesce(refund, F.lit(False))).unionByName(refunds)


def product_views(events: DataFrame) -> DataFrame:
    """AGG-07: product_view events per product; product-page page views apart."""
    return events.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count_if(_t("product_view")).alias("product_views"),
        F.count_if(_t("page_view") & (F.col("page_type") == F.lit("product"))).alias("product_page_views"),
    )


def view_to_cart(events: DataFrame) -> DataFrame:
    """AGG-08: per product, distinct sessions that viewed it, that carted it,
    and carts ÷ views. Two-level aggregation: (session, product) first."""
    pairs = (
        events.where(F.col("product_id").isNotNull() & F.col("event_type").isin("product_view", "add_to_cart"))
        .groupBy("product_id", "session_id")
        .agg(F.bool_or(_t("product_view")).alias("viewed"), F.bool_or(_t("add_to_cart")).alias("carted"))
    )
    return pairs.groupBy("product_id").agg(
        F.count_if("viewed").alias("view_sessions"),
        F.count_if("carted").alias("cart_sessions"),
    ).withColumn(
        "view_to_cart_rate", F.try_divide(F.col("cart_sessions").cast("double"), F.col("view_sessions").cast("double"))
    )


def order_lines(events: DataFrame) -> DataFrame:
    """FN-21: order_placed rows exploded into their order_items."""
    items = F.from_json(F.col("order_items_json"), ORDER_ITEMS_SCHEMA)
    return (
        orders_only(events)
        .select("order_id", "event_ts", "customer_id", F.posexplode(items).alias("line_index", "item"))
        .select("order_id", "event_ts", "customer_id", (F.col("line_index") + 1).alias("line_number"), "item.*")
    )


def product_revenue(events: DataFrame) -> DataFrame:
    """AGG-09: Σ line amount and units per product from exploded order items."""
    return order_lines(events).groupBy("product_id").agg(
        F.sum("line_amount").alias("revenue"),
        F.sum("quantity").cast("long").alias("units"),
        F.count_distinct("order_id").alias("orders"),
    )


def inventory_available(inventory: DataFrame, *, by: Sequence[str] = ("product_id",)) -> DataFrame:
    """AGG-10 (+WIN-02): latest snapshot per (warehouse, product), Σ available.

    The latest row is ``max(struct(snapshot_ts, ...))`` per key - a
    combinable aggregation rather than a sorted window per key.
    """
    latest = inventory.groupBy("warehouse_id", "product_id").agg(
        F.max(F.struct("snapshot_ts", "available_qty", "on_hand_qty", "reserved_qty")).alias("s")
    )
    return latest.groupBy(*by).agg(
        F.sum("s.available_qty").cast("long").alias("available_qty"),
        F.sum("s.on_hand_qty").cast("long").alias("on_hand_qty"),
        F.max("s.snapshot_ts").alias("as_of"),
    )


def delivery_lead_time(
    deliveries: DataFrame,
    *,
    by: Sequence[str] = (),
    hours_column: str = "delivery_lead_time_hours",
    sla_days_column: str | None = "promised_sla_days",
    exact: bool = False,
    accuracy: int = 10000,
) -> DataFrame:
    """AGG-11: avg / p50 / p90 lead time and SLA breach share.

    ``percentile_approx`` has bounded memory; ``exact`` uses ``percentile``,
    whose buffer is a count per distinct value of a group: for values that
    are few by nature, such as whole days.
    """
    h = F.col(hours_column).cast("double")
    if exact:
        p50, p90 = F.percentile(h, F.lit(0.5)), F.percentile(h, F.lit(0.9))
    else:
        p50, p90 = F.percentile_approx(h, 0.5, accuracy), F.percentile_approx(h, 0.9, accuracy)
    aggs = [
        F.count(h).alias("deliveries"),
        F.avg(h).alias("avg_hours"),
        p50.alias("p50_hours"),
        p90.alias("p90_hours"),
    ]
    if sla_days_column:
        breach = h > F.col(sla_days_column).cast("double") * F.lit(24.0)
        aggs.append(F.try_divide(F.count_if(breach).cast("double"), F.count(h).cast("double")).alias("sla_breach_share"))
    return deliveries.where(h.isNotNull()).groupBy(*by).agg(*aggs)


def return_rate(events: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """AGG-12: orders with a return request ÷ delivered orders.

    One row per order by conditional aggregation (no lifecycle self-join)."""
    per_order = events.where(F.col("order_id").isNotNull()).groupBy("order_id", *by).agg(
        F.bool_or(_t("shipment_delivered")).alias("delivered"),
        F.bool_or(_t("return_requested")).alias("returned"),
    )
    return per_order.groupBy(*by).agg(
        F.count_if("delivered").alias("delivered_orders"),
        F.count_if(F.col("delivered") & F.col("returned")).alias("returned_orders"),
    ).withColumn(
        "return_rate", F.try_divide(F.col("returned_orders").cast("double"), F.col("delivered_orders").cast("double"))
    )


def allocate_discount(
    lines: DataFrame,
    orders: DataFrame,
    *,
    order: str = "order_id",
    amount: str = "line_amount",
    discount: str = "discount_amount",
    sort: Sequence[str] = ("line_number",),
    name: str = "allocated_discount",
) -> DataFrame:
    """AGG-15: ``lines`` with the line's part of its order's discount, in whole cents that add up to it.

    Parts are in proportion to ``amount``, by largest remainder: each line gets
    the whole cents of its share, and the cents left over go to the lines with
    the largest remainders, ties in order of ``sort``. NULL and negative
    amounts weigh nothing; if no line of an order weighs, all weigh alike.
    Lines without an order, or whose order has no discount, get 0. Everything
    is integer arithmetic. An order's lines came in one event, so a window
    holds few rows; lines without an order take no part in it.
    """
    total = orders.where(F.col(order).isNotNull() & F.col(discount).isNotNull()).select(F.col(order).alias("__order"), F.col(discount).alias("__total"))
    cents = lambda c: F.round(c.cast("decimal(18,2)") * 100).cast("decimal(18,0)")
    rows = lines.join(total, F.col(order) == F.col("__order"), "left")
    none = rows.where(F.col("__total").isNull()).withColumn(name, F.lit(0).cast("decimal(18,2)")).select(*lines.columns, name)
    w = Window.partitionBy("__order")
    some = rows.where(F.col("__total").isNotNull()).withColumns({"__cents": F.abs(cents(F.col("__total"))), "__own": F.greatest(F.coalesce(cents(F.col(amount)), F.lit(0)), F.lit(0))})
    some = some.withColumn("__own", F.when(F.max("__own").over(w) > 0, F.col("__own")).otherwise(1).cast("decimal(18,0)"))
    some = some.withColumn("__all", F.sum("__own").over(w).cast("decimal(18,0)"))
    share = "cast(__cents * __own as decimal(38,0))"
    some = some.withColumns({"__part": F.expr(f"{share} div __all"), "__left": F.expr(f"{share} % __all")})
    spare = F.col("__cents") - F.sum("__part").over(w)
    first = F.row_number().over(w.orderBy(F.desc("__left"), *sort)) <= spare
    part = (F.col("__part") + F.when(first, 1).otherwise(0)) * F.when(F.col("__total") < 0, -1).otherwise(1)
    some = some.withColumn(name, (part.cast("decimal(18,0)") / 100).cast("decimal(18,2)"))
    return some.select(*lines.columns, name).unionByName(none)


def gross_margin(lines: DataFrame, products: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """AGG-15: Σ(line - allocated discount - qty × cost) ÷ Σ(line - allocated discount).

    ``lines``: order_id, product_id, quantity, line_amount, allocated_discount.
    ``products``: product_id, cost.
    """
    j = lines.join(products.select("product_id", "cost"), "product_id", "left")
    rev = F.col("line_amount") - F.coalesce(F.col("allocated_discount"), F.lit(0))
    cogs = F.col("quantity") * F.coalesce(F.col("cost"), F.lit(0))
    return j.groupBy(*by).agg(F.sum(rev).alias("net_line_revenue"), F.sum(cogs).alias("cogs")).withColumn(
        "gross_margin",
        F.try_divide((F.col("net_line_revenue") - F.col("cogs")).cast("double"), F.col("net_line_revenue").cast("double")),
    )


def kpi_rollup(events: DataFrame, dims: Sequence[str]) -> DataFrame:
    """AGG-17: daily KPIs with subtotals per dimension prefix (ROLLUP) and
    ``grouping_id`` telling which levels are subtotals."""
    is_order = _t(ORDER)
    return events.rollup(*dims).agg(
        F.grouping_id().alias("grouping_level"),
        F.sum(F.when(is_order, F.col("gross_amount"))).alias("gmv"),
        F.count_distinct(F.when(is_order, F.col("order_id"))).alias("orders"),
        F.sum(F.when(is_order, F.col("discount_amount"))).alias("discount"),
    )


def first_purchase_flags(
    orders: DataFrame, *, customer: str = "customer_id", ts: str = "event_ts", order: str = "order_id"
) -> DataFrame:
    """WIN-05: ``is_first_purchase`` recomputed per customer (earliest by
    time, then order id). The first order per customer is a combinable
    ``min(struct)`` aggregation joined back, not a window over the customer."""
    first = orders.groupBy(customer).agg(F.min(F.struct(ts, order)).alias("__first"))
    # an order without a customer is nobody's first
    return orders.join(first, customer, "left").withColumn(
        "is_first_purchase", F.coalesce(F.col(order) == F.col("__first").getField(order), F.lit(False))
    ).drop("__first")


def line_positions(
    lines: DataFrame, *, order: str = "order_id", sort: Sequence[str] = ("line_number",), bucket_width: int = 1024
) -> DataFrame:
    """WIN-06: ``order_item_index`` (1-based, by ``sort``) and
    ``order_item_count`` per order.

    Two-phase, so a huge order is not sorted in one task: rows are ranked
    within (order, bucket of the first sort column / ``bucket_width``), and
    the row counts of the order's earlier buckets (one summary row per
    bucket) are added. The count per order is a combinable aggregation.
    """
    first = F.col(sort[0])
    b = lines.withColumn("__b", F.floor(first / F.lit(bucket_width)))
    per_bucket = b.groupBy(order, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    wb = Window.partitionBy(order).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        F.col(order).alias("__o"), F.col("__b").alias("__cb"), F.coalesce(F.sum("__cnt").over(wb), F.lit(0)).alias("__before"),
    )
    totals = per_bucket.groupBy(F.col(order).alias("__t")).agg(F.sum("__cnt").alias("order_item_count"))
    w = Window.partitionBy(order, "__b").orderBy(*sort)
    # NULL orders and NULL sort values are a group and a bucket like any other
    out = b.join(carried, F.col(order).eqNullSafe(F.col("__o")) & F.col("__b").eqNullSafe(F.col("__cb")))
    out = out.join(totals, F.col(order).eqNullSafe(F.col("__t")))
    return out.withColumn("order_item_index", (F.col("__before") + F.row_number().over(w)).cast("int")).select(
        *lines.columns, "order_item_index", "order_item_count"
    )
