"""Discount allocation, daily KPI cube, references, cart link and refunds by channel."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from retail_spark.operators import daily as DK
from retail_spark.operators.gold import allocate_discount, first_purchase_flags, sales_kpis
from retail_spark.operators.quality import LIFECYCLE_STAGES, lifecycle_violations, line_amount_checks, reference_report, resolve_orders

from .conftest import SF_SMALL

LINES = "order_id string, line_number int, line_amount decimal(18,2)"


def largest_remainder(cents, weights):
    weights = [max(w or 0, 0) for w in weights]
    if not any(weights):
        weights = [1] * len(weights)
    all_, size = sum(weights), abs(cents)
    parts = [size * w // all_ for w in weights]
    order = sorted(range(len(weights)), key=lambda k: (-(size * weights[k] % all_), k))
    for k in order[: size - sum(parts)]:
        parts[k] += 1
    return [p if cents >= 0 else -p for p in parts]


def test_allocation_by_largest_remainder(spark):
    r = random.Random(2)
    money = lambda c: None if c is None else Decimal(c) / 100
    orders, lines, want = [], [], {}
    for k in range(60):
        weights = [r.choice([0, 1, 333, 333, r.randrange(10 ** 7), None, -50]) for _ in range(r.randrange(1, 9))]
        cents = r.choice([0, 1, 2, -7, r.randrange(10 ** 6), 10 ** 15])
        orders.append((f"o{k}", money(cents)))
        lines += [(f"o{k}", n, money(w)) for n, w in enumerate(weights)]
        want |= {(f"o{k}", n): money(p) for n, p in enumerate(largest_remainder(cents, weights))}
    lines += [(None, 0, Decimal(5)), (None, 1, Decimal(6)), ("none", 0, Decimal(7)), ("empty", 0, Decimal(8))]
    orders += [(None, Decimal(3)), ("empty", None), ("absent", Decimal(9))]
    want |= {(o, n): Decimal(0) for o, n in ((None, 0), (None, 1), ("none", 0), ("empty", 0))}
    out = allocate_discount(spark.createDataFrame(lines, LINES), spark.createDataFrame(orders, "order_id string, discount_amount decimal(18,2)")).collect()
    assert {(x.order_id, x.line_number): x.allocated_discount for x in out} == want and len(out) == len(lines)


def test_allocated_parts_add_up_to_the_order(spark):
    import __spark_entry__ as E
    from retail_spark.plans.adapters import order_lines

    out = E.queries()["discount_allocation"](spark, SF_SMALL).groupBy("order_id").agg(F.round(F.sum("allocated_discount"), 2).alias("a"))
    own = order_lines(spark, SF_SMALL).groupBy(F.col("l_orderkey").alias("order_id")).agg(F.sum("line_discount").cast("double").alias("b"))
    assert out.join(own, "order_id").where("abs(a - b) > 1e-9").count() == 0


FACTS = "event_date date, event_type string, order_id string, customer_id long, channel string, gross_amount decimal(18,2), discount_amount decimal(18,2), net_amount decimal(18,2), refund_amount decimal(18,2)"


def day_facts(spark, rows):
    return spark.createDataFrame([(d, t, o, c, ch, *(None if a is None else Decimal(a) for a in (g, x, n, r))) for d, t, o, c, ch, g, x, n, r in rows],
                                 FACTS.replace("date date", "date string")).withColumn("event_date", F.to_date("event_date"))


def test_cube_is_refreshed_day_by_day(spark, scratch):
    r = random.Random(5)
    rows = []
    for k in range(300):
        day, kind = f"2026-03-{1 + r.randrange(6):02d}", r.choice(["order_placed", "order_cancelled", "return_completed", "page_view"])
        placed = kind == "order_placed"
        rows.append((day, kind, f"o{k}", r.choice([None, 1, 2, 40_000, -5, 2 ** 40]), r.choice(["a", "b", None]), 10 + k if placed else None, k % 3 if placed else None,
                     9 + k if placed else None, None if placed or kind == "page_view" else k))
    sets = (("event_date", "channel"), ("event_date",), ("channel",), ())
    facts, root = day_facts(spark, rows), f"{scratch}/cube"
    DK.refresh(facts.where("event_type <> 'return_completed'"), root, dims=["channel"])
    late = facts.where("event_type = 'return_completed' and event_date < '2026-03-04'")
    done = facts.where("event_type <> 'return_completed' or event_date < '2026-03-04'")
    DK.refresh(done, root, dims=["channel"], days=late)
    gone = done.where("event_date <> '2026-03-05'")  # a day that lost all its events
    DK.refresh(gone, root, dims=["channel"], days=day_facts(spark, rows).where("event_date = '2026-03-05'"))
    got = {(str(x.event_date) if x.event_date else None, x.channel, x.grouping_level): x for x in DK.report(spark, root, dims=["channel"], sets=sets).collect()}
    kept = [x for x in rows if x[0] != "2026-03-05" and (x[1] != "return_completed" or x[0] < "2026-03-04")]
    want = defaultdict(list)
    for x in kept:
        for level, key in ((0, (x[0], x[4])), (1, (x[0], None)), (2, (None, x[4])), (3, (None, None))):
            want[(*key, level)].append(x)
    assert set(got) == set(want)
    for key, xs in want.items():
        g = got[key]
        gmv, net, refunds = (sum((x[i] or 0) for x in xs) for i in (5, 7, 8))
        assert (g.events, g.customers) == (len(xs), len({x[3] for x in xs} - {None}))
        assert (g.orders, g.returns) == (sum(x[1] == "order_placed" for x in xs), sum(x[1] == "return_completed" for x in xs))
        assert (g.gmv, g.net_sales, g.refunds, g.net_revenue) == (gmv, net, refunds, net - refunds)
        assert (g.aov is None) == (g.orders == 0) and (g.orders == 0 or abs(g.aov - gmv / g.orders) < 1e-9)


def test_channels_add_up_to_the_total(spark):
    import __spark_entry__ as E

    rows = E.queries()["net_revenue_by_channel"](spark, SF_SMALL).collect()
    total = next(r for r in rows if r.is_total)
    for m in ("orders", "net_sales", "refunds", "net_revenue"):
        assert abs(sum(r[m] for r in rows if not r.is_total) - total[m]) < 1e-6 * abs(total[m])
    assert all(r.channel is not None for r in rows if not r.is_total) and total.refunds > 0


def test_references_with_nulls_and_repeats(spark):
    fact = spark.createDataFrame([(1, "a"), (1, None), (2, "zz"), (None, "a"), (2, "a")], "x int, y string")
    dims = {"x": ("x", spark.createDataFrame([(1,), (1,), (None,)], "k long"), "k"), "y": ("y", spark.createDataFrame([("a",)], "k string"), "k")}
    got = {r.reference: tuple(r)[1:] for r in reference_report(fact, dims).collect()}
    assert got == {"x": (5, 1, 2, 2, 1), "y": (5, 1, 1, 2, 1)}
    assert reference_report(fact.limit(0), dims).count() == 0
    plan = reference_report(fact, dims)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("x#") and plan.count("Generate explode") == 1


def test_line_amounts(spark):
    rows = [(2, "1.50", "3.00"), (3, "0.33", "1.00"), (3, "0.33", "1.01"), (None, "1.00", "1.00"), (1, "1.00", None)]
    df = spark.createDataFrame(rows, "quantity int, unit_price string, line_amount string").selectExpr("quantity", "cast(unit_price as decimal(18,2)) unit_price", "cast(line_amount as decimal(18,2)) line_amount")
    assert [r.line_ok for r in line_amount_checks(df).collect()] == [True, True, False, None, None]


def test_cart_events_find_their_order(spark):
    rows = [("checkout_started", "2026-03-16 10:00:00", None, "C1"), ("payment_attempted", "2026-03-16 10:01:00", "O1", "C1"), ("payment_succeeded", "2026-03-16 10:02:00", "O1", None),
            ("order_placed", "2026-03-16 09:59:00", "O1", "C1"), ("checkout_started", "2026-03-16 10:00:00", None, "C2"), ("page_view", "2026-03-16 10:00:00", None, None),
            ("checkout_started", "2026-03-16 08:00:00", None, "C3"), ("order_placed", "2026-03-16 08:10:00", "O3", "C3"), ("payment_attempted", "2026-03-16 08:05:00", "O4", "C3")]
    df = spark.createDataFrame(rows, "event_type string, event_ts string, order_id string, cart_id string").withColumn("event_ts", F.to_timestamp("event_ts"))
    got = resolve_orders(df)
    assert got.count() == len(rows) and got.columns == df.columns
    assert got.where("order_id is null").count() == 2  # an abandoned cart and a view without one
    checked = {r.order_id: r for r in lifecycle_violations(got).collect()}
    assert checked["O1"].out_of_order and checked["O1"].checkout_started_ts is not None
    assert not checked["O3"].out_of_order and checked["O3"].checkout_started_ts is not None and checked["O4"].checkout_started_ts is None
    assert all(f"{s}_ts" in checked["O1"].asDict() for s in LIFECYCLE_STAGES)


def test_lifecycle_stages_show_both_outcomes(spark):
    import __spark_entry__ as E

    df = E.queries()["lifecycle_stages"](spark, SF_SMALL)
    assert df.where("checkout_started_ts is null and order_placed_ts is not null").count() == 0
    for flag in ("out_of_order", "shipped_after_cancel"):
        assert {r[0] for r in df.select(flag).distinct().collect()} == {True, False}
    for name in (*LIFECYCLE_STAGES, "order_cancelled"):
        assert df.where(f"{name}_ts is not null").count() > 0


def test_first_purchase_without_a_customer(spark):
    df = spark.createDataFrame([("a", 1, "o1"), ("a", 2, "o2"), (None, 1, "o3")], "customer_id string, event_ts int, order_id string")
    assert {r.order_id: r.is_first_purchase for r in first_purchase_flags(df).collect()} == {"o1": True, "o2": False, "o3": False}


def test_sales_kpis_of_attributed_refunds(spark):
    from retail_spark.operators.gold import attribute_refunds

    rows = [("2026-03-01", "order_placed", "o1", 1, "a", 10, 0, 10, None), ("2026-03-02", "return_completed", "o1", 1, None, None, None, None, 4),
            ("2026-03-02", "order_cancelled", None, 1, None, None, None, None, 1), ("2026-03-02", "order_cancelled", "gone", 1, None, None, None, None, 2)]
    got = {r.channel: r for r in sales_kpis(attribute_refunds(day_facts(spark, rows)), by=["channel"]).collect()}
    assert got["a"].net_revenue == 6 and got[None].refunds == 3
