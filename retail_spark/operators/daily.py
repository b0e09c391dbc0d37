"""Daily KPI cube (AGG-17): cells by day, kept up to date day by day, with subtotals at any grouping.

A cell (day and dimensions) holds additive measures; distinct customers are
kept beside it as bitmaps, one row for each 32,768 numbers that a cell has, and
bitmaps of cells merge by OR. So a report at any grouping reads the cells only,
never the events, and its distinct counts are exact.

Both tables are partitioned by day. ``refresh`` overwrites the days it is asked
for and no others, days that have lost all their events included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.operators.gold import ORDER

DAY = "event_date"
#: Additive measures of a cell; money as decimals.
MEASURES = ("events", "orders", "returns", "gmv", "discount", "net_sales", "refunds")
REFUNDS = ("order_cancelled", "return_completed")


def _money(when: Column, column: str) -> Column:
    return F.coalesce(F.sum(F.when(when, F.col(column))), F.lit(0)).cast("decimal(28,2)").alias(
        {"gross_amount": "gmv", "discount_amount": "discount", "net_amount": "net_sales", "refund_amount": "refunds"}[column])


def cells(events: DataFrame, dims: Sequence[str]) -> DataFrame:
    """One row per day and ``dims`` with the measures. An order counts on the day it was placed, a refund on its own."""
    placed, refund = F.col("event_type") == ORDER, F.col("event_type").isin(*REFUNDS)
    return events.groupBy(DAY, *dims).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct(F.when(placed, F.col("order_id"))).alias("orders"),
        F.count_if(F.col("event_type") == "return_completed").alias("returns"),
        _money(placed, "gross_amount"), _money(placed, "discount_amount"), _money(placed, "net_amount"), _money(refund, "refund_amount"),
    )


def customer_bitmaps(events: DataFrame, dims: Sequence[str], customer: str) -> DataFrame:
    """(day, dims, bucket, bitmap) of the customers' numbers; NULL customers are none."""
    number = F.col(customer).cast("bigint")
    return (events.where(number.isNotNull()).groupBy(DAY, *dims, F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")))


def _overwrite_days(rows: DataFrame, days: DataFrame, path: str) -> None:
    """Write ``rows`` over the partitions of ``days``. A day without rows gets an empty one, which stands for none."""
    marked = rows.unionByName(days.select(DAY), allowMissingColumns=True)
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def refresh(events: DataFrame, root: str, *, dims: Sequence[str], customer: str = "customer_id", days: DataFrame | None = None) -> None:
    """Recompute the cells of ``days`` (all days of ``events`` if None) from all their events and overwrite those."""
    days = (events if days is None else days).select(DAY).where(F.col(DAY).isNotNull()).distinct()
    events = events.join(days, DAY, "left_semi")
    _overwrite_days(cells(events, dims), days, f"{root}/cells")
    _overwrite_days(customer_bitmaps(events, dims, customer), days, f"{root}/customers")


def report(spark: SparkSession, root: str, *, dims: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Measures and ratios for every grouping of ``sets``; ``grouping_level`` has a bit for each column summed over."""
    every = [DAY, *dims]
    level = F.grouping_id(*every).cast("int").alias("grouping_level")
    # the bucket is in every set, so its bit, the last one, is never set
    level_of_maps = F.shiftright(F.grouping_id(*every, "bucket"), 1).cast("int").alias("grouping_level")
    rows = spark.read.parquet(f"{root}/cells").where(F.col("events").isNotNull())
    sums = rows.groupingSets([list(map(F.col, s)) for s in sets], *every).agg(level, *[F.sum(m).alias(m) for m in MEASURES])
    maps = spark.read.parquet(f"{root}/customers").where(F.col("bitmap").isNotNull())
    merged = maps.groupingSets([[*map(F.col, s), F.col("bucket")] for s in sets], *every, "bucket").agg(level_of_maps, F.bitmap_or_agg("bitmap").alias("bitmap"))
    customers = merged.groupBy(*every, "grouping_level").agg(F.sum(F.bitmap_count("bitmap")).alias("customers"))
    out = sums.alias("m").join(customers.alias("c"), [F.col(f"m.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*every, "grouping_level")], "left")
    out = out.select("m.*", F.coalesce("c.customers", F.lit(0)).alias("customers"))
    return out.withColumns({
        "aov": F.try_divide(F.col("gmv").cast("double"), F.col("orders").cast("double")),
        "net_revenue": F.col("net_sales") - F.col("refunds"),
        "discount_rate": F.try_divide(F.col("discount").cast("double"), F.col("gmv").cast("double")),
    })
