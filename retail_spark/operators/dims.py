"""Conformed dimensions (DIM-01..07, FLT-13).

Derived attributes are deterministic functions of the id (FN-19
``stable_number``), computed with built-in expressions on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_spark.functions.columns import stable_number

# Country -> (city, state) lookup, acquisition channels in
# order, birth-year base/span, opt-out modulus and the product cost ratio.
COUNTRY_LOCATIONS = {
    "US": ("Austin", "Texas"),
    "MX": ("Monterrey", "Nuevo Leon"),
    "AR": ("Cordoba", "Cordoba"),
    "CL": ("Santiago", "Santiago Metropolitan"),
    "BR": ("Campinas", "Sao Paulo"),
}
ACQUISITION_CHANNELS = ("paid_search", "paid_social", "email", "organic", "direct", "affiliate")
BIRTH_YEAR_BASE = 1965
BIRTH_YEAR_SPAN = 35
OPT_OUT_MODULUS = 5
COST_RATIO = 0.58


def _lookup(mapping: dict[str, str]):
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def dim_customers(customers: DataFrame) -> DataFrame:
    """DIM-01: customer_id, names, email, signup_ts, birth_year, city, state,
    country, acquisition_channel, customer_segment_seed, is_marketing_opt_in."""
    n = stable_number(F.col("customer_id").cast("string"))
    country = F.coalesce(F.col("country"), F.lit("US"))
    city = F.coalesce(F.element_at(_lookup({k: v[0] for k, v in COUNTRY_LOCATIONS.items()}), country), F.lit("Unknown"))
    state = F.coalesce(F.element_at(_lookup({k: v[1] for k, v in COUNTRY_LOCATIONS.items()}), country), F.lit("Unknown"))
    channels = F.array(*[F.lit(c) for c in ACQUISITION_CHANNELS])
    return customers.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.coalesce(F.col("first_name"), F.lit("")).alias("first_name"),
        F.coalesce(F.col("last_name"), F.lit("")).alias("last_name"),
        F.coalesce(F.col("email"), F.lit("")).alias("email"),
        F.coalesce(F.col("created_at").cast("string"), F.lit("")).alias("signup_ts"),
        (F.lit(BIRTH_YEAR_BASE) + F.pmod(n, F.lit(BIRTH_YEAR_SPAN))).cast("int").alias("birth_year"),
        city.alias("city"),
        state.alias("state"),
        F.coalesce(F.col("country"), F.lit("")).alias("country"),
        F.element_at(channels, (F.pmod(n, F.lit(len(ACQUISITION_CHANNELS))) + 1).cast("int")).alias("acquisition_channel"),
        F.coalesce(F.col("segment"), F.lit("active")).alias("customer_segment_seed"),
        (F.pmod(n, F.lit(OPT_OUT_MODULUS)) != 0).alias("is_marketing_opt_in"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    """DIM-02: category id 'CAT-' + first 3 letters upper-cased, price and
    cost rounded to cents (decimal, so halves round away from zero)."""
    price = F.coalesce(F.col("price").cast("double"), F.lit(0.0))
    category = F.coalesce(F.col("category"), F.lit("unknown"))
    return products.select(
        F.col("product_id").cast("string").alias("product_id"),
        F.coalesce(F.col("sku"), F.lit("")).alias("sku"),
        F.coalesce(F.col("name"), F.lit("")).alias("product_name"),
        F.coalesce(F.col("brand"), F.lit("")).alias("brand"),
        F.concat(F.lit("CAT-"), F.upper(F.substring(category, 1, 3))).alias("category_id"),
        category.alias("category_name"),
        F.round(price.cast("decimal(18,4)"), 2).cast("decimal(18,2)").alias("unit_price"),
        F.round((price * F.lit(COST_RATIO)).cast("decimal(18,4)"), 2).cast("decimal(18,2)").alias("cost"),
        F.coalesce(F.col("active"), F.lit(False)).alias("is_active"),
        F.coalesce(F.col("created_at").cast("string"), F.lit("")).alias("created_ts"),
    )


def active_products(products: DataFrame, column: str = "is_active") -> DataFrame:
    """FLT-13."""
    return products.where(F.col(column))


def silver_customers(customers: DataFrame) -> DataFrame:
    """DIM-06: observed Silver shape - typed created_at."""
    return customers.withColumn("created_at", F.try_to_timestamp(F.col("created_at").cast("string")))


def silver_products(products: DataFrame) -> DataFrame:
    """DIM-06: observed Silver shape - created_at timestamp, price double, active boolean."""
    return products.withColumns(
        {
            "created_at": F.try_to_timestamp(F.col("created_at").cast("string")),
            "price": F.col("price").try_cast("double"),
            "active": F.col("active").try_cast("boolean"),
        }
    )


def campaign_by_channel(campaigns: DataFrame) -> DataFrame:
    """DIM-07: one campaign per channel - the last by campaign id wins."""
    return campaigns.groupBy("channel").agg(F.max_by("campaign_id", "campaign_id").alias("campaign_id"))
