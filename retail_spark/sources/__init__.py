from retail_spark.sources.landing import (  # noqa: F401
    evolve_schema,
    load_schema,
    merge_schemas,
    read_landing,
    rescue,
    store_schema,
)
from retail_spark.sources.tables import read_catalog_stream, read_master, read_table, read_table_stream  # noqa: F401
