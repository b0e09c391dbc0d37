from retail_spark.functions.columns import (  # noqa: F401
    MONEY,
    PERCENT,
    as_json_text,
    cleaned_string,
    coalesce_money,
    conform,
    json_field,
    line_amount,
    money,
    parse_ts,
    percent,
    stable_number,
    try_bool,
    try_double,
    try_int,
    zero_money,
)
