"""Scalar column helpers (FN-01..21). All are built-in Spark expressions.

They take a column name or a Column and return a Column, so they compose in
one projection and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
PERCENT = "decimal(5,2)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cleaned_string(c: str | Column, *, lower_case: bool = False, upper_case: bool = False) -> Column:
    """FN-01: trim spaces, blank -> NULL, then optionally lower/upper case.

    ``trim`` strips only the space character (tabs and newlines are kept),
    matching SQL ``trim`` semantics.
    """
    value = F.nullif(F.trim(_c(c)), F.lit(""))
    if lower_case:
        value = F.lower(value)
    if upper_case:
        value = F.upper(value)
    return value


def try_int(c: str | Column) -> Column:
    """FN-12: malformed numbers become NULL instead of failing the job (ANSI)."""
    return _c(c).try_cast(T.IntegerType())


def try_bool(c: str | Column) -> Column:
    return _c(c).try_cast(T.BooleanType())


def try_double(c: str | Column) -> Column:
    return _c(c).try_cast(T.DoubleType())


def money(c: str | Column) -> Column:
    """decimal(18,2); strings go through decimal text so '1.005' -> 1.01."""
    return _c(c).try_cast(MONEY)


def percent(c: str | Column) -> Column:
    return _c(c).try_cast(PERCENT)


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def parse_ts(c: str | Column) -> Column:
    """FN-07: ISO-8601 text (with offset) or an already typed timestamp."""
    return F.try_to_timestamp(_c(c).cast("string"))


def as_json_text(df: DataFrame, name: str) -> Column:
    """X5: JSON text of a column whatever its type.

    Schema inference leaves open objects as strings, an explicit schema may
    give struct/map/variant; ``to_json`` refuses plain strings.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.col(name)
    return F.to_json(F.col(name))


def stable_number(c: str | Column) -> Column:
    """FN-19: sum over characters of code point x 1-based position.

    'CUST001' -> 1693. Empty string and NULL give 0 and NULL.
    """
    s = _c(c)
    terms = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
        lambda i: F.ascii(F.substring(s, i, 1)).cast("long") * i,
    )
    total = F.aggregate(terms, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return F.when(s.isNull(), F.lit(None).cast("long")).when(F.length(s) == 0, F.lit(0).cast("long")).otherwise(total)


def coalesce_money(*cols: str | Column) -> Column:
    return F.coalesce(*[_c(c) for c in cols], zero_money())


def line_amount(unit_price: str | Column, quantity: str | Column) -> Column:
    """FN-16: coalesce(price,0) x coalesce(qty,0) back to decimal(18,2)."""
    return (F.coalesce(_c(unit_price), zero_money()) * F.coalesce(_c(quantity), F.lit(0))).cast(MONEY)


def conform(df: DataFrame, schema: T.StructType | Iterable[tuple[str, str]]) -> DataFrame:
    """PRJ-02: add every schema column the input lacks as a typed NULL.

    Columns already present are left untouched; extra input columns pass
    through (they are rescued or reported by the contract check).
    """
    fields = [(f.name, f.dataType) for f in schema.fields] if isinstance(schema, T.StructType) else list(schema)
    present = set(df.columns)
    missing = {name: F.lit(None).cast(dtype) for name, dtype in fields if name not in present}
    return df.withColumns(missing) if missing else df


def json_field(json_text: Column, key: str) -> Column:
    """FN-14: ``$.key`` of a JSON text; nested values come back as JSON text."""
    return F.get_json_object(json_text, f"$.{key}")
