"""FN-01..21 and PRJ-02 on hand-made edge cases (FIXTURES.md §4)."""

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_spark.functions import as_json_text, cleaned_string, conform, line_amount, money, parse_ts, stable_number, try_int


def test_cleaned_string_edge_cases(spark):
    df = spark.createDataFrame([("  ",), ("",), (None,), (" AbC ",), ("\tx\t",)], "s string")
    out = df.select(
        cleaned_string("s").alias("plain"),
        cleaned_string("s", lower_case=True).alias("lower"),
        cleaned_string("s", upper_case=True).alias("upper"),
    ).collect()
    assert [tuple(r) for r in out] == [
        (None, None, None),
        (None, None, None),
        (None, None, None),
        ("AbC", "abc", "ABC"),
        ("\tx\t", "\tx\t", "\tX\t"),  # trim strips spaces only
    ]


def test_try_casts_and_money(spark):
    df = spark.createDataFrame([("x", "1.005", "x"), ("7", "2", "2026-03-16T16:03:52.421954+00:00")], "q string, a string, ts string")
    out = df.select(try_int("q").alias("q"), money("a").alias("a"), parse_ts("ts").alias("ts")).collect()
    assert out[0].q is None and out[0].a == Decimal("1.01") and out[0].ts is None
    assert out[1].q == 7 and out[1].a == Decimal("2.00") and out[1].ts is not None


def test_stable_number(spark):
    df = spark.createDataFrame([("CUST001",), ("",), (None,), ("a",)], "s string")
    got = [r[0] for r in df.select(stable_number("s")).collect()]
    expected = [sum(ord(c) * (i + 1) for i, c in enumerate("CUST001")), 0, None, 97]
    assert got == expected and got[0] == 1693


def test_line_amount_defaults_to_zero(spark):
    df = spark.createDataFrame([(None, None), (Decimal("2.50"), 3)], "p decimal(18,2), q int")
    got = [r[0] for r in df.select(line_amount("p", "q")).collect()]
    assert got == [Decimal("0.00"), Decimal("7.50")]


def test_as_json_text_any_type(spark):
    s = spark.createDataFrame([('{"a":1}',)], "attributes string")
    st = spark.createDataFrame([((1,),)], "attributes struct<a:int>")
    mp = spark.createDataFrame([({"a": 1},)], "attributes map<string,int>")
    for df in (s, st, mp):
        txt = df.select(as_json_text(df, "attributes").alias("j")).first().j
        assert F is not None and txt.replace(" ", "") == '{"a":1}'


def test_conform_adds_typed_nulls(spark):
    df = spark.createDataFrame([("e1",)], "event_id string")
    schema = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("n", T.IntegerType())])
    out = conform(df, schema)
    assert out.schema["n"].dataType == T.IntegerType()
    assert out.first().n is None
