import json

import pytest
from pyspark.sql import functions as F

from eventide.functions.conversions import convert_column


def run(spark, raw, conv):
    df = spark.createDataFrame([(raw,)], "p string").select(F.parse_json("p").alias("v"))
    r = convert_column(df, "v", conv).select(F.to_json("converted").alias("o"), F.col("convert_error").alias("e")).first()
    return (json.loads(r["o"]) if r["o"] is not None else None), r["e"]


@pytest.mark.parametrize("raw,conv,expected", [
    ('"123"', "TO_INTEGER", 123),
    ('"49.99"', "TO_DOUBLE", 49.99),
    ('"9999999999"', "TO_LONG", 9999999999),
    ('"true"', "TO_BOOLEAN", True),
    ("42", "TO_STRING", "42"),
    ("49.99", "TO_INTEGER", 49),
    ('"hello"', "TO_UPPER", "HELLO"),
    ('"HELLO"', "TO_LOWER", "hello"),
    ('"secret123"', "MASK", "s*******3"),
    ('"ab"', "MASK", "**"),
    ('{"a":1}', "NONE", {"a": 1}),
    ('" 42 "', "TO_INTEGER", 42),
    ('"yes"', "TO_BOOLEAN", False),
    ('" TRUE "', "TO_BOOLEAN", True),
    ("1", "TO_BOOLEAN", False),
    ('{"a":1}', "TO_STRING", ""),
    ('{"a":1}', "MASK", "**"),
    ("-7.9", "TO_INTEGER", -7),
    ("1e300", "TO_INTEGER", 2147483647),
    ("-1e300", "TO_LONG", -9223372036854775808),
    ("4294967297", "TO_INTEGER", 1),
    ("2147483648", "TO_INTEGER", -2147483648),
    ('"2024-01-01T10:00:00+02:00"', "TO_TIMESTAMP", "2024-01-01T10:00:00+02:00"),
    ('"1e3"', "TO_DOUBLE", 1000.0),
    ('"5d"', "TO_DOUBLE", 5.0),
    ("true", "TO_UPPER", "TRUE"),
])
def test_conversion(spark, raw, conv, expected):
    out, err = run(spark, raw, conv)
    assert err is None
    assert out == expected


@pytest.mark.parametrize("raw,conv,message", [
    ('"3.7"', "TO_INTEGER", 'For input string: "3.7"'),
    ('"abc"', "TO_LONG", 'For input string: "abc"'),
    ('"abc"', "TO_DOUBLE", 'For input string: "abc"'),
    ('"  "', "TO_DOUBLE", "empty String"),
    ('{"a":1}', "TO_INTEGER", 'For input string: ""'),
    ("true", "TO_INTEGER", 'For input string: "true"'),
    ('"99999999999"', "TO_INTEGER", 'For input string: "99999999999"'),
])
def test_conversion_errors(spark, raw, conv, message):
    _, err = run(spark, raw, conv)
    assert err == message


def test_timestamp_without_offset_is_now(spark):
    out, err = run(spark, '"2024-01-01T10:00:00"', "TO_TIMESTAMP")
    assert err is None and out != "2024-01-01T10:00:00" and out.endswith("Z")


def test_unknown_conversion(spark):
    with pytest.raises(ValueError):
        convert_column(spark.range(1).select(F.parse_json(F.lit("1")).alias("x")), "x", "TO_FOO")


@pytest.mark.parametrize("raw,conv,expected", [
    ("99999999999999999999999999999999999999", "TO_INTEGER", None),
    ("-99999999999999999999999999999999999999", "TO_LONG", None),
    ("18446744073709551615", "TO_LONG", -1),
    ("9223372036854775808", "TO_LONG", -9223372036854775808),
    ("9223372036854775807", "TO_LONG", 9223372036854775807),
    ("-2147483649", "TO_INTEGER", 2147483647),
    ("9223372036854775807", "TO_DOUBLE", 9223372036854775807.0),
])
def test_number_ends(spark, raw, conv, expected):
    if expected is None:
        half = 2 ** (31 if conv == "TO_INTEGER" else 63)
        expected = (int(raw) + half) % (2 * half) - half
    assert run(spark, raw, conv) == (expected, None)


def test_each_number_is_read_once(spark):
    """a conversion reads a number of each form once, not once for every comparison with it."""
    from eventide.model import m
    from eventide.operators.mapping import compile_mappings
    df = spark.range(1).select(F.parse_json(F.format_string('{"i":%d}', "id")).alias("payload"))
    plan = compile_mappings(df, [m("i", "i", "TO_LONG")])._jdf.queryExecution().optimizedPlan().toString()
    for form in ("DecimalType(38,0)", "DoubleType", "LongType"):
        assert plan.count(f"$, {form}") == 1, form


def test_own_conversion_of_numbers_gets_their_text(spark):
    from eventide.functions import conversions as C
    fn = C.conversion("TO_DOUBLE")
    try:
        C.register_conversion("TO_DOUBLE", lambda x: (f"CAST(concat('<', {x.t}, '>') AS VARIANT)", None))
        assert run(spark, "42", "TO_DOUBLE") == ("<42>", None)
    finally:
        C.register_conversion("TO_DOUBLE", fn, numbers="DOUBLE")


def test_methods_that_the_jvm_does_not_compile_are_not_fused(spark):
    from eventide.session import configure
    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
