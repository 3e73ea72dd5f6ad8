"""Truth tables for the coercion and text operators."""

import math

import pytest
from tradelake.operators import clean as C


def _eval(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


INT_CASES = [
    ("12", 12), (" 12 ", 12), ("\t12\n", 12), ("+7", 7), ("-3", -3), ("1e3", 1000),
    ("1.0", 1), ("1.5", None), ("", None), ("abc", None), ("nan", None), ("inf", None),
    ("9007199254740993", 9007199254740993),            # 2^53+1 exact (D3)
    ("9223372036854775808", None), ("12d", None), ("0x1F", None), (None, None),
    ("٣", None),                                   # non-ASCII digit
]


def test_to_int(spark):
    got = _eval(spark, C.to_int, [v for v, _ in INT_CASES])
    assert got == [e for _, e in INT_CASES]


def test_int_reject(spark):
    got = _eval(spark, C.int_reject, ["1.5", "inf", "12", "abc", None, "99999999999999999999"])
    assert got == [True, True, False, False, False, True]


FLOAT_CASES = [
    ("12", 12.0), (" 12.5 ", 12.5), ("1e3", 1000.0), ("-.5", -0.5), ("5.", 5.0),
    ("", None), ("abc", None), ("nan", None), ("NaN", None), ("5d", None), ("5f", None),
    ("0x1p3", None), (None, None), ("1 2", None),
]


def test_to_float(spark):
    got = _eval(spark, C.to_float, [v for v, _ in FLOAT_CASES])
    assert got == [e for _, e in FLOAT_CASES]


def test_to_float_infinity(spark):
    got = _eval(spark, C.to_float, ["inf", "-inf", "Infinity", "-INFINITY"])
    assert [math.copysign(1, g) * math.isinf(g) for g in got] == [1, -1, 1, -1]


def test_to_float_padded_infinity_and_overflow(spark):
    # pandas' to_numeric: an infinity word with padding is NaN, and a finite
    # spelling beyond double range is NaN (tests/test_coercion_property.py)
    assert _eval(spark, C.to_float, [" -INFINITY ", " inf", "1e999", "-1e999"]) == [None] * 4


BOOL_CASES = [
    ("1", True), ("0", False), ("T", True), ("f", False), ("yes", True), ("NO", False),
    (" true ", True), ("False", False), ("Y", None), ("N", None), ("1.0", None),
    (None, None), ("", None), ("None", None),
]


def test_to_bool(spark):
    got = _eval(spark, C.to_bool, [v for v, _ in BOOL_CASES])
    assert got == [e for _, e in BOOL_CASES]


def test_strip_family(spark):
    vals = ["  a b ", "\tx ", "   ", "", None]
    assert _eval(spark, C.strip, vals) == ["a b", "x", "", "", None]
    assert _eval(spark, C.strip_blank_null, vals) == ["a b", "x", None, None, None]
    assert _eval(spark, C.strip_if_truthy, vals) == ["a b", "x", "", None, None]
    assert _eval(spark, C.strip_upper, [" g ", "m\t"]) == ["G", "M"]


def test_filters(spark):
    vals = ["A", "", "P", None, " A"]
    assert _eval(spark, C.is_active, vals) == [True, False, False, False, False]
    assert _eval(spark, C.is_active_or_blank, vals) == [True, True, False, False, False]
    assert _eval(spark, C.is_truthy, vals) == [True, False, True, False, True]


def test_label_and_default(spark):
    assert _eval(spark, C.inventory_kind_label, ["G", "S", "X", None]) == [
        "Goods (tovar)", "Service (xizmat)", None, None]
    assert _eval(spark, C.default_blank, [None, "n"]) == ["", "n"]


@pytest.mark.parametrize("fn", [C.to_int, C.to_float, C.to_bool, C.strip])
def test_no_python_in_plan(spark, fn):
    df = spark.createDataFrame([("1",)], "v string").select(fn("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
