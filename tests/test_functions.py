"""Text and number rules of the report inputs."""

import math

import pytest
from pyspark.sql import functions as F

from ratelens.functions import (
    bucket_label, first_char, fmt2, jtrim, parse_double, parse_int, split_fields,
)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_trim_removes_control_chars_and_spaces(spark):
    got = one_col(spark, ["\t a b \x01", "  ", "x\n", " y"], jtrim)
    assert got == ["a b", "", "x", " y"]  # U+00A0 is above U+0020: kept


def test_split_drops_trailing_empty_fields_only(spark):
    got = one_col(spark, ["a,b,,", "a, b, ,", ",a", "a"], split_fields)
    assert got == [["a", "b"], ["a", " b", " "], ["", "a"], ["a"]]


def test_parse_int_rules(spark):
    vals = ["5", "+5", "-5", " 7 ", "5.0", "5L", "2147483648", "-2147483648", "", "0x10"]
    assert one_col(spark, vals, parse_int) == [5, 5, -5, 7, None, None, None,
                                               -2147483648, None, None]


def test_parse_double_rules(spark):
    vals = ["4.0", "1e1", "4.0d", "4.0f", ".5", "5.", "0x1p3", "five", "", "1,5"]
    assert one_col(spark, vals, parse_double) == [4.0, 10.0, 4.0, 4.0, 0.5, 5.0, 8.0,
                                                  None, None, None]


def test_parse_double_java_forms(spark):
    vals = ["1e1f", "1.5e-3d", "+.5", "-.5e1", "0x1.8p1d", "1e+2", "0X1P3", "5D",
            ".", "e5", "1e", "0x10", "1__2", "Infinityd", "NaNd", "0x1p", "1 2"]
    got = one_col(spark, vals, parse_double)
    assert got[:8] == [10.0, 0.0015, 0.5, -5.0, 3.0, 100.0, 8.0, 5.0]
    assert got[8:] == [None] * 9
    assert one_col(spark, ["1.0e400", "-1e400"], parse_double) == [math.inf, -math.inf]


def test_parse_double_special_spellings(spark):
    vals = ["NaN", "-NaN", "Infinity", "-Infinity", "+Infinity", "nan", "inf", "INF",
            "infinity", "NAN"]
    got = one_col(spark, vals, parse_double)
    assert math.isnan(got[0]) and math.isnan(got[1])
    assert got[2:5] == [math.inf, -math.inf, math.inf]
    assert got[5:] == [None] * 5


def test_format_half_even_on_exact_value(spark):
    vals = [0.125, 4.125, 1234.5, 2.675, 3.705, 0.0, 11.0 / 3.0, 1e10]
    got = one_col(spark, vals, fmt2, "double")
    assert got == ["0.12", "4.12", "1234.50", "2.67", "3.71", "0.00", "3.67",
                   "10000000000.00"]


def test_first_char(spark):
    assert one_col(spark, [" Male", "f", "  ", ""], first_char) == ["M", "f", None, None]


@pytest.mark.parametrize("age,label", [(-3, "0-18"), (0, "0-18"), (17, "0-18"),
                                       (18, "18-35"), (34, "18-35"), (35, "35-50"),
                                       (49, "35-50"), (50, "50+"), (99, "50+")])
def test_age_buckets(spark, age, label):
    assert one_col(spark, [age], bucket_label, "int") == [label]


def test_bucket_label_custom_bounds(spark):
    got = one_col(spark, [1, 10, 100], lambda c: bucket_label(c, (10, 100), ("a", "b", "c")),
                  "int")
    assert got == ["a", "b", "c"]
    with pytest.raises(ValueError):
        bucket_label(F.col("x"), (1,), ("a",))
