import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidymart.functions import numeric

TEXTS = [
    "12", " 12 ", "1e3", ".5", "5.", "+5", "-7", "", "abc", "0x10", "1_0", "12d", "12f", "1,000",
    "1e400", "1234567890e1", "12345678901.5e0", "1e300", "0.0001e305", "12\n", "\t12\r\n", "-", "True", "1e", "9223372036854775808", "2015.0", "3.7", "-3.7", "2.02e3", "1e-400", None,
]


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", function(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(out, key=lambda r: r.i)]


def test_numbers_as_the_data_frame_library_reads_them(spark):
    expected = pd.to_numeric(pd.Series(TEXTS, dtype=object), errors="coerce")
    expected = [None if pd.isna(v) or v in (float("inf"), float("-inf")) else v for v in expected]
    out = apply(spark, numeric.to_number, TEXTS)
    for i, (got, want) in enumerate(zip(out, expected)):
        # The library's parser is off by a few last bits for 19 digits.
        assert got == (want if want is None else pytest.approx(want, rel=1e-15)), TEXTS[i]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.from_regex(r"\A\s?[+-]?([0-9]{1,30}(\.[0-9]{0,20})?|\.[0-9]{1,9})([eE][+-]?[0-9]{1,3})?\n?\Z"), max_size=200))
def test_numbers_of_any_length(spark, values):
    def plain(text):
        value = float(text.strip())
        return None if math.isinf(value) else value

    values += ["0" * 400 + "7", "1" * 400, "." + "0" * 400 + "1e401"]
    assert apply(spark, numeric.to_number, values) == [plain(v) for v in values]


def test_not_a_number_words_are_null(spark):
    assert apply(spark, numeric.to_number, ["NaN", "Infinity", "-inf", "nan"]) == [None] * 4


def test_counts_are_cut_and_default_to_zero(spark):
    assert apply(spark, numeric.to_count, ["3.7", "-3.7", "abc", None, "4", "1e400"]) == [3, -3, 0, 0, 4, 0]


def test_a_count_beyond_64_bits_fails(spark):
    assert apply(spark, numeric.to_count, ["9223372036854775807", "1234567890e1"]) == [2**63 - 1, 12345678900]
    for text in ("9" * 29, "1e19", "-1e300"):
        with pytest.raises(Exception, match="a count beyond 64 bits"):
            apply(spark, numeric.to_count, [text])


def test_years_must_be_whole(spark):
    values = ["2015", "2015.0", "2.015e3", "2015.5", "x2015", None, " 2015 "]
    assert apply(spark, numeric.to_year, values) == [2015, 2015, 2015, None, None, None, 2015]


def test_positive_flag(spark):
    assert apply(spark, numeric.positive_flag, ["1", "0", "2", "-1", "x", "", None, "0.01"]) == [1, 0, 1, 0, 0, 0, 0, 1]


def test_ratio_rounds_half_to_even_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 32), (3, 32), (1, 3), (1, 0), (0, 5), (None, 2)], "n int, d int")
    out = [r.r for r in df.select(numeric.safe_ratio(F.col("n"), F.col("d")).alias("r")).collect()]
    assert out == [0.0312, 0.0938, 0.3333, None, 0.0, None]


def test_leading_int(spark):
    values = ["5. secundaria", "12.x", " 7 .", "x. 5", "", None, "+3.", "99999999999999999999."]
    assert apply(spark, numeric.leading_int, values) == [5, 12, 7, None, None, None, 3, None]


def test_range_is_inclusive_and_null_is_outside(spark):
    assert apply(spark, lambda c: numeric.in_range(c, 0, 1), [0.0, 1.0, 1.1, None], "double") == [True, True, False, False]
