from datetime import date

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from earshot import functions as fn


def test_ns_to_timestamp_rounds_to_microseconds(column):
    [moment] = column(lambda c: F.date_format(fn.ns_to_timestamp(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                      [1735639200123456789], "bigint")
    assert moment == "2024-12-31 10:00:00.123457"


def test_ns_to_date_before_1970_and_null(column):
    assert column(fn.ns_to_date, [0, -1_000_000_000, None], "bigint") == [
        date(1970, 1, 1), date(1969, 12, 31), None,
    ]


def test_epoch_ns_is_the_inverse(column):
    values = [1735639200123456000, -86400 * 10**9, None]
    assert column(lambda c: fn.epoch_ns(fn.ns_to_timestamp(c)), values, "bigint") == values


def test_round_to_long_halves_away_from_zero(column):
    values = [1.5, 2.5, -1.5, -2.5, 0.49999999999999994, -0.4, 4503599627370497.5, None]
    assert column(fn.round_to_long, values, "double") == [2, 3, -2, -3, 0, 0, 4503599627370498, None]


def test_round_to_long_agrees_with_round(spark):
    frame = spark.range(20001).select(((F.col("id") - 10000) / 8).alias("v"))
    differing = frame.filter(fn.round_to_long(F.col("v")) != F.round("v").cast("long"))
    assert differing.count() == 0


def test_round_to_long_refuses_nan(column):
    with pytest.raises(ArithmeticException):
        column(fn.round_to_long, [float("nan")], "double")


def test_safe_long(column):
    assert column(fn.safe_long, ["12", " 12 ", "12.0", "1e3", "abc", None], "string") == [
        12, 12, None, None, None, None,
    ]


def test_safe_date(column):
    values = ["1998", "1998-05", "1998-05-03", "1998-5-3", "1998-05-03 10:00", None]
    day = date(1998, 5, 3)
    assert column(fn.safe_date, values, "string") == [None, None, day, day, None, None]


def test_month_key_of_date_and_timestamp(column):
    assert column(fn.month_key, [date(2024, 3, 9), None], "date") == ["2024-03", None]
    assert column(lambda c: fn.month_key(c.cast("timestamp")), ["2024-12-31 23:59:59"], "string") == ["2024-12"]


def test_rounded_ratio_is_null_on_zero(spark):
    frame = spark.createDataFrame([(1, 0), (None, 2), (3, 2)], "a int, b int")
    got = [r[0] for r in frame.select(fn.rounded_ratio("a", "b", 4)).collect()]
    assert got == [None, None, 1.5]


def test_scaled_values_are_whole_and_halves_go_away_from_zero(column):
    values = [0.1, 0.0005, -0.0005, 0.00049, 12.0, None, float("nan"), float("inf")]
    assert column(lambda c: fn.scaled_long(c, 3), values, "double") == [100, 1, -1, 0, 12000, None, None, None]
    assert column(lambda c: fn.scaled_long(c, 0), [7, None], "bigint") == [7, None]


def test_quotients_are_rounded_once(spark):
    cases = [(1, 8, 2, 0.13), (-1, 8, 2, -0.13), (5, 2000, 3, 0.003), (2499, 10**6, 3, 0.002), (10**18, 3, 0, 333333333333333333.0)]
    for part, whole, digits, wanted in cases:
        frame = spark.createDataFrame([(part, whole)], "p bigint, w bigint")
        assert frame.select(fn.rounded_quotient(F.col("p"), F.col("w"), digits)).first()[0] == wanted


def test_null_words(column):
    values = ["NA", "None", "null", "", "nan", "#N/A", "Nancy", " NA", "0", None]
    expected = [None, None, None, None, None, None, "Nancy", " NA", "0", None]
    assert column(fn.null_words_to_null, values, "string") == expected


def test_null_words_are_those_pandas_knows(tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("a,b\n" + "".join(f'"{w}",x\n' for w in fn.NULL_WORDS if w))
    assert pd.read_csv(path)["a"].isna().all()


def test_contains_any_is_case_blind_and_keeps_null(column):
    words = ["pop", "rap"]
    assert column(lambda c: fn.contains_any(c, words), ["K-Pop", "trap", "rock", None], "string") == [
        True, True, False, None,
    ]


def test_before_separator(column):
    values = ["US – United States", "NATION_7", None]
    assert column(lambda c: fn.before_separator(c, " – "), values, "string") == ["US", "NATION_7", None]


def test_percent(column):
    assert column(fn.percent, [0.25, None], "double") == [25.0, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=4 * 10**18), min_size=1, max_size=20))
def test_ns_to_timestamp_against_float_rounding(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in frame.select(F.unix_micros(fn.ns_to_timestamp(F.col("v")))).collect()]
    expected = []
    for v in values:
        micros = float(v) / 1000
        whole = int(micros)
        expected.append(whole + (1 if micros - whole >= 0.5 else 0))
    assert got == expected
