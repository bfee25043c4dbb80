import pandas as pd
import pytest
from pyspark.sql import functions as F

from earshot.operators import (
    Window,
    in_window,
    keep_complete,
    parse_and_window,
    pick_date_column,
    rename_dots,
    window_report,
)
from earshot.operators.filters import FIRST_VALUE, detect_layout, parse_moment

WIDE = Window("1900-01-01", "2100-01-01")


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, d string").coalesce(1)


def kept(df):
    return [r["i"] for r in df.orderBy("i").collect()]


def test_window_ends_at_midnight(spark):
    df = texts(spark, ["2025-12-31 00:00:00", "2025-12-31 10:00:00", "2022-01-01 00:00:00", "2021-12-31 23:59:59"])
    assert kept(parse_and_window(df, "d", Window())) == [0, 2]


def test_first_value_decides_the_layout(spark):
    values = [None, "2024-01-05", "2024-01-06 10:00", "bad", "01/07/2024", "2024-1-8"]
    df = texts(spark, values)
    assert detect_layout(df, "d")[0] == "yyyy-M-d"
    assert kept(parse_and_window(df, "d", WIDE, FIRST_VALUE)) == [1, 5]
    assert kept(parse_and_window(df, "d", WIDE)) == [1, 2, 4, 5]
    assert pd.to_datetime(pd.Series(values), errors="coerce").notna().tolist() == [
        False, True, False, False, False, True,
    ]


def test_given_layouts_are_tried_in_order(spark):
    df = texts(spark, ["2024-01-05", "2024-01-06 10:00", "bad"])
    assert kept(parse_and_window(df, "d", WIDE, ["yyyy-M-d", "yyyy-M-d H:mm"])) == [0, 1]


def test_plain_date_layout_refuses_other_texts(spark):
    df = texts(spark, ["2024-01-05", "2024-01-06 10:00", "bad", "01/07/2024"])
    got = [r[0] for r in df.orderBy("i").select(parse_moment(F.col("d"), ["yyyy-MM-dd"]).isNotNull()).collect()]
    assert got == [True, False, False, False]


def test_window_is_at_the_offset_of_the_text(spark):
    # midnight of the first day at -07:00 is 07:00 UTC
    df = texts(spark, ["2022-01-01T00:00:00-07:00", "2021-12-31T23:59:59-07:00"])
    assert kept(parse_and_window(df, "d", Window(), FIRST_VALUE)) == [0]
    got = parse_and_window(df, "d", Window())
    assert kept(got) == [0]
    mixed = texts(spark, ["2021-12-31T23:30:00+00:00", "2022-01-01T00:30:00+05:30", "2021-12-31T23:30:00-07:00"])
    assert kept(parse_and_window(mixed, "d", Window())) == [1]
    assert got.select(F.date_format("d", "HH:mm")).first()[0] == "07:00"


def test_no_dates_at_all(spark):
    df = texts(spark, [None, None])
    assert parse_and_window(df, "d", WIDE).count() == 0


def test_pick_date_column():
    assert pick_date_column(["created_at", "date", "x"]) == "date"
    assert pick_date_column(["x"]) is None


def test_rename_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`show.name` int, plain int")
    assert rename_dots(df).columns == ["show_name", "plain"]


def test_window_report(spark):
    df = spark.createDataFrame(
        [("2025-12-31 00:00:00",), ("2025-12-31 10:00:00",), (None,)], "t string"
    ).select(F.col("t").cast("timestamp").alias("t"))
    assert tuple(window_report(df, "t", Window()).first()) == (3, 2, 1, 1)


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id as a", "cast(id as timestamp) as t").write.parquet(path)
    df = in_window(F.col("t"), Window())
    plan = keep_complete(spark.read.parquet(path), "a").filter(df)._jdf.queryExecution().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "IsNotNull(a)" in pushed
    assert "GreaterThanOrEqual(t" in pushed and "LessThanOrEqual(t" in pushed


@pytest.mark.parametrize("text", ["2024-01-05 10:00:00.5", "2024-01-05T10:00:00Z", "2024/1/5", "13/01/2024"])
def test_layouts_known(spark, text):
    assert detect_layout(texts(spark, [text]), "d")[0] is not None
