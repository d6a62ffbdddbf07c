from pyspark.sql import functions as F

from viewlog import constants as C
from viewlog.functions import active_segment, category_of, is_category, most_watch, taste


def test_category_of_every_code_null_and_case(spark):
    rows = [(code,) for _, codes in C.CATEGORY_RULES for code in codes] + [(None,), ("vod",), ("OTHER",), ("",)]
    df = spark.createDataFrame(rows, "AppName string").select("AppName", category_of("AppName").alias("t"))
    got = {r.AppName: r.t for r in df.collect()}
    for name, codes in C.CATEGORY_RULES:
        for code in codes:
            assert got[code] == name
    assert got[None] == "Error"
    assert got["vod"] == "Error"
    assert got["OTHER"] == "Error"
    assert got[""] == "Error"


def test_is_category_agrees_with_case(spark):
    rows = [(code,) for _, codes in C.CATEGORY_RULES for code in codes] + [(None,), ("vod",), ("X",)]
    df = spark.createDataFrame(rows, "AppName string")
    cols = [category_of("AppName").alias("t")] + [is_category(c).alias(c) for c in C.PIVOT_COLUMNS]
    for r in df.select(*cols).collect():
        flags = [c for c in C.PIVOT_COLUMNS if r[c]]
        assert flags == [r.t]


def test_most_watch_ties_zero_and_null(spark):
    schema = ", ".join(f"{c} bigint" for c in C.CATEGORIES)
    rows = [
        (0, 100, 100, 0, 0),  # tie: Phim_Truyen before The_Thao
        (0, 0, 0, 0, 0),  # all zero -> first category
        (None, None, None, None, None),  # all NULL -> NULL
        (None, 5, None, 7, None),  # greatest skips NULLs
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(most_watch()).collect()]
    assert got == ["Phim_Truyen", "Giai_Tri", None, "Thieu_Nhi"]
    got = [r[0] for r in df.select(most_watch(zero_is_null=True)).collect()]
    assert got == ["Phim_Truyen", None, None, "Thieu_Nhi"]


def test_taste_order_and_empty(spark):
    schema = ", ".join(f"{c} bigint" for c in C.CATEGORIES)
    rows = [(1, 0, 3, 0, 9), (0, 0, 0, 0, 0), (None, 2, None, None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(taste()).collect()]
    assert got == ["Giai_Tri-The_Thao-Truyen_Hinh", "", "Phim_Truyen"]


def test_active_threshold(spark):
    df = spark.createDataFrame([(4,), (5,), (0,)], "d int")
    assert [r[0] for r in df.select(active_segment(F.col("d"))).collect()] == ["Low", "High", "Low"]
