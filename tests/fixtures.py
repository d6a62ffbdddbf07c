"""Edge rows for unit tests (see FIXTURES.md)."""

from pyspark.sql import types as T

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("Contract", T.StringType()),
        T.StructField("Mac", T.StringType()),
        T.StructField("TotalDuration", T.LongType()),
        T.StructField("AppName", T.StringType()),
        T.StructField("execution_date", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)

EDGE_ROWS = [
    ("A", "m1", 100, "VOD", "2024-01-01", "20240101"),
    ("A", "m1", 100, "SPORT", "2024-01-02", "20240102"),
    ("B", "m2", 50, None, "2024-01-01", "20240101"),
    ("C", "m3", 7, "vod", "2024-01-01", "20240101"),
    ("D", "m4", 0, "CHILD", "2024-01-01", "20240101"),
    (None, "m5", 9, "RELAX", "2024-01-01", "20240101"),
    ("0", "m6", 44000000, "KPlus", "2024-01-01", "20240101"),
    ("E", None, None, "DSHD", "2024-01-01", "20240101"),
]


def edge_bronze(spark):
    return spark.createDataFrame(EDGE_ROWS, BRONZE_SCHEMA)
