"""Declared schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

from . import constants as C

# Payload fields with declared types; extra keys found in the data are added
# by key discovery (see ``sources.json_lines``).
SOURCE_FIELDS = T.StructType(
    [
        T.StructField(C.CONTRACT, T.StringType()),
        T.StructField(C.MAC, T.StringType()),
        T.StructField(C.DURATION, T.LongType()),
        T.StructField(C.APP, T.StringType()),
    ]
)

BRONZE = T.StructType(
    SOURCE_FIELDS.fields
    + [
        T.StructField(C.EXEC_DATE, T.StringType()),
        T.StructField(C.SOURCE_FILE, T.StringType()),
    ]
)

# Bronze as stored by the ingest job: with each line's offset in its source
# file, partitioned by run date and batch, so that a replayed batch replaces its
# own rows and no others (see ``plans.pipeline.ingest_batch``).
BRONZE_TABLE = T.StructType(
    SOURCE_FIELDS.fields
    + [
        T.StructField(C.SOURCE_FILE, T.StringType()),
        T.StructField(C.ROW_INDEX, T.LongType()),
        T.StructField(C.EXEC_DATE, T.StringType()),
        T.StructField(C.BATCH_ID, T.StringType()),
    ]
)

CHECKPOINT = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("rows_per_run", T.LongType()),
        T.StructField(C.EXEC_DATE, T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        # ours: the source file as listed when the offset was taken
        # (bytes, modification time in epoch milliseconds)
        T.StructField("file_size", T.LongType()),
        T.StructField("file_mtime", T.LongType()),
        # ours: 'pending' before a bronze write, 'done' after it
        T.StructField("state", T.StringType()),
        # ours: the batch and the offset it reads up to
        T.StructField(C.BATCH_ID, T.StringType()),
        T.StructField("next_offset", T.LongType()),
    ]
)


def silver_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(C.CONTRACT, T.StringType())]
        + [T.StructField(c, T.LongType()) for c in C.PIVOT_COLUMNS]
        + [
            T.StructField(C.TOTAL_DEVICES, T.LongType()),
            T.StructField(C.DISTINCT_DEVICES, T.LongType()),
            T.StructField(C.SOURCE_FILE, T.StringType()),
            T.StructField(C.EXEC_DAY, T.StringType()),
        ]
    )


def gold_schema() -> T.StructType:
    return T.StructType(
        silver_schema().fields
        + [
            T.StructField(C.MOST_WATCH, T.StringType()),
            T.StructField(C.TASTE, T.StringType()),
            T.StructField(C.ACTIVE, T.StringType()),
        ]
    )


# Serving table layout (ours: the original keeps it in an external database
# whose DDL it does not ship). ``Note`` stands for a column the gold layer does
# not produce, so alignment has something to pad.
SERVING = T.StructType(
    [
        T.StructField(C.CONTRACT, T.StringType()),
        T.StructField(C.EXEC_DAY, T.StringType()),
        T.StructField(C.SOURCE_FILE, T.StringType()),
    ]
    + [T.StructField(c, T.LongType()) for c in C.PIVOT_COLUMNS]
    + [
        T.StructField(C.TOTAL_DEVICES, T.LongType()),
        T.StructField(C.DISTINCT_DEVICES, T.LongType()),
        T.StructField(C.MOST_WATCH, T.StringType()),
        T.StructField(C.TASTE, T.StringType()),
        T.StructField(C.ACTIVE, T.StringType()),
        T.StructField("Note", T.StringType()),
        T.StructField("Score", T.LongType()),
    ]
)
