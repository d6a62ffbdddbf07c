"""Whole-new-file ingestion as a Structured Streaming query (section 2.11).

A file stream over the raw log directory, run with ``availableNow``: every
file not yet recorded in the checkpoint is processed once, in bounded
micro-batches, and the query stops; a rerun with the same checkpoint adds
nothing. This is an extra path beside the row-offset ingest: it counts files,
not lines.

The per-contract usage pivot is a stateful streaming aggregate (conditional
sums; ``pivot`` and exact distinct counts are refused on streams) in update
mode. ``foreachBatch`` writes each batch's updated contracts under its own
batch directory with overwrite, so a replayed batch replaces itself; the
current table is the latest row per contract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.categories import is_category
from ..session import scratch_path

BATCH = "_batch"


def record_schema(payload: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("_id", T.LongType()),
            T.StructField("_index", T.StringType()),
            T.StructField("_source", payload),
        ]
    )


def read_log_stream(spark: SparkSession, root: str, schema: T.StructType, files_per_batch: int = 8) -> DataFrame:
    """Streaming DataFrame over ``root/source_file=<name>/*.json``; the
    partition directory becomes the ``source_file`` column."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("mode", "PERMISSIVE")
        .json(root)
    )


def usage_state(stream: DataFrame, columns: Sequence[str] = C.PIVOT_COLUMNS) -> DataFrame:
    """Running per-contract category sums (stateful aggregate)."""
    rows = stream.select(F.col("_source.*"))
    return rows.groupBy(C.CONTRACT).agg(
        *[F.sum(F.when(is_category(c), F.col(C.DURATION))).alias(c) for c in columns]
    )


def run_available_now(agg: DataFrame, out_path: str, checkpoint: str) -> None:
    """Process everything available, then stop."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/{BATCH}={batch_id}")

    q = (
        agg.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def current_usage(spark: SparkSession, out_path: str, columns: Sequence[str] = C.PIVOT_COLUMNS) -> DataFrame:
    """Latest emitted row per contract, gaps as 0 (same result as
    ``operators.silver.usage_pivot`` over all files)."""
    hist = spark.read.parquet(out_path)
    last = hist.groupBy(C.CONTRACT).agg(F.max_by(F.struct(*columns), F.col(BATCH)).alias("_v"))
    return last.select(
        C.CONTRACT, *[F.coalesce(F.col(f"_v.{c}"), F.lit(0).cast("bigint")).alias(c) for c in columns]
    )


def stream_usage_pivot(spark: SparkSession, sf_dir: str, files_per_batch: int = 8,
                       log_root: str | None = None) -> DataFrame:
    """The events log as per-day JSON files (written here unless
    ``log_root`` already holds it), streamed availableNow."""
    from ..sources.events_adapter import read_events, source_records, write_source_log

    events = read_events(spark, sf_dir)
    root = log_root
    if root is None:
        root = scratch_path(spark, "stream-log")
        write_source_log(events, root, per_file=True)
    payload = source_records(events).schema["_source"].dataType
    agg = usage_state(read_log_stream(spark, root, record_schema(payload), files_per_batch))
    out = scratch_path(spark, "stream-out")
    run_available_now(agg, out, scratch_path(spark, "stream-ckpt"))
    return current_usage(spark, out)
