"""Distinct devices per contract over a stream (A4, section 2.11), exactly.

Streams refuse distinct counts, so the pairs are the state: ``dropDuplicates``
on (Contract, Mac) lets every pair through once, and each micro-batch's new
pairs are counted per contract and written under its batch id, by overwrite. A
repeated micro-batch writes the same counts again. The current numbers are the
sums over all micro-batches.

State grows with the pairs; use the RocksDB state store on a cluster
(``session.scale_conf`` sets it), or the sketches of ``operators.sketches``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..sinks import tables
from ..sources import json_lines as J
from .offset_stream import read_line_stream

BATCH = "_batch"
COUNTS = f"{C.CONTRACT} string, {C.DISTINCT_DEVICES} bigint, {BATCH} bigint"


def new_pairs(lines: DataFrame) -> DataFrame:
    """(Contract, Mac) pairs not seen before in the stream; malformed lines give none."""
    parsed = J.parse_records(lines.select(F.col("value").cast("string").alias("value")), schemas.SOURCE_FIELDS)
    good = parsed.where(F.col(J.CORRUPT).isNull())
    return good.select(f"_source.{C.CONTRACT}", f"_source.{C.MAC}").dropDuplicates([C.CONTRACT, C.MAC])


def write_counts(batch: DataFrame, batch_id: int, out: str) -> None:
    """Devices that the micro-batch adds, per contract; contracts without one too."""
    counts = batch.groupBy(C.CONTRACT).agg(F.count(C.MAC).alias(C.DISTINCT_DEVICES))
    counts.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")


def count_devices(spark: SparkSession, source_root: str, out: str, checkpoint: str, max_bytes: int | None = None,
                  range_bytes: int | None = None) -> DataFrame:
    """Take what the log holds that ``checkpoint`` has not, then return the current numbers.

    Positions of a restarted stream come from its checkpoint; a trigger's bound
    holds from the first micro-batch of a run on.
    """
    lines = read_line_stream(spark, source_root, max_bytes=max_bytes, range_bytes=range_bytes)
    q = (
        new_pairs(lines).writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: write_counts(batch, batch_id, out))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return current_devices(spark, out)


def current_devices(spark: SparkSession, out: str) -> DataFrame:
    """Contract, DistinctDevices."""
    if not tables.path_exists(spark, out):
        return spark.createDataFrame([], f"{C.CONTRACT} string, {C.DISTINCT_DEVICES} bigint")
    counts = spark.read.schema(COUNTS).parquet(out)
    return counts.groupBy(C.CONTRACT).agg(F.sum(C.DISTINCT_DEVICES).alias(C.DISTINCT_DEVICES))
