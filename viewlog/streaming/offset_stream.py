"""Row-offset bronze ingest as a Structured Streaming query (section 2.11, S6).

The stream's position is the bytes taken of each file, always a line end
(``sources.line_source.LineStream``), so files may grow, a source file may come
in several parts, and a micro-batch is bounded by bytes, not by files. A
micro-batch numbers its lines from where the one before ended, in the order of
(path, byte), and is written as a bronze batch of its own, as the batch path
writes one (``plans.pipeline.write_lines``).

A log holds, per micro-batch and file, the lines before and after it: 'pending'
before the write, 'done' after. Spark repeats a failed micro-batch with the same
id and byte ranges; a done one is skipped, and a pending one is written again
from the recorded line numbers into the same partition, so lines are neither
lost nor doubled. Do not mix it with the batch path on one bronze table: they
keep separate positions.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..plans import pipeline as P
from ..sinks import tables
from ..sources import line_index as LI
from ..sources import line_source as LS
from .bronze_stream import bronze_batch

LOG_SCHEMA = (
    "stream string, batch_id bigint, source_file string, uri string, stop bigint, lines_before bigint, lines bigint, "
    "state string, execution_date string, bronze_batch string"
)


def log_table(layout: P.Layout) -> str:
    return layout.table(layout.bronze + "_offset_log")


def read_line_stream(spark: SparkSession, source_root: str, known: dict[str, int] | None = None,
                     max_bytes: int | None = None, range_bytes: int | None = None) -> DataFrame:
    """Streaming lines of the files under ``source_root``: value (bytes), source_file, uri, start and stop of the
    byte range that holds the line, and its number in the range."""
    LI._registered(spark)
    reader = spark.readStream.format(LS.LogLines.name()).option("path", source_root).option("known", json.dumps(known or {}))
    for name, value in (("max_bytes", max_bytes), ("range_bytes", range_bytes)):
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load()


def _logged(spark: SparkSession, layout: P.Layout, stream: str) -> DataFrame | None:
    name = log_table(layout)
    if not tables.table_exists(spark, name):
        return None
    return spark.table(name).where(F.col("stream") == stream)


def positions(spark: SparkSession, layout: P.Layout, stream: str) -> dict[str, int]:
    """The bytes of each file that micro-batches have taken; one row per file reaches the driver, as in the
    stream's own offsets."""
    log = _logged(spark, layout, stream)
    return {} if log is None else {r[0]: r[1] for r in log.groupBy("uri").agg(F.max("stop")).collect()}


def ranges_of(batch: DataFrame) -> DataFrame:
    """source_file, uri, start, stop, lines of each byte range of a micro-batch, and the lines of the file before it there."""
    found = batch.groupBy(C.SOURCE_FILE, "uri", "start", "stop").agg(F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy(C.SOURCE_FILE).orderBy("uri", "start").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("_before", F.coalesce(F.sum("lines").over(before), F.lit(0)))


def _begin(spark: SparkSession, layout: P.Layout, ranges: DataFrame, stream: str, batch_id: int, run_date: str) -> None:
    """Write the 'pending' rows: a file's lines before the micro-batch are those that earlier ones gave."""
    log = _logged(spark, layout, stream)
    rows = ranges.groupBy(C.SOURCE_FILE, "uri").agg(F.max("stop").alias("stop"), F.sum("lines").alias("lines"))
    if log is None:
        rows = rows.withColumn("lines_before", F.lit(0).cast("bigint"))
    else:
        done = log.where((F.col("state") == "done") & (F.col("batch_id") < batch_id))
        done = done.groupBy(C.SOURCE_FILE).agg(F.sum("lines").alias("lines_before"))
        rows = rows.join(done, C.SOURCE_FILE, "left").withColumn("lines_before", F.coalesce("lines_before", F.lit(0).cast("bigint")))
    _mark(spark, layout, rows, stream, batch_id, run_date, "pending")


def _mark(spark: SparkSession, layout: P.Layout, rows: DataFrame, stream: str, batch_id: int, run_date: str, state: str) -> None:
    values = {"stream": stream, "batch_id": batch_id, "state": state, "execution_date": run_date,
              "bronze_batch": bronze_batch(stream, batch_id)}
    out = rows.withColumns({k: F.lit(v) for k, v in values.items()}).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    tables.append(spark, log_table(layout), out.select(*columns), [], layout.location(log_table(layout).split(".")[-1]))


def write_micro_batch(batch: DataFrame, batch_id: int, layout: P.Layout, stream: str, run_date: str) -> None:
    """Number the lines of a micro-batch and write them as one bronze batch; a replay changes nothing."""
    spark = batch.sparkSession
    log = _logged(spark, layout, stream)
    earlier = [] if log is None else log.where(F.col("batch_id") == batch_id).select("state", "execution_date").distinct().collect()
    if any(r["state"] == "done" for r in earlier):
        return
    held = batch.persist(StorageLevel.DISK_ONLY)
    try:
        ranges = ranges_of(held)
        if ranges.isEmpty():
            return
        if earlier:
            run_date = earlier[0]["execution_date"]  # the partition that the dead attempt wrote into
        else:
            _begin(spark, layout, ranges, stream, batch_id, run_date)
        pending = _logged(spark, layout, stream).where((F.col("batch_id") == batch_id) & (F.col("state") == "pending"))
        base = pending.groupBy(C.SOURCE_FILE).agg(F.max("lines_before").alias("_base"))
        at = ranges.join(base, C.SOURCE_FILE).select("uri", "start", (F.col("_before") + F.col("_base")).alias("_first"))
        # One row per range on the right: Spark broadcasts it when its measured size allows.
        lines = held.join(at, ["uri", "start"]).select(
            F.col("value").cast("string").alias("value"), C.SOURCE_FILE, (F.col("_first") + F.col("line")).alias(C.ROW_INDEX)
        )
        P.write_lines(spark, layout, lines, run_date, bronze_batch(stream, batch_id))
        _mark(spark, layout, pending, stream, batch_id, run_date, "done")
    finally:
        held.unpersist()


def offset_ingest(spark: SparkSession, layout: P.Layout, source_root: str, checkpoint: str, run_date: str | None = None,
                  max_bytes: int | None = None, range_bytes: int | None = None, processing_time: str | None = None):
    """Ingest all lines under ``source_root`` that ``checkpoint`` has not taken, then stop.

    A micro-batch takes at most ``max_bytes``. With ``processing_time`` (e.g.
    ``"1 minute"``) the query keeps running and is returned to the caller.
    Without ``run_date`` each micro-batch bears the day it runs on.
    """
    P.attach(spark, layout)
    tables.create_namespace(spark, layout.database, layout.location("_db"))
    name = layout.bronze + "_offset_log"
    if layout.root:
        tables.register_existing(spark, layout.table(name), layout.location(name))
    stream = checkpoint

    def sink(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch belongs to the stream's own session: write through it.
        write_micro_batch(batch, batch_id, layout, stream, run_date or _dt.date.today().isoformat())

    def started(**trigger):
        lines = read_line_stream(spark, source_root, positions(spark, layout, stream), max_bytes, range_bytes)
        return lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    if processing_time is not None:
        return started(processingTime=processing_time)
    before = None
    # One run takes what a trigger may; runs follow until nothing is left.
    while (now := positions(spark, layout, stream)) != before:
        before = now
        q = started(availableNow=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        for t in (layout.table(layout.bronze), layout.table(layout.rejects), log_table(layout)):
            if tables.table_exists(spark, t):
                spark.catalog.refreshTable(t)
    return None
