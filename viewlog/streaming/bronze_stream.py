"""Whole-new-file bronze ingest as a Structured Streaming query (section 2.11,
the streaming form of D9).

``readStream.text`` over ``source_root/source_file=<name>/`` with
``availableNow``: each micro-batch holds whole files not seen before (the
stream checkpoint remembers them, so a rerun adds nothing). Inside
``foreachBatch`` every line gets its offset in its file (the same split
summary as the batch path), keys are discovered, records parsed and
flattened, and the batch is appended to bronze. A small log records each
micro-batch id as 'pending' before its write and 'done' after; Spark replays
a failed batch with the same id, so a done batch is skipped and a pending
one skips the files its dead attempt already wrote (looking only into that
run's bronze partition). Normal batches read no bronze. One physical file is one logical source file here; the row-offset
path (``plans.pipeline.ingest_batch``) also handles multi-part files and
partial files. Do not mix both paths on one bronze table.
"""

from __future__ import annotations

import datetime as _dt
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..plans.pipeline import PARTITIONS, Layout
from ..sinks import tables
from ..sources import json_lines as J


# Batch ids restart with a new checkpoint location, so the log is keyed by
# (stream checkpoint, batch id).
LOG_SCHEMA = "stream string, batch_id bigint, source_file string, state string, execution_date string, bronze_batch string"


def bronze_batch(stream: str, batch_id: int | None) -> str:
    """The id of a micro-batch in bronze: one of its own among all streams."""
    return "stream" if batch_id is None else f"stream-{zlib.crc32(stream.encode()):08x}-{batch_id}"


def _log(spark: SparkSession, log_table: str, batch_id: int, stream: str = "") -> dict[str, set[str]]:
    if not tables.table_exists(spark, log_table):
        return {}
    rows = spark.table(log_table).filter(
        (F.col("batch_id") == batch_id) & (F.col("stream") == stream)
    ).select("state", C.SOURCE_FILE).collect()
    out: dict[str, set[str]] = {}
    for r in rows:
        out.setdefault(r["state"], set()).add(r[C.SOURCE_FILE])
    return out


def _mark(spark: SparkSession, log_table: str, batch_id: int, files: list[str], state: str, run_date: str,
          layout: Layout, stream: str = "") -> None:
    df = spark.createDataFrame([(stream, batch_id, f, state, run_date, bronze_batch(stream, batch_id)) for f in files], LOG_SCHEMA)
    tables.append(spark, log_table, df, [], layout.location(log_table.split(".")[-1]))


def _ingest_batch_df(spark: SparkSession, batch: DataFrame, bronze: str, rejects: str, run_date: str,
                     layout: Layout, batch_id: int | None = None, log_table: str | None = None,
                     stream: str = "") -> None:
    # Position ids are assigned on the micro-batch (streams refuse them); the
    # batch reads the same splits for the summary and for the rows.
    lines, files = J.index_lines(spark, batch.withColumn(J.MID, F.monotonically_increasing_id()))
    if not files:
        return
    parts = batch.select(C.SOURCE_FILE, J.PATH).distinct().groupBy(C.SOURCE_FILE).count().collect()
    split = sorted(r[0] for r in parts if r["count"] > 1)
    if split:
        raise ValueError(f"source files in several parts need the offset path (ingest_batch): {split}")
    names = sorted(r[0] for r in parts)
    state = _log(spark, log_table, batch_id, stream) if log_table and batch_id is not None else {}
    if "done" in state:
        return  # a replay of a batch that completed
    if log_table is None or "pending" in state:
        # Unknown history, or this batch died after its intent: files already
        # in bronze (from that run's partition when known) are skipped.
        if tables.table_exists(spark, bronze) and names:
            b = spark.table(bronze).filter(F.col(C.SOURCE_FILE).isin(names))
            if log_table is not None:
                b = b.filter(F.col(C.EXEC_DATE) == F.lit(run_date))
            done = {r[0] for r in b.select(C.SOURCE_FILE).distinct().collect()}
            if done:
                lines = lines.filter(~F.col(C.SOURCE_FILE).isin(sorted(done)))
    if log_table is not None and "pending" not in state:
        _mark(spark, log_table, batch_id, names, "pending", run_date, layout, stream)
    payload = J.discover_source_schema(spark, lines)
    parsed = J.parse_records(lines, payload)
    stamp = [F.lit(run_date).alias(C.EXEC_DATE), F.lit(bronze_batch(stream, batch_id)).alias(C.BATCH_ID)]
    good = J.flatten(parsed.filter(F.col(J.CORRUPT).isNull()).drop(J.CORRUPT)).select("*", *stamp)
    if not tables.table_exists(spark, bronze):
        tables.create_table(spark, bronze, schemas.BRONZE_TABLE, PARTITIONS["bronze"], layout.location(layout.bronze))
    tables.append(spark, bronze, good, PARTITIONS["bronze"])
    bad = parsed.filter(F.col(J.CORRUPT).isNotNull()).select(
        C.SOURCE_FILE, C.ROW_INDEX, F.col(J.CORRUPT).alias("line"), *stamp
    )
    if not bad.isEmpty():
        tables.append(spark, rejects, bad, PARTITIONS["rejects"], layout.location(layout.rejects))
    if log_table is not None:
        _mark(spark, log_table, batch_id, names, "done", run_date, layout, stream)


def stream_ingest(spark: SparkSession, layout: Layout, source_root: str, checkpoint: str, run_date: str | None = None,
                  files_per_batch: int = 8, processing_time: str | None = None):
    """Ingest every file under ``source_root`` not yet recorded in
    ``checkpoint``, then stop (``availableNow``). With ``processing_time``
    (e.g. ``"1 minute"``) the query keeps running, picking up new files on
    that interval, and is returned to the caller (stop it with ``.stop()``).
    Without ``run_date`` each micro-batch bears the day it runs on."""
    tables.create_namespace(spark, layout.database, layout.location("_db"))
    bronze = layout.table(layout.bronze)
    rejects = layout.table(layout.rejects)
    stream = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source_root)
    if C.SOURCE_FILE not in stream.columns:  # flat layout: name from the file
        stream = stream.withColumn(C.SOURCE_FILE, J.name_from_file())
    positioned = J.with_position(stream, with_id=False)

    log_table = layout.table(layout.bronze + "_stream_log")
    if layout.root:
        tables.register_existing(spark, log_table, layout.location(layout.bronze + "_stream_log"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch belongs to the stream's own session: write through it.
        _ingest_batch_df(batch.sparkSession, batch, bronze, rejects,
                         run_date or _dt.date.today().isoformat(), layout, batch_id, log_table, checkpoint)

    w = positioned.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if processing_time is not None:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    # The caller's session may hold a file listing from before the batches.
    for t in (bronze, rejects):
        if tables.table_exists(spark, t):
            spark.catalog.refreshTable(t)
