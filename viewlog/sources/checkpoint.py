"""Offset checkpoint log.

An append-only table of (file_name, last_offset, rows_per_run,
execution_date, updated_at). The current offset of a file is its newest row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..sinks import tables


_EXTRA = ("file_size", "file_mtime", "state", "execution_date", C.BATCH_ID, "next_offset")


def latest_checkpoints(log: DataFrame) -> DataFrame:
    """Newest row per file: by ``updated_at``, ties by the larger offset.

    ``max_by`` over a struct is a partial aggregate, so a file with a very
    long log costs one partial row per map task, not a sort of its history
    (the original's ``ORDER BY updated_at DESC LIMIT 1``).
    """
    extra = [c for c in _EXTRA if c in log.columns]
    win = F.max_by(
        F.struct("last_offset", "rows_per_run", *extra), F.struct("updated_at", "last_offset")
    ).alias("_cp")
    return log.groupBy("file_name").agg(win).select(
        "file_name", *[F.col(f"_cp.{c}").alias(c) for c in ("last_offset", "rows_per_run", *extra)]
    )


def offsets_for(log: DataFrame, files: DataFrame) -> DataFrame:
    """Current offset of every file in ``files(file_name)``; 0 when the file
    has no checkpoint yet (the original's default)."""
    cur = latest_checkpoints(log.join(files, "file_name", "left_semi"))
    extra = [c for c in _EXTRA if c in cur.columns]
    return files.join(cur, "file_name", "left").select(
        "file_name",
        F.coalesce("last_offset", F.lit(0).cast("bigint")).alias("last_offset"),
        F.coalesce("rows_per_run", F.lit(0).cast("bigint")).alias("rows_per_run"),
        *extra,
    )


def ensure_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    if not tables.table_exists(spark, table):
        tables.create_table(spark, table, schemas.CHECKPOINT, (), location)


class ChangedSourceError(RuntimeError):
    """A source file changed under its checkpoint: its offsets are void."""


def changed_files(recorded: dict[str, tuple], current: dict[str, tuple]) -> list[str]:
    """Files whose current (size, mtime) contradict the recorded ones.

    Growth (an appended log) keeps earlier offsets valid; a smaller file, or
    the same size with another modification time, means it was rewritten.
    Files without a recorded size are not judged.
    """
    bad = []
    for name, (size_r, mtime_r) in recorded.items():
        if size_r is None or name not in current:
            continue
        size_c, mtime_c = current[name]
        if size_c < size_r or (size_c == size_r and mtime_r is not None and mtime_c != mtime_r):
            bad.append(name)
    return sorted(bad)


def read_log(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def append(spark: SparkSession, table: str, rows: DataFrame, execution_date: str,
           updated_at: _dt.datetime | None = None, state: str = "done",
           batch_id: str | None = None) -> None:
    """Append checkpoint rows ``(file_name, last_offset, rows_per_run)``.

    ``rows`` is a DataFrame (one row per ingested file), so the new offsets
    never pass through the driver.
    """
    ts = updated_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    cols = {
        "file_name": F.col("file_name"),
        "last_offset": F.col("last_offset").cast("bigint"),
        "rows_per_run": F.col("rows_per_run").cast("bigint"),
        "execution_date": F.lit(execution_date),
        "updated_at": F.lit(ts).cast("timestamp"),
        "file_size": F.col("file_size").cast("bigint") if "file_size" in rows.columns else F.lit(None).cast("bigint"),
        "file_mtime": (F.col("file_mtime") if "file_mtime" in rows.columns else F.lit(None)).cast("bigint"),
        "state": F.lit(state),
        C.BATCH_ID: F.lit(batch_id),
        "next_offset": (F.col("next_offset") if "next_offset" in rows.columns else F.lit(None)).cast("bigint"),
    }
    table_cols = [f.name for f in spark.table(table).schema.fields]
    out = rows.select(*[cols[c].alias(c) for c in table_cols])
    out.coalesce(1).write.insertInto(table)  # one row per file of the batch: one small file
