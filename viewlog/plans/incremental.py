"""Incremental silver: fold only new bronze rows into small state tables.

The original rebuilds silver from all of bronze on every run, so each daily
run costs the whole history. The silver snapshot only needs, per contract,
additive totals over its files plus the set of its devices, so two state
tables carry everything forward:

* ``<silver>_files``: one row per (Contract, source_file) with the partial
  category sums and row count of that file, and ``_folded`` = how many lines
  of that file have been folded (the same value on every row of the file).
  Partitioned by ``source_file``; a fold rewrites only the partitions of the
  files that received rows, by dynamic overwrite, so sums and watermark of a
  file change in one commit.
* ``<silver>_devices``: distinct (Contract, Mac) pairs. New pairs are added
  by an anti-join, so adding the same rows twice changes nothing.

A fold adds the devices first, then rewrites the file partitions: a failure
between the two leaves the watermark behind and the rerun re-folds the same
rows, which the device anti-join absorbs. Bronze rows are identified by
(source_file, row_index), which both ingest paths assign contiguously from 0.

The snapshot is then the same window over the file partials as the full
build, plus distinct devices counted from the pair table: the run costs the
new bronze rows plus the state, not the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.silver import ROWS, category_sums, quote_ident
from ..session import scratch_path
from ..sinks import tables

FOLDED = "_folded"


def _new_rows(spark: SparkSession, bronze: DataFrame, files_table: str) -> DataFrame:
    """Bronze rows past each file's watermark (non-NULL contracts only)."""
    b = bronze.filter(F.col(C.CONTRACT).isNotNull())
    if not tables.table_exists(spark, files_table):
        return b
    marks = spark.table(files_table).groupBy(F.col(C.SOURCE_FILE).alias("_sf")).agg(F.max(FOLDED).alias(FOLDED))
    # One row per file: Spark broadcasts it when its measured size allows.
    # Null-safe: rows without a source file have a watermark too.
    return b.join(marks, b[C.SOURCE_FILE].eqNullSafe(marks["_sf"]), "left").filter(
        F.col(C.ROW_INDEX) >= F.coalesce(F.col(FOLDED), F.lit(0))
    ).drop(FOLDED, "_sf")


def fold(spark: SparkSession, bronze: DataFrame, files_table: str, devices_table: str,
         columns: Sequence[str] = C.PIVOT_COLUMNS, location: str | None = None,
         since_day: str | None = None) -> int:
    """Fold new bronze rows into the state tables; returns the rows folded.

    ``since_day`` (optional) restricts the bronze scan to ingest partitions
    from that day on, for callers whose run dates only move forward; without
    it the whole bronze is scanned (six columns) but only new rows are
    aggregated.
    """
    if since_day is not None:
        bronze = bronze.filter(F.col(C.EXEC_DATE) >= F.lit(since_day))
    new = _new_rows(spark, bronze, files_table).select(
        C.CONTRACT, C.MAC, C.DURATION, C.APP, C.SOURCE_FILE, C.ROW_INDEX
    )
    # Stage the new rows once in shared storage; every later step reads this.
    path = scratch_path(spark, "silver-fold")
    new.write.parquet(path)
    stage = spark.read.parquet(path)
    counts = stage.groupBy(C.SOURCE_FILE).agg(
        (F.max(C.ROW_INDEX) + 1).alias(FOLDED), F.count(F.lit(1)).alias("_n")
    ).collect()  # one row per file that received rows
    if not counts:
        tables.delete_path(spark, path)
        return 0

    # 1. devices: idempotent (anti-join on the pair)
    pairs = stage.filter(F.col(C.MAC).isNotNull()).select(C.CONTRACT, C.MAC).distinct()
    if tables.table_exists(spark, devices_table):
        pairs = pairs.join(spark.table(devices_table), [C.CONTRACT, C.MAC], "left_anti")
    tables.append(spark, devices_table, pairs, [], f"{location}_devices" if location else None)

    # 2. file partials + watermark: one partition rewrite per touched file
    per_file_new = stage.groupBy(C.CONTRACT, C.SOURCE_FILE).agg(
        *category_sums(C.DURATION, columns, fill=False), F.count(F.lit(1)).alias(ROWS)
    )
    merged = per_file_new
    if tables.table_exists(spark, files_table):
        touched = [r[C.SOURCE_FILE] for r in counts]
        named = [t for t in touched if t is not None]
        cond = F.col(C.SOURCE_FILE).isin(named) if named else F.lit(False)
        if None in touched:
            cond = cond | F.col(C.SOURCE_FILE).isNull()
        old = spark.table(files_table).filter(cond).drop(FOLDED)
        merged = old.unionByName(per_file_new).groupBy(C.CONTRACT, C.SOURCE_FILE).agg(
            *[F.expr(f"sum({quote_ident(c)})").alias(c) for c in (*columns, ROWS)]
        )
    marks = spark.createDataFrame([(r[C.SOURCE_FILE], r[FOLDED]) for r in counts], f"_sf string, {FOLDED} bigint")
    merged = merged.join(marks, merged[C.SOURCE_FILE].eqNullSafe(marks["_sf"])).select(
        C.CONTRACT, *columns, ROWS, FOLDED, C.SOURCE_FILE
    )
    tables.overwrite_partitions(spark, files_table, merged, [C.SOURCE_FILE],
                                f"{location}_files" if location else None)
    tables.delete_path(spark, path)  # folded and committed: drop the staged rows
    return sum(r["_n"] for r in counts)


def snapshot(spark: SparkSession, files_table: str, devices_table: str, run_day: str,
             columns: Sequence[str] = C.PIVOT_COLUMNS) -> DataFrame:
    """Silver rows for ``run_day`` from the state (same rows as
    ``operators.silver.silver_summary(bronze, run_day=run_day)``)."""
    files = spark.table(files_table)
    w = f"OVER (PARTITION BY {quote_ident(C.CONTRACT)})"
    totals = [F.expr(f"coalesce(sum({quote_ident(c)}) {w}, CAST(0 AS BIGINT))").alias(c) for c in columns]
    out = files.select(C.CONTRACT, *totals, F.expr(f"sum({quote_ident(ROWS)}) {w}").alias(C.TOTAL_DEVICES), C.SOURCE_FILE)
    devices = spark.table(devices_table).groupBy(C.CONTRACT).agg(F.count(F.lit(1)).alias(C.DISTINCT_DEVICES))
    out = out.join(devices, C.CONTRACT, "left").withColumn(
        C.DISTINCT_DEVICES, F.coalesce(F.col(C.DISTINCT_DEVICES), F.lit(0).cast("bigint"))
    )
    return out.select(C.CONTRACT, *columns, C.TOTAL_DEVICES, C.DISTINCT_DEVICES, C.SOURCE_FILE,
                      F.lit(run_day).alias(C.EXEC_DAY))


def active_fold(spark: SparkSession, active_table: str, snapshot_df: DataFrame, run_day: str,
                location: str | None = None) -> DataFrame:
    """Distinct snapshot days per contract, carried forward day by day.

    ``active_table`` holds, per day partition, (Contract, active_days) for
    every contract seen up to that day. The run for ``run_day`` reads the
    latest earlier partition and the contracts of today's snapshot, writes
    partition ``run_day`` (a rerun of the day rewrites it), and returns
    (Contract, active_days, Active) for today's contracts. Equal to counting
    distinct days over all snapshots when days are processed in order.
    """
    from ..functions.features import active_segment

    today = snapshot_df.select(C.CONTRACT).distinct().withColumn("_seen", F.lit(1))
    prev_day = None
    if tables.table_exists(spark, active_table):
        prev_day = (
            spark.table(active_table).filter(F.col(C.EXEC_DAY) < F.lit(run_day)).agg(F.max(C.EXEC_DAY)).first()[0]
        )
    if prev_day is not None:
        prev = spark.table(active_table).filter(F.col(C.EXEC_DAY) == F.lit(prev_day)).select(
            C.CONTRACT, C.ACTIVE_DAYS
        )
        cur = prev.join(today, C.CONTRACT, "full_outer")
    else:
        cur = today.withColumn(C.ACTIVE_DAYS, F.lit(0).cast("bigint"))
    cur = cur.select(
        C.CONTRACT,
        (F.coalesce(F.col(C.ACTIVE_DAYS), F.lit(0)) + F.coalesce(F.col("_seen"), F.lit(0))).cast("bigint")
        .alias(C.ACTIVE_DAYS),
        F.lit(run_day).alias(C.EXEC_DAY),
    )
    tables.overwrite_partitions(spark, active_table, cur, [C.EXEC_DAY], location)
    written = spark.table(active_table).filter(F.col(C.EXEC_DAY) == F.lit(run_day))
    return written.join(today.select(C.CONTRACT), C.CONTRACT, "left_semi").select(
        C.CONTRACT, C.ACTIVE_DAYS, active_segment(C.ACTIVE_DAYS).alias(C.ACTIVE)
    )
