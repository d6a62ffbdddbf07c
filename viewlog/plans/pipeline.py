"""The stage pipeline: incremental ingest (D9), silver, gold, export, and the
batch runner (D10).

Each stage is a function of (session, layout, arguments) that reads tables,
runs distributed DataFrame work and writes tables; the driver only sequences
stages and handles per-file metadata (offsets, counts), never rows.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import traceback
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import schemas
from ..operators import gold as G
from ..operators import serving as S
from ..operators import silver as SV
from ..session import shared_dir
from ..sinks import tables
from ..sinks.jdbc import JdbcTarget
from ..sinks.versioned import VersionedTable
from ..sources import checkpoint as CP
from ..sources import json_lines as J
from ..sources import line_index as LI
from .ledger import Ledger
from .maintained import MaintainedViews
from .run_ledger import RunLedger, plan_of

RUN_LEDGER = "run_ledger"


@dataclasses.dataclass(frozen=True)
class Layout:
    """Where the layers live. ``root`` is shared storage for table data
    (default: the catalog's warehouse)."""

    database: str = "viewlog"
    root: str | None = None
    bronze: str = "bronze_events"
    rejects: str = "bronze_rejects"
    checkpoint: str = "ingest_checkpoint"
    silver: str = "silver_events"
    gold: str = "gold_app_usage"
    serving: str = "serving_summary"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def location(self, name: str) -> str | None:
        return f"{self.root.rstrip('/')}/{name}" if self.root else None

    def folder(self, spark: SparkSession, name: str) -> str:
        """Where ``name`` lies: under the root, else in the database's folder of the warehouse."""
        if self.root:
            return self.location(name)
        base = spark.catalog.getDatabase(self.database).locationUri
        return f"{base.rstrip('/')}/{name}"


PARTITIONS = {
    "bronze": [C.EXEC_DATE, C.BATCH_ID],
    "rejects": [C.EXEC_DATE, C.BATCH_ID],
    "checkpoint": [],
    "silver": [C.EXEC_DAY],
    "gold": [C.EXEC_DAY],
    "serving": [C.EXEC_DAY],
}


def attach(spark: SparkSession, layout: Layout) -> None:
    """Re-register the layout's tables from shared storage when this
    process's catalog does not know them (each stage may run in its own
    process, and the session catalog lives in memory)."""
    if not layout.root:
        return
    tables.create_namespace(spark, layout.database, layout.location("_db"))
    for attr, parts in PARTITIONS.items():
        name = getattr(layout, attr)
        if attr == "serving":
            VersionedTable(spark, layout.location(name), C.EXEC_DAY).register(layout.table(name))
            continue
        tables.register_existing(spark, layout.table(name), layout.location(name), parts)
    for log in (layout.bronze + "_stream_log", layout.bronze + "_offset_log"):
        tables.register_existing(spark, layout.table(log), layout.location(log))


def committed_batches(spark: SparkSession, layout: Layout) -> DataFrame:
    """batch_id of every bronze batch whose write is known to be complete: the
    'done' rows of the checkpoint log and of the streams' log."""
    logs = [(layout.checkpoint, F.col(C.BATCH_ID)), (layout.bronze + "_stream_log", F.col("bronze_batch")),
            (layout.bronze + "_offset_log", F.col("bronze_batch"))]
    out = spark.createDataFrame([], f"{C.BATCH_ID} string")
    for name, batch in logs:
        if tables.table_exists(spark, layout.table(name)):
            done = spark.table(layout.table(name)).where(F.col("state") == "done")
            out = out.union(done.select(batch.alias(C.BATCH_ID)))
    return out.distinct()


def _today() -> str:
    return _dt.date.today().isoformat()


def _index_path(spark: SparkSession, layout: Layout) -> str:
    """Where line indexes live: next to the tables on shared storage, else
    under the session's shared directory."""
    return layout.location("_line_index") or f"{shared_dir(spark).rstrip('/')}/line-index-{layout.database}"


@dataclasses.dataclass(frozen=True)
class FileRange:
    """Lines ``[start, stop)`` of a source file; ``size`` is the batch size that was asked for (0: to its end)."""

    name: str
    start: int
    stop: int
    size: int = 0


@dataclasses.dataclass(frozen=True)
class BatchPlan:
    """What a batch will read, fixed before it writes anything."""

    batch_id: str
    run_date: str
    ranges: list[FileRange]
    listing: dict[str, LI.SourceFile]
    lines: dict[str, int]  # of each listed file


def _open_layout(spark: SparkSession, layout: Layout) -> None:
    attach(spark, layout)
    tables.create_namespace(spark, layout.database, layout.location("_db"))
    CP.ensure_table(spark, layout.table(layout.checkpoint), layout.location(layout.checkpoint))


def _refuse_changed(recorded: dict[str, tuple], listing: dict[str, LI.SourceFile]) -> None:
    changed = CP.changed_files(recorded, {n: (f.size, f.mtime) for n, f in listing.items()})
    if changed:
        raise CP.ChangedSourceError(f"source files changed since their checkpoint: {changed}")


def plan_batch(spark: SparkSession, layout: Layout, source_root: str, rows: int | None, run_date: str,
               files: Sequence[str] | None = None, batch_id: str | None = None, opened: bool = False) -> BatchPlan:
    """The next ``rows`` lines of every source file, as a batch with an id of its own (or the given one).
    ``opened``: the caller has registered the layout's tables."""
    if not opened:
        _open_layout(spark, layout)
    listing = LI.list_source_files(spark, source_root, files)
    missing = sorted(set(files or []) - set(listing))
    if missing:
        raise FileNotFoundError(f"no source file(s) {missing} under {source_root}")
    ranges, lines = [], {}
    if listing:
        files_df = spark.createDataFrame([(n,) for n in sorted(listing)], "file_name string")
        log = CP.read_log(spark, layout.table(layout.checkpoint))
        cur = {r["file_name"]: r for r in CP.offsets_for(log, files_df).collect()}
        _refuse_changed({n: (r["file_size"], r["file_mtime"]) for n, r in cur.items() if r["last_offset"] > 0}, listing)
        lines = LI.ensure_index(spark, _index_path(spark, layout), listing, {n: r["last_offset"] for n, r in cur.items()})
        for n, r in sorted(cur.items()):
            # Rows asked for, else the file's last batch size; 0 means to its end.
            size, start = int(rows if rows is not None else r["rows_per_run"] or 0), r["last_offset"]
            stop = min(start + size, lines[n]) if size else lines[n]
            if stop > start:
                ranges.append(FileRange(n, start, stop, size))
    return BatchPlan(batch_id or uuid.uuid4().hex[:16], run_date, ranges, listing, lines)


def _mark_batch(spark: SparkSession, layout: Layout, plan: BatchPlan, state: str) -> None:
    """A checkpoint row per file: its offset after the batch if done, else before it."""
    rows = [(r.name, r.stop if state == "done" else r.start, r.stop, r.size, plan.listing[r.name].size, plan.listing[r.name].mtime)
            for r in plan.ranges]
    df = spark.createDataFrame(rows, "file_name string, last_offset bigint, next_offset bigint, rows_per_run bigint, "
                                     "file_size bigint, file_mtime bigint")
    CP.append(spark, layout.table(layout.checkpoint), df, plan.run_date, state=state, batch_id=plan.batch_id)


def begin_batch(spark: SparkSession, layout: Layout, plan: BatchPlan) -> None:
    """Record the batch as 'pending' before it writes anything."""
    _mark_batch(spark, layout, plan, "pending")


def write_batch(spark: SparkSession, layout: Layout, plan: BatchPlan) -> tuple[int, list[str]]:
    """Write the lines of a batch to bronze and rejects (see ``write_lines``)."""
    lines = LI.lines_of(spark, _index_path(spark, layout), [(r.name, r.start, r.stop) for r in plan.ranges])
    return write_lines(spark, layout, lines, plan.run_date, plan.batch_id)


def write_lines(spark: SparkSession, layout: Layout, lines: DataFrame, run_date: str, batch_id: str) -> tuple[int, list[str]]:
    """Parse lines (value, source_file, row_index) and write them as one batch of
    bronze and rejects, replacing whatever an earlier attempt at the batch left.
    Returns the malformed lines and the columns that bronze gained.

    The lines are read once: key discovery, the bronze write and the rejects
    share the executors' cached copy, which is read anew from the source where
    an executor is lost.
    """
    bronze, rejects = layout.table(layout.bronze), layout.table(layout.rejects)
    held = lines.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        payload = J.discover_source_schema(spark, held)
        # The reject count rides on the bronze write (K11): no separate job.
        seen_bad = Observation("rejects")
        parsed = J.parse_records(held, payload).observe(
            seen_bad, F.sum(F.when(F.col(J.CORRUPT).isNotNull(), 1).otherwise(0)).alias("n")
        )
        stamp = [F.lit(run_date).alias(C.EXEC_DATE), F.lit(batch_id).alias(C.BATCH_ID)]
        bad = parsed.filter(F.col(J.CORRUPT).isNotNull()).select(
            C.SOURCE_FILE, C.ROW_INDEX, F.col(J.CORRUPT).alias("line"), *stamp
        )
        known = tables.table_exists(spark, bronze)
        schema = spark.table(bronze).drop(C.EXEC_DATE, C.BATCH_ID).schema if known else None
        good = J.flatten(parsed.filter(F.col(J.CORRUPT).isNull()).drop(J.CORRUPT), table=schema).select("*", *stamp)
        before = set(tables.columns_of(spark, bronze)) if known else set()
        if not known:
            tables.create_table(spark, bronze, schemas.BRONZE_TABLE, PARTITIONS["bronze"],
                                layout.location(layout.bronze))
        tables.overwrite_partitions(spark, bronze, good, PARTITIONS["bronze"])
        n_rejects = int(seen_bad.get["n"] or 0)
        if n_rejects:
            tables.overwrite_partitions(spark, rejects, bad, PARTITIONS["rejects"], layout.location(layout.rejects))
    finally:
        held.unpersist()
    return n_rejects, [c for c in tables.columns_of(spark, bronze) if before and c not in before]


def _finish_pending(spark: SparkSession, layout: Layout, source_root: str) -> None:
    """Repeat batches whose checkpoint rows stayed 'pending': exactly their
    ranges, under their own run date and batch id, over all their files."""
    log = CP.read_log(spark, layout.table(layout.checkpoint))
    open_ = CP.latest_checkpoints(log).filter(F.col("state") == "pending").collect()
    for batch_id in sorted({r[C.BATCH_ID] for r in open_}):
        rows = [r for r in open_ if r[C.BATCH_ID] == batch_id]
        listing = LI.list_source_files(spark, source_root, [r["file_name"] for r in rows])
        gone = sorted({r["file_name"] for r in rows} - set(listing))
        if gone:
            raise FileNotFoundError(f"source file(s) {gone} of the unfinished batch {batch_id} are gone")
        _refuse_changed({r["file_name"]: (r["file_size"], r["file_mtime"]) for r in rows}, listing)
        lines = LI.ensure_index(spark, _index_path(spark, layout), listing, {r["file_name"]: r["last_offset"] for r in rows})
        ranges = [FileRange(r["file_name"], r["last_offset"], r["next_offset"], r["rows_per_run"]) for r in rows]
        plan = BatchPlan(batch_id, rows[0]["execution_date"], ranges, listing, lines)
        write_batch(spark, layout, plan)
        _mark_batch(spark, layout, plan, "done")


def _complete(spark: SparkSession, layout: Layout, batch_id: str) -> dict | None:
    """What a batch read, if its checkpoint rows are 'done'."""
    log = CP.read_log(spark, layout.table(layout.checkpoint)).where(F.col(C.BATCH_ID) == batch_id)
    if log.where("state = 'done'").isEmpty():
        return None
    # A replayed batch has its 'pending' rows once, as they are written before its first attempt only.
    read = log.where("state = 'pending'").agg(F.count(F.lit(1)).alias("files"), F.sum(F.expr("next_offset - last_offset")).alias("rows")).first()
    rejects = 0
    if tables.table_exists(spark, layout.table(layout.rejects)):
        rejects = spark.table(layout.table(layout.rejects)).where(F.col(C.BATCH_ID) == batch_id).count()
    return {"files": read["files"], "rows": int(read["rows"] or 0), "rejects": rejects, "new_columns": []}


def ingest_batch(spark: SparkSession, layout: Layout, source_root: str, rows: int | None,
                 run_date: str | None = None, files: Sequence[str] | None = None, batch_id: str | None = None) -> dict:
    """Ingest the next ``rows`` lines of every source file into bronze.

    Source layout: ``source_root/source_file=<name>/*.json`` (JSON lines, in
    file-name order), or one file per source file directly under
    ``source_root`` (``20220403.json``: the name before the extension). Per
    file: current offset from the checkpoint log -> lines ``[offset, offset +
    rows)``, read from their byte ranges -> parse, flatten -> bronze and rejects
    -> checkpoint, in that order (Q4). The offset advances by the rows actually
    read (Q5); an empty slice changes nothing (Q14).

    A batch has an id and a partition of its own in bronze and rejects. Its
    'pending' checkpoint rows fix id, run date and line ranges before anything
    is written; 'done' rows follow. If a run died in between, the next run
    repeats exactly those ranges into the same partitions first, replacing what
    the dead attempt wrote, so rows and rejects are neither lost nor doubled.

    ``rows=None`` uses each file's last ``rows_per_run`` (the original stored
    it and never used it, Q15), else reads to the file's end. Malformed lines
    go to a rejects table with their offsets and still count as read (Q21).

    With ``batch_id`` the call is one certain batch: if that batch is complete
    (now, or after its replay), nothing more is read and its counts are returned.
    """
    run_date = run_date or _today()
    _open_layout(spark, layout)
    _finish_pending(spark, layout, source_root)
    if batch_id is not None and (known := _complete(spark, layout, batch_id)) is not None:
        return known
    plan = plan_batch(spark, layout, source_root, rows, run_date, files, batch_id, opened=True)
    if not plan.ranges:
        return {"files": len(plan.listing), "rows": 0, "rejects": 0, "new_columns": []}
    begin_batch(spark, layout, plan)
    n_rejects, new_cols = write_batch(spark, layout, plan)
    _mark_batch(spark, layout, plan, "done")
    # The line index of files now read to the end is no longer needed.
    LI.drop_finished(spark, _index_path(spark, layout), [r.name for r in plan.ranges if r.stop >= plan.lines[r.name]])
    return {"files": len(plan.listing), "rows": sum(r.stop - r.start for r in plan.ranges), "rejects": n_rejects,
            "new_columns": new_cols}


def silver_stage(spark: SparkSession, layout: Layout, run_date: str | None = None,
                 incremental: bool = False) -> int:
    """Silver snapshot of all bronze for ``run_date``; a rerun of the same day
    replaces that day's partition (Q7). Returns the rows written.

    ``incremental`` folds the committed batches that the silver ledger lacks
    (``plans.ledger``) and builds the same snapshot from its state, so a run
    reads new batches, not the history.
    """
    attach(spark, layout)
    run_date = run_date or _today()
    bronze = spark.table(layout.table(layout.bronze))
    if incremental:
        ledger = Ledger(spark, layout.folder(spark, layout.silver + "_state"))
        ledger.fold(bronze, committed_batches(spark, layout))
        if not ledger.state()[1]:
            return 0
        silver, obs = tables.counted(ledger.snapshot(run_date))
    else:
        silver, obs = tables.counted(SV.silver_summary(bronze, run_day=run_date))
    tables.overwrite_partitions(spark, layout.table(layout.silver), silver, [C.EXEC_DAY],
                                layout.location(layout.silver))
    return obs.get["rows"]


def gold_stage(spark: SparkSession, layout: Layout, run_date: str | None = None,
               incremental: bool = False) -> int:
    """Gold for ``run_date``: features of that day's silver snapshot, Active
    over all snapshots (Q8). Returns the rows written.

    ``incremental`` carries the per-contract day count forward from the
    previous day (``plans.incremental.active_fold``) instead of counting
    distinct days over every silver snapshot; days must then run in order.
    """
    attach(spark, layout)
    run_date = run_date or _today()
    silver = spark.table(layout.table(layout.silver))
    latest = silver.filter(F.col(C.EXEC_DAY) == F.lit(run_date))
    if incremental:
        from . import incremental as INC

        name = layout.gold + "_active"
        if layout.root:
            tables.register_existing(spark, layout.table(name), layout.location(name), [C.EXEC_DAY])
        active = INC.active_fold(spark, layout.table(name), latest, run_date, layout.location(name))
        feats = G.with_features(latest)
        gold = feats.join(active.select(C.CONTRACT, C.ACTIVE), C.CONTRACT, "inner").select(*feats.columns, C.ACTIVE)
    else:
        hist = silver.select(C.CONTRACT, C.EXEC_DAY)
        gold = G.gold_usage(latest, history=hist)
    gold, obs = tables.counted(gold)
    tables.overwrite_partitions(spark, layout.table(layout.gold), gold, [C.EXEC_DAY], layout.location(layout.gold))
    return obs.get["rows"]


def export_stage(spark: SparkSession, layout: Layout, target_schema: T.StructType = schemas.SERVING,
                 jdbc: JdbcTarget | None = None) -> str | None:
    """Latest gold snapshot -> align -> dedup -> keyed upsert into serving.

    The latest day comes from the partition list; only that partition is
    read. The serving table switches that partition by pointer
    (``sinks.versioned``), so a run that dies leaves the table as it was. With
    ``jdbc`` the rows go to a relational table instead, in that table's own
    column layout, through a staging table and a merge by key.
    """
    attach(spark, layout)
    gold_t = layout.table(layout.gold)
    day = tables.latest_partition(spark, gold_t, C.EXEC_DAY)
    if day is None:
        return None
    serving_t = layout.table(layout.serving)
    target = serving_table(spark, layout)
    if jdbc is not None:
        target_schema = jdbc.schema(spark)
    else:
        target.register(serving_t)  # a run that died after its commit left the catalog behind
        if tables.table_exists(spark, serving_t):
            target_schema = spark.table(serving_t).schema
    snap = spark.table(gold_t).filter(F.col(C.EXEC_DAY) == F.lit(day))
    rows = S.dedup_on_key(S.align_to_target(snap, target_schema), C.SERVING_KEY)
    if jdbc is not None:
        jdbc.upsert(spark, rows, C.SERVING_KEY)
        return day
    target.upsert(rows, C.SERVING_KEY)
    target.register(serving_t)
    return day


STAGES = ("bronze", "silver", "gold", "export")


def serving_table(spark: SparkSession, layout: Layout) -> VersionedTable:
    return VersionedTable(spark, layout.folder(spark, layout.serving), C.EXEC_DAY, lookup=C.CONTRACT)


def maintained_views(spark: SparkSession, layout: Layout) -> MaintainedViews:
    """The reporting views that follow the serving table version by version."""
    return MaintainedViews(spark, serving_table(spark, layout), layout.folder(spark, layout.serving + "_views"))


def run_batches(spark: SparkSession, layout: Layout, source_root: str,
                batches: Sequence[tuple[str | Sequence[str], int | None, str]], incremental: bool = False,
                jdbc: JdbcTarget | None = None, run_id: str | None = None) -> DataFrame:
    """Run bronze -> silver -> gold -> export for each (file, rows, run_date)
    (D10); ``file`` may also be a list of files ingested in the same batch.
    A failing stage skips the rest of that batch only; every stage gets a
    status row, so the caller sees exactly what ran (Q16).

    With ``run_id`` the stages' states are kept (``plans.run_ledger``): the same
    call after a failure or a kill goes on at the first stage that is not
    done, and reports the others as they ended."""
    status = []
    tables.create_namespace(spark, layout.database, layout.location("_db"))
    plans = [plan_of(b) for b in batches]
    ledger = RunLedger(spark, layout.table(RUN_LEDGER), layout.location(RUN_LEDGER), run_id) if run_id else None
    done = ledger.done(plans) if ledger else {}
    for k, (spec, n, run_date) in enumerate(batches):
        files = [spec] if isinstance(spec, str) else list(spec)
        name = ",".join(files)

        def bronze() -> str:
            batch_id = f"{run_id}-{k}" if run_id else None  # noqa: B023
            info = ingest_batch(spark, layout, source_root, n, run_date, files=files, batch_id=batch_id)  # noqa: B023
            return f"rows={info['rows']} rejects={info['rejects']}"

        work = {
            "bronze": bronze,
            "silver": lambda: f"rows={silver_stage(spark, layout, run_date, incremental=incremental)}",  # noqa: B023
            "gold": lambda: f"rows={gold_stage(spark, layout, run_date, incremental=incremental)}",  # noqa: B023
            "export": lambda: f"day={export_stage(spark, layout, jdbc=jdbc)}",
        }
        failed = False
        for stage in STAGES:
            if failed:
                status.append((name, run_date, stage, "skipped", None))
            elif (k, stage) in done:
                status.append((name, run_date, stage, "ok", done[k, stage]))
            else:
                try:
                    detail = ledger.step(k, plans[k], stage, work[stage]) if ledger else work[stage]()
                    status.append((name, run_date, stage, "ok", detail))
                except Exception as e:  # noqa: BLE001 - recorded, rest of batch skipped
                    failed = True
                    msg = f"{type(e).__name__}: {e}"[:500]
                    status.append((name, run_date, stage, "failed", msg + "\n" + traceback.format_exc(limit=2)[:500]))
    return spark.createDataFrame(status, "source_file string, run_date string, stage string, status string, "
                                         "detail string")
