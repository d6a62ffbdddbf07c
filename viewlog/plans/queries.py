"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the provided tables (through the ``events`` adapter) over
their whole extent (a preview shows the first rows, a lookup those of its key); the DuckDB equivalents live in ``plans.oracle``.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..functions.categories import category_of
from ..operators import gold as G
from ..operators import serving as S
from ..operators import silver as SV
from ..operators import views as V
from ..sources.events_adapter import bronze_from_dir, events_as_bronze, read_events
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_dir(spark, sf_dir)


def _silver(bronze: DataFrame) -> DataFrame:
    # One snapshot per source-file day: execution_day is the file's day.
    return SV.silver_summary(bronze, run_day=None, day_col=C.EXEC_DATE)


def gold_from_bronze(bronze: DataFrame) -> DataFrame:
    return G.gold_usage(_silver(bronze))


def q_category_map(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return b.select(C.CONTRACT, C.MAC, C.DURATION, C.APP, category_of(C.APP).alias(C.TYPE), C.EXEC_DATE,
                    C.SOURCE_FILE)


def q_device_count(spark, sf_dir):
    return SV.device_count(_bronze(spark, sf_dir))


def q_duration_by_type(spark, sf_dir):
    return SV.duration_by_type(_bronze(spark, sf_dir))


def q_usage_pivot(spark, sf_dir):
    return SV.usage_pivot(_bronze(spark, sf_dir))


def q_contract_sources(spark, sf_dir):
    return SV.contract_sources(_bronze(spark, sf_dir))


def q_silver_summary(spark, sf_dir):
    return _silver(_bronze(spark, sf_dir))


def q_most_watch(spark, sf_dir):
    p = SV.usage_pivot(_bronze(spark, sf_dir))
    return G.with_features(p).select(C.CONTRACT, C.MOST_WATCH)


def q_taste(spark, sf_dir):
    p = SV.usage_pivot(_bronze(spark, sf_dir))
    return G.with_features(p).select(C.CONTRACT, C.TASTE)


def q_active_segment(spark, sf_dir):
    return G.active_days(_silver(_bronze(spark, sf_dir)))


def q_gold_usage(spark, sf_dir):
    """Flagship: bronze -> silver (fused pivot, devices, fan-out) -> gold."""
    return gold_from_bronze(_bronze(spark, sf_dir))


def _last_bronze_day(bronze: DataFrame, exclude_null_bucket: bool = False) -> Column:
    """Latest day of the gold built from ``bronze``: every bronze row with a
    contract yields gold rows for its day, so the max over bronze (one scan,
    one column) equals the max over gold without building gold twice."""
    b = bronze.filter(F.col(C.CONTRACT).isNotNull())
    if exclude_null_bucket:
        b = b.filter(F.col(C.CONTRACT) != F.lit(C.NULL_BUCKET_CONTRACT))
    return b.agg(F.max(C.EXEC_DATE)).scalar()


def q_latest_snapshot(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return S.latest_snapshot(gold_from_bronze(b), day=_last_bronze_day(b))


def q_null_bucket_filter(spark, sf_dir):
    return V.drop_null_bucket(q_gold_usage(spark, sf_dir))


def q_align_to_target(spark, sf_dir):
    return S.align_to_target(q_gold_usage(spark, sf_dir), schemas.SERVING)


def _old_gold(bronze: DataFrame) -> DataFrame:
    """Gold as an earlier run saw it: only the files up to a cut-off."""
    return gold_from_bronze(bronze.filter(F.col(C.SOURCE_FILE) <= F.lit(O.UPSERT_OLD_LAST_FILE)))


def q_dedup_on_key(spark, sf_dir):
    """Two snapshots that share serving keys, reduced to one row per key."""
    b = _bronze(spark, sf_dir)
    both = gold_from_bronze(b).unionByName(_old_gold(b))
    return S.dedup_on_key(both, C.SERVING_KEY)


def q_upsert_merge(spark, sf_dir):
    """Serving table after an upsert: an early export, then a re-export of
    the later files computed on all data."""
    b = _bronze(spark, sf_dir)
    target = S.align_to_target(_old_gold(b), schemas.SERVING)
    new = gold_from_bronze(b).filter(F.col(C.SOURCE_FILE) >= F.lit(O.UPSERT_NEW_FIRST_FILE))
    updates = S.align_to_target(new, schemas.SERVING)
    return S.upsert(target, updates, C.SERVING_KEY)


def q_v_kpi(spark, sf_dir):
    return V.v_kpi(q_gold_usage(spark, sf_dir))


def q_v_content(spark, sf_dir):
    return V.v_content(q_gold_usage(spark, sf_dir))


def q_v_segment(spark, sf_dir):
    return V.v_segment(q_gold_usage(spark, sf_dir))


def q_v_top(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return V.v_top(gold_from_bronze(b), O.TOP_N, day=_last_bronze_day(b, exclude_null_bucket=True))


def q_checkpoint_latest(spark, sf_dir):
    """Latest checkpoint per file from a checkpoint log derived from events
    (one log row per event: offset = event_id, updated_at = ts)."""
    from ..sources.checkpoint import latest_checkpoints

    ev = read_events(spark, sf_dir)
    log = ev.select(
        F.date_format("ts", "yyyyMMdd").alias("file_name"),
        F.col("event_id").alias("last_offset"),
        F.round(F.col("value") * 100).cast("bigint").alias("rows_per_run"),
        F.col("ts").cast("timestamp").alias("updated_at"),
    )
    return latest_checkpoints(log)


def log_dir(spark: SparkSession, sf_dir: str, per_file: bool, whole: bool = False) -> str:
    """The events as a raw JSON-lines log under the shared directory, written
    anew for each call: part of what a query that reads it costs. ``whole``
    puts each day into one file, as the file streams require."""
    from ..session import scratch_path
    from ..sources.events_adapter import write_source_log

    path = scratch_path(spark, "source-log")
    write_source_log(read_events(spark, sf_dir), path, per_file=per_file, whole=whole)
    return path


def q_offset_slice(spark, sf_dir):
    """Whole log cut into consecutive row-offset batches of SLICE_ROWS lines
    (S2): every line gets its file offset and batch number."""
    from ..sources import json_lines as J

    lines = J.indexed_lines(spark, log_dir(spark, sf_dir, per_file=False), file_col=J.ONE_FILE)
    recs = J.flatten(J.parse_records(lines, J.discover_source_schema(spark, lines)))
    return recs.select(
        C.ROW_INDEX,
        F.floor(F.col(C.ROW_INDEX) / O.SLICE_ROWS).cast("bigint").alias("batch_id"),
        C.CONTRACT, C.MAC, C.DURATION, C.APP,
        F.col("meta_file").alias(C.SOURCE_FILE),
    )


def q_flatten_source(spark, sf_dir):
    """JSON-lines read with key discovery and nested flatten."""
    from ..sources import json_lines as J

    lines = J.read_lines(spark, log_dir(spark, sf_dir, per_file=False))
    recs = J.flatten(J.parse_records(lines, J.discover_source_schema(spark, lines)))
    return recs.select(C.CONTRACT, C.MAC, C.DURATION, C.APP, "EventType", "meta_file", "meta_seq")


def _scratch_layout(spark: SparkSession, tag: str):
    import uuid

    from ..session import scratch_path
    from .pipeline import Layout

    return Layout(database=f"viewlog_{tag}_{uuid.uuid4().hex[:8]}", root=scratch_path(spark, tag))


def q_evolved_schema(spark, sf_dir):
    """Bronze table created from the early files, then appended with the later
    files that carry one more key (K1, K2, K5, K4): old rows read NULL."""
    from ..sinks import tables

    lay = _scratch_layout(spark, "evolve")
    tables.create_namespace(spark, lay.database, lay.location("_db"))
    t = lay.table(lay.bronze)
    tables.create_table(spark, t, schemas.BRONZE, [C.EXEC_DATE], lay.location(lay.bronze))
    b = events_as_bronze(read_events(spark, sf_dir), extra=("event_type",))
    early = b.filter(F.col(C.SOURCE_FILE) < F.lit(O.EVOLVE_FIRST_FILE)).drop("event_type")
    late = b.filter(F.col(C.SOURCE_FILE) >= F.lit(O.EVOLVE_FIRST_FILE))
    tables.append(spark, t, early, [C.EXEC_DATE])
    tables.append(spark, t, late.withColumnRenamed("event_type", "EventType"), [C.EXEC_DATE])
    return spark.table(t)


def q_incremental_ingest(spark, sf_dir):
    """Per-day JSON-lines files ingested in slices, a quarter of the longest
    file's lines per file and run, until a run finds nothing (D9): bronze then
    holds every line once, with its file offset."""
    from .pipeline import ingest_batch

    root = log_dir(spark, sf_dir, per_file=True)
    lay = _scratch_layout(spark, "ingest")
    days = read_events(spark, sf_dir).groupBy(F.date_format("ts", "yyyyMMdd")).count()
    longest = days.agg(F.max("count")).first()[0] or 1
    rows, day = -(-longest // O.INGEST_ROUNDS), _dt.date.fromisoformat(O.FIRST_RUN_DATE)
    while ingest_batch(spark, lay, root, rows, run_date=day.isoformat())["rows"]:
        day += _dt.timedelta(days=1)
    return spark.table(lay.table(lay.bronze)).select(C.CONTRACT, C.MAC, C.DURATION, C.APP, C.SOURCE_FILE,
                                                    C.ROW_INDEX)


def _odd_ingest(spark: SparkSession, sf_dir: str, tag: str):
    """Layout and result of ingesting the log with odd lines in one batch."""
    from ..session import scratch_path
    from ..sources.events_adapter import write_odd_log
    from .pipeline import ingest_batch

    root = scratch_path(spark, "odd-log")
    write_odd_log(read_events(spark, sf_dir), root)
    lay = _scratch_layout(spark, tag)
    return lay, ingest_batch(spark, lay, root, None, run_date=O.FIRST_RUN_DATE)


def q_odd_records(spark, sf_dir):
    """Bronze of a log with malformed lines, records without a payload and
    payloads without an app code: the latter two are rows with NULLs (Q13)."""
    lay, _ = _odd_ingest(spark, sf_dir, "odd")
    return spark.table(lay.table(lay.bronze)).select(C.CONTRACT, C.MAC, C.DURATION, C.APP, C.SOURCE_FILE, C.ROW_INDEX)


def q_ingest_rejects(spark, sf_dir):
    """The malformed lines of that log with their offsets (Q21)."""
    lay, _ = _odd_ingest(spark, sf_dir, "rejects")
    return spark.table(lay.table(lay.rejects)).select(C.SOURCE_FILE, C.ROW_INDEX, "line", C.EXEC_DATE)


def q_observed_counts(spark, sf_dir):
    """What the stages report of that log: lines read, malformed ones, silver and gold rows."""
    from .pipeline import gold_stage, silver_stage

    lay, info = _odd_ingest(spark, sf_dir, "counts")
    counts = [("read", info["rows"]), ("rejects", info["rejects"]), ("silver", silver_stage(spark, lay, O.FIRST_RUN_DATE)),
              ("gold", gold_stage(spark, lay, O.FIRST_RUN_DATE))]
    return spark.createDataFrame(counts, "what string, n bigint")


def q_stage_status(spark, sf_dir):
    """Status rows of a run over all day files, STATUS_FILES a batch, whose second batch names a file that is
    not there (Q16)."""
    from ..sinks import tables
    from .pipeline import run_batches

    root = log_dir(spark, sf_dir, per_file=True)
    days = tables.list_partition_values(spark, root, C.SOURCE_FILE)
    groups: list = [days[i:i + O.STATUS_FILES] for i in range(0, len(days), O.STATUS_FILES)]
    groups.insert(1, [O.MISSING_FILE])
    first = _dt.date.fromisoformat(O.FIRST_RUN_DATE)
    batches = [(g, None, (first + _dt.timedelta(days=k)).isoformat()) for k, g in enumerate(groups)]
    status = run_batches(spark, _scratch_layout(spark, "status"), root, batches)
    return status.select("source_file", "run_date", "stage", "status")


def q_replayed_ingest(spark, sf_dir):
    """Bronze after a run that died with half of a batch written, and the next
    run, which repeats the batch and goes on."""
    from . import pipeline as P

    root = log_dir(spark, sf_dir, per_file=True)
    lay = _scratch_layout(spark, "replay")
    whole = P.plan_batch(spark, lay, root, None, O.FIRST_RUN_DATE)
    ranges = [dataclasses.replace(r, stop=-(-r.stop // 2)) for r in whole.ranges]
    P.begin_batch(spark, lay, dataclasses.replace(whole, ranges=ranges))
    P.write_batch(spark, lay, dataclasses.replace(whole, ranges=[dataclasses.replace(r, start=r.stop // 2) for r in ranges]))
    P.ingest_batch(spark, lay, root, None, run_date=O.SECOND_RUN_DATE)
    return spark.table(lay.table(lay.bronze)).select(C.CONTRACT, C.MAC, C.DURATION, C.APP, C.SOURCE_FILE, C.ROW_INDEX, C.EXEC_DATE)


def q_evolved_types(spark, sf_dir):
    """A bronze column that comes as a number, a fraction and a text in turn: no value is cut or lost (K5, Q6)."""
    from ..sinks import tables

    lay = _scratch_layout(spark, "types")
    tables.create_namespace(spark, lay.database, lay.location("_db"))
    t = lay.table(lay.bronze)
    tables.create_table(spark, t, schemas.BRONZE, [C.EXEC_DATE], lay.location(lay.bronze))
    b = events_as_bronze(read_events(spark, sf_dir), extra=("event_type", "value"))
    kinds = [F.col(C.DURATION), F.col("value"), F.col("event_type")]
    for k, kind in enumerate(kinds):
        part = b.filter(F.dayofmonth(F.to_date(C.SOURCE_FILE, "yyyyMMdd")) % len(kinds) == k)
        tables.append(spark, t, part.withColumn("Extra" if k else "extra", kind).drop("event_type", "value"), [C.EXEC_DATE])
    return spark.table(t).select(C.CONTRACT, C.MAC, C.SOURCE_FILE, "extra", "Extra_double", "Extra_string")


def q_evolved_siblings(spark, sf_dir):
    """A column that comes as a fraction where the table holds whole numbers, beside keys that are called like
    the sibling it needs, in the table and in the same batch: nothing is cut, mixed or refused (K5)."""
    from ..sinks import tables

    lay = _scratch_layout(spark, "siblings")
    tables.create_namespace(spark, lay.database, lay.location("_db"))
    t = lay.table(lay.bronze)
    tables.create_table(spark, t, schemas.BRONZE, [C.EXEC_DATE], lay.location(lay.bronze))
    b = events_as_bronze(read_events(spark, sf_dir), extra=("event_id", "value"))
    whole, part = F.col("event_id"), F.col("value")
    kinds = [{"extra": whole, "extra_double": whole}, {"extra": part}, {"extra": part, "extra_double": whole}]
    for k, kind in enumerate(kinds):
        rows = b.filter(F.dayofmonth(F.to_date(C.SOURCE_FILE, "yyyyMMdd")) % len(kinds) == k)
        tables.append(spark, t, rows.withColumns(kind).drop("event_id", "value"), [C.EXEC_DATE])
    return spark.table(t).select(C.CONTRACT, C.MAC, C.SOURCE_FILE, "extra", "extra_double", "extra_double_2")


def q_registered_schema(spark, sf_dir):
    """Bronze seen by a process that knows only the schema register beside the files: of two keys that want one
    column name, each keeps its column when it comes without the other (K5, S8)."""
    from ..session import scratch_path
    from ..sources.events_adapter import source_records
    from .pipeline import Layout, attach, ingest_batch

    root, lay = scratch_path(spark, "keyed-log"), _scratch_layout(spark, "register")
    early = F.col(C.SOURCE_FILE) < F.lit(O.EVOLVE_FIRST_FILE)
    kind = F.col("_source.EventType")
    payload = F.col("_source").dropFields("EventType", "meta.seq").withField("meta_file", kind)
    payload = F.when(early, payload).otherwise(payload.withField("meta", F.lit(None)))
    lines = source_records(read_events(spark, sf_dir)).select(C.SOURCE_FILE, F.to_json(F.struct(payload.alias("_source"))).alias("value"))
    lines.write.partitionBy(C.SOURCE_FILE).text(root)
    for lot in (early, ~early):
        files = [r[0] for r in lines.where(lot).select(C.SOURCE_FILE).distinct().collect()]
        ingest_batch(spark, lay, root, None, run_date=O.FIRST_RUN_DATE, files=sorted(files))
    fresh = Layout(database=lay.database + "_again", root=lay.root)
    attach(spark, fresh)
    return spark.table(fresh.table(fresh.bronze)).select(C.CONTRACT, C.MAC, C.SOURCE_FILE, "meta_file", "meta_file_2")


def q_created_from_frame(spark, sf_dir):
    """Bronze created from the DataFrame itself, then appended to by name (K3, K4)."""
    from ..sinks import tables

    lay = _scratch_layout(spark, "create")
    tables.create_namespace(spark, lay.database, lay.location("_db"))
    t = lay.table(lay.bronze)
    b = _bronze(spark, sf_dir)
    early = F.col(C.SOURCE_FILE) < F.lit(O.EVOLVE_FIRST_FILE)
    tables.append(spark, t, b.filter(early), [C.EXEC_DATE])
    tables.append(spark, t, b.filter(~early).select(*reversed(b.columns)), [C.EXEC_DATE])
    return spark.table(t)


def q_table_preview(spark, sf_dir):
    """The first rows of the gold table as a stage shows them (O2), in key order."""
    from ..sinks import tables

    return tables.preview(q_gold_usage(spark, sf_dir).orderBy(*C.SERVING_KEY), O.TOP_N)


def q_upsert_versions(spark, sf_dir):
    """The two versions of a serving table that an early export and a later upsert leave, each read as it was
    committed (K8, J4)."""
    from ..session import scratch_path
    from ..sinks.versioned import VersionedTable

    b = _bronze(spark, sf_dir)
    new = gold_from_bronze(b).filter(F.col(C.SOURCE_FILE) >= F.lit(O.UPSERT_NEW_FIRST_FILE))
    table = VersionedTable(spark, scratch_path(spark, "versions"), C.EXEC_DAY)
    found = []
    for rows in (_old_gold(b), new):
        n = table.upsert(S.align_to_target(rows, schemas.SERVING), C.SERVING_KEY)
        found.append(n)
    names = [f.name for f in schemas.SERVING.fields]
    parts = [table.read(n).select(F.lit(n).cast("int").alias("version"), *names) for n in found]
    return parts[0].unionByName(parts[1])


def q_serving_lookup(spark, sf_dir):
    """Serving rows of the null bucket, looked up in the table that is laid out for reads by contract (K6)."""
    from ..session import scratch_path
    from ..sinks.versioned import VersionedTable

    table = VersionedTable(spark, scratch_path(spark, "lookup"), C.EXEC_DAY, lookup=C.CONTRACT)
    table.upsert(S.align_to_target(q_gold_usage(spark, sf_dir), schemas.SERVING), C.SERVING_KEY)
    return table.read().where(F.col(C.CONTRACT) == F.lit(C.NULL_BUCKET_CONTRACT))


def _dead_batch(spark: SparkSession, lay, root: str, run_date: str) -> None:
    """A batch of all lines left of each file that dies with half of them written."""
    from . import pipeline as P

    plan = P.plan_batch(spark, lay, root, None, run_date)
    P.begin_batch(spark, lay, plan)
    half = [dataclasses.replace(r, start=(r.start + r.stop) // 2) for r in plan.ranges]
    P.write_batch(spark, lay, dataclasses.replace(plan, ranges=half))


def q_ledger_fold(spark, sf_dir):
    """Incremental silver after half of the log, after a batch that died half-written, and after its replay:
    the dead half counts in none of them and nothing is lost (D9, D10)."""
    from .pipeline import ingest_batch, silver_stage

    root = log_dir(spark, sf_dir, per_file=True)
    lay = _scratch_layout(spark, "ledger")
    days = read_events(spark, sf_dir).groupBy(F.date_format("ts", "yyyyMMdd")).count()
    longest = days.agg(F.max("count")).first()[0] or 1
    ingest_batch(spark, lay, root, -(-longest // 2), run_date=O.FIRST_RUN_DATE)
    silver_stage(spark, lay, O.FIRST_RUN_DATE, incremental=True)
    _dead_batch(spark, lay, root, O.SECOND_RUN_DATE)
    silver_stage(spark, lay, O.SECOND_RUN_DATE, incremental=True)
    ingest_batch(spark, lay, root, None, run_date=O.THIRD_RUN_DATE)
    silver_stage(spark, lay, O.THIRD_RUN_DATE, incremental=True)
    return spark.table(lay.table(lay.silver))


def q_stream_ingest(spark, sf_dir):
    """Per-day JSON-lines files ingested into bronze as whole new files by an
    availableNow file stream (section 2.11); the second run adds nothing."""
    from ..session import scratch_path
    from ..streaming.bronze_stream import stream_ingest

    root = log_dir(spark, sf_dir, per_file=True, whole=True)
    lay = _scratch_layout(spark, "stream")
    ckpt = scratch_path(spark, "stream-ingest-ckpt")
    stream_ingest(spark, lay, root, ckpt, run_date="2024-02-01")
    stream_ingest(spark, lay, root, ckpt, run_date="2024-02-02")
    return spark.table(lay.table(lay.bronze)).select(C.CONTRACT, C.MAC, C.DURATION, C.APP, C.SOURCE_FILE,
                                                    C.ROW_INDEX)


def q_stream_offsets(spark, sf_dir):
    """Bronze of a log that comes in two lots of part files, streamed by row offset in micro-batches bounded by
    bytes (section 2.11, S6): each line once, numbered on from the lot before; a last run finds nothing."""
    from ..session import scratch_path
    from ..sources.events_adapter import write_source_log
    from ..streaming.offset_stream import offset_ingest

    root, checkpoint = scratch_path(spark, "lots"), scratch_path(spark, "offset-ckpt")
    lay = _scratch_layout(spark, "offsets")
    first = F.col("event_id") % O.FIRST_LOT == 0
    for lot in (first, ~first):
        write_source_log(read_events(spark, sf_dir).where(lot), root, per_file=True, mode="append")
        offset_ingest(spark, lay, root, checkpoint, run_date=O.FIRST_RUN_DATE)
    offset_ingest(spark, lay, root, checkpoint, run_date=O.SECOND_RUN_DATE)
    return spark.table(lay.table(lay.bronze)).select(C.CONTRACT, C.MAC, C.DURATION, C.APP, C.SOURCE_FILE, C.ROW_INDEX, C.EXEC_DATE)


def q_device_sketches(spark, sf_dir):
    """Distinct devices per contract by the union of its files' sketches: the exact count beside them, and
    whether the estimate lies within the stated bound (A1, A4)."""
    from ..operators import sketches as SK

    b = _bronze(spark, sf_dir)
    estimated = SK.merged(SK.device_sketches(b)).select(F.col(C.CONTRACT).alias("_contract"), SK.estimate().alias("_estimate"))
    exact = SV.device_count(b)
    both = exact.join(estimated, F.col(C.CONTRACT).eqNullSafe(F.col("_contract")))
    return both.select(C.CONTRACT, C.DISTINCT_DEVICES, SK.within_bound(F.col("_estimate"), F.col(C.DISTINCT_DEVICES)).alias("within_bound"))


def q_stream_device_count(spark, sf_dir):
    """Distinct devices per contract kept by a stream over a log that comes in two lots (A4, section 2.11)."""
    from ..session import scratch_path
    from ..sources.events_adapter import write_source_log
    from ..streaming.device_stream import count_devices

    root, out, checkpoint = (scratch_path(spark, f"devices-{x}") for x in ("log", "out", "ckpt"))
    first = F.col("event_id") % O.FIRST_LOT == 0
    for lot in (first, ~first):
        write_source_log(read_events(spark, sf_dir).where(lot), root, per_file=True, mode="append")
        found = count_devices(spark, root, out, checkpoint)
    return found


def q_maintained_views(spark, sf_dir):
    """The three views kept with the serving table over two exports, each refresh reading changed days only
    (D11); in one table of view, day, two labels and a number."""
    from ..session import scratch_path
    from ..sinks.versioned import VersionedTable
    from .maintained import MaintainedViews

    b = _bronze(spark, sf_dir)
    new = gold_from_bronze(b).filter(F.col(C.SOURCE_FILE) >= F.lit(O.UPSERT_NEW_FIRST_FILE))
    serving = VersionedTable(spark, scratch_path(spark, "served"), C.EXEC_DAY)
    views = MaintainedViews(spark, serving, scratch_path(spark, "served-views"))
    for rows in (_old_gold(b), new):
        serving.upsert(S.align_to_target(rows, schemas.SERVING), C.SERVING_KEY)
        views.refresh()
    none = F.lit(None).cast("string")
    kpi = views.read("v_kpi").unpivot([C.EXEC_DAY], ["contracts", V.TOTAL, "total_devices"], "a", "n")
    parts = [
        kpi.select(F.lit("v_kpi").alias("view"), C.EXEC_DAY, "a", none.alias("b"), "n"),
        views.read("v_content").select(F.lit("v_content"), C.EXEC_DAY, "category", none, "duration"),
        views.read("v_segment").select(F.lit("v_segment"), C.EXEC_DAY, C.ACTIVE, C.MOST_WATCH, "contracts"),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def q_resumed_run(spark, sf_dir):
    """A run over all day files whose second batch finds no files at first, started again under its id once they
    are there: the status of every stage, and how often each was started (D10, Q16)."""
    from ..session import scratch_path
    from ..sources.events_adapter import write_source_log
    from . import pipeline as P

    events, root, lay = read_events(spark, sf_dir), scratch_path(spark, "run-log"), _scratch_layout(spark, "resume")
    day = F.date_format("ts", "yyyyMMdd")
    days = sorted(r[0] for r in events.select(day).distinct().collect())
    groups = [days[i:i + O.STATUS_FILES] for i in range(0, len(days), O.STATUS_FILES)]
    late = day.isin(groups[1])
    first = _dt.date.fromisoformat(O.FIRST_RUN_DATE)
    batches = [(g, None, (first + _dt.timedelta(days=k)).isoformat()) for k, g in enumerate(groups)]
    for lot in (~late, late):
        write_source_log(events.where(lot), root, per_file=True, mode="append")
        status = P.run_batches(spark, lay, root, batches, run_id="run")
    starts = spark.table(lay.table(P.RUN_LEDGER)).where("state = 'started'")
    starts = starts.groupBy("batch", "stage").agg(F.count(F.lit(1)).alias("starts"))
    names = spark.createDataFrame([(k, ",".join(g)) for k, g in enumerate(groups)], "batch int, source_file string")
    return status.join(names, "source_file").join(starts, ["batch", "stage"]).select("source_file", "run_date", "stage", "status", "starts")


def _pipeline_serving(spark: SparkSession, sf_dir: str, incremental: bool) -> DataFrame:
    """The stage pipeline end to end (D10 -> D9, silver, gold, D8): the day
    files are ingested whole, FILES_PER_RUN per run, one run date per run;
    the result is the serving table after the last export."""
    from ..sinks import tables
    from .pipeline import run_batches

    root = log_dir(spark, sf_dir, per_file=True)
    days = tables.list_partition_values(spark, root, C.SOURCE_FILE)
    groups = [days[i:i + O.FILES_PER_RUN] for i in range(0, len(days), O.FILES_PER_RUN)]
    first = _dt.date.fromisoformat(O.FIRST_RUN_DATE)
    batches = [(g, None, (first + _dt.timedelta(days=k)).isoformat()) for k, g in enumerate(groups)]
    lay = _scratch_layout(spark, "pipe")
    status = run_batches(spark, lay, root, batches, incremental=incremental).collect()
    bad = [tuple(r) for r in status if r.status != "ok"]
    if bad:
        raise RuntimeError(f"pipeline stages failed: {bad[:3]}")
    return spark.table(lay.table(lay.serving))


def q_pipeline_serving(spark, sf_dir):
    return _pipeline_serving(spark, sf_dir, incremental=False)


def q_pipeline_serving_incremental(spark, sf_dir):
    return _pipeline_serving(spark, sf_dir, incremental=True)


def q_file_stream_usage(spark, sf_dir):
    """usage_pivot computed by a file stream (availableNow) over the events
    files: per micro-batch partial sums, merged at the end (section 2.11)."""
    from ..streaming.file_stream import stream_usage_pivot

    return stream_usage_pivot(spark, sf_dir, log_root=log_dir(spark, sf_dir, per_file=True, whole=True))


def registry() -> dict[str, Query]:
    return {
        "category_map": q_category_map,
        "device_count": q_device_count,
        "duration_by_type": q_duration_by_type,
        "usage_pivot": q_usage_pivot,
        "contract_sources": q_contract_sources,
        "silver_summary": q_silver_summary,
        "most_watch": q_most_watch,
        "taste": q_taste,
        "active_segment": q_active_segment,
        "gold_usage": q_gold_usage,
        "latest_snapshot": q_latest_snapshot,
        "null_bucket_filter": q_null_bucket_filter,
        "align_to_target": q_align_to_target,
        "dedup_on_key": q_dedup_on_key,
        "upsert_merge": q_upsert_merge,
        "v_kpi": q_v_kpi,
        "v_content": q_v_content,
        "v_segment": q_v_segment,
        "v_top": q_v_top,
        "checkpoint_latest": q_checkpoint_latest,
        "offset_slice": q_offset_slice,
        "flatten_source": q_flatten_source,
        "evolved_schema": q_evolved_schema,
        "incremental_ingest": q_incremental_ingest,
        "odd_records": q_odd_records,
        "ingest_rejects": q_ingest_rejects,
        "observed_counts": q_observed_counts,
        "stage_status": q_stage_status,
        "replayed_ingest": q_replayed_ingest,
        "evolved_types": q_evolved_types,
        "evolved_siblings": q_evolved_siblings,
        "created_from_frame": q_created_from_frame,
        "registered_schema": q_registered_schema,
        "table_preview": q_table_preview,
        "upsert_versions": q_upsert_versions,
        "serving_lookup": q_serving_lookup,
        "ledger_fold": q_ledger_fold,
        "file_stream_usage": q_file_stream_usage,
        "stream_ingest": q_stream_ingest,
        "stream_offsets": q_stream_offsets,
        "device_sketches": q_device_sketches,
        "stream_device_count": q_stream_device_count,
        "maintained_views": q_maintained_views,
        "resumed_run": q_resumed_run,
        "pipeline_serving": q_pipeline_serving,
        "pipeline_serving_incremental": q_pipeline_serving_incremental,
    }

# Queries with no SQL equivalent (the driver then checks row counts only).
NO_ORACLE: frozenset[str] = frozenset()
