"""Resumable runs (D10, Q16): the state of every stage of a run, on shared storage.

A run has an id and a fixed list of batches. Before and after each stage its
state is recorded; a run that is started again under its id skips the stages
that are 'ok', redoes the one that died in the middle ('started') or 'failed',
and goes on. Stages are safe to repeat: a batch's lines are written by batch id,
a day's partitions are overwritten, and the export upserts by key.
"""

from __future__ import annotations

import datetime as _dt
import json
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import tables

SCHEMA = "run_id string, batch int, plan bigint, stage string, state string, detail string, at timestamp"


class RunLedger:
    def __init__(self, spark: SparkSession, table: str, location: str | None, run_id: str) -> None:
        self.spark, self.table, self.location, self.run_id = spark, table, location, run_id
        if location:
            tables.register_existing(spark, table, location)

    def states(self) -> DataFrame:
        """batch, stage, plan, state, detail: the newest state of each stage of the run."""
        if not tables.table_exists(self.spark, self.table):
            return self.spark.createDataFrame([], "batch int, stage string, plan bigint, state string, detail string")
        rows = self.spark.table(self.table).where(F.col("run_id") == self.run_id)
        last = F.max_by(F.struct("plan", "state", "detail"), F.col("at")).alias("s")
        return rows.groupBy("batch", "stage").agg(last).select("batch", "stage", "s.plan", "s.state", "s.detail")

    def record(self, batch: int, plan: int, stage: str, state: str, detail: str | None = None) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        row = self.spark.createDataFrame([(self.run_id, batch, plan, stage, state, detail, now)], SCHEMA)
        tables.append(self.spark, self.table, row.coalesce(1), [], self.location)

    def done(self, plans: Sequence[int]) -> dict[tuple[int, str], str | None]:
        """The stages that are 'ok', with their details; refuses a run id whose batches were others."""
        out = {}
        for r in self.states().collect():  # one row per stage of the run
            if r["batch"] >= len(plans) or plans[r["batch"]] != r["plan"]:
                raise ValueError(f"run {self.run_id} was started with other batches")
            if r["state"] == "ok":
                out[r["batch"], r["stage"]] = r["detail"]
        return out

    def step(self, batch: int, plan: int, stage: str, work: Callable[[], str]) -> str:
        """Run one stage between its 'started' and 'ok' (or 'failed') rows."""
        self.record(batch, plan, stage, "started")
        try:
            detail = work()
        except Exception as e:
            self.record(batch, plan, stage, "failed", f"{type(e).__name__}: {e}"[:500])
            raise
        self.record(batch, plan, stage, "ok", detail)
        return detail


def plan_of(batch: Sequence) -> int:
    """A number that names a batch's files, rows and date."""
    files, rows, date = batch
    names = [files] if isinstance(files, str) else list(files)
    return zlib.crc32(json.dumps([names, rows, date]).encode())
