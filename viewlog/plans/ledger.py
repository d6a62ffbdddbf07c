"""Incremental silver by a ledger of committed batches (D9, D10; Q4).

Bronze is written batch by batch, each under an id and into a partition of its
own, and a batch counts once its checkpoint rows are 'done'. Silver state grows
by the same unit: a fold takes the committed batches that the ledger lacks,
reads their partitions of bronze and no others, and writes one *run*:

* ``files``: per (Contract, source_file) the category sums and the row count;
* ``devices``: the (Contract, Mac) pairs that no earlier run holds;
* ``batches``: the batches folded, with nothing else to identify rows by.

The manifest lists the runs in force. A run that a dead fold left is in no
manifest, so its batches are folded again; a batch that died half-written is not
committed, so it is folded only after its replay. Rows are thus folded once,
whole, whatever died between.

From ``MAX_RUNS`` runs on, a fold merges all into one, so that a snapshot reads
few folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..operators.silver import ROWS, category_sums, quote_ident
from ..sinks import manifest as M
from ..sinks import tables

#: Runs in force before they are merged, and batches folded into one run.
MAX_RUNS = 8
FOLD_BATCHES = 1000

BATCHES = T.StructType([T.StructField(C.BATCH_ID, T.StringType())])
DEVICES = T.StructType([T.StructField(C.CONTRACT, T.StringType()), T.StructField(C.MAC, T.StringType())])


def _files_schema(columns: Sequence[str]) -> T.StructType:
    numbers = [T.StructField(c, T.LongType()) for c in (*columns, ROWS)]
    return T.StructType([T.StructField(C.CONTRACT, T.StringType()), *numbers, T.StructField(C.SOURCE_FILE, T.StringType())])


class Ledger:
    """The silver state under ``root``."""

    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str] = C.PIVOT_COLUMNS) -> None:
        self.spark, self.root, self.columns = spark, root.rstrip("/"), tuple(columns)
        self.schemas = {"files": _files_schema(columns), "devices": DEVICES, "batches": BATCHES}

    def state(self) -> tuple[int, list[str]]:
        """The version in force and its runs."""
        found = M.load(self.spark, self.root)
        return (0, []) if found is None else (found[0], found[1]["runs"])

    def table(self, what: str, runs: Sequence[str]) -> DataFrame:
        """``files``, ``devices`` or ``batches`` of the given runs."""
        if not runs:
            return self.spark.createDataFrame([], self.schemas[what])
        return self.spark.read.schema(self.schemas[what]).parquet(*[f"{self.root}/run-{r}/{what}" for r in runs])

    def _write(self, df: DataFrame, run: str, what: str) -> None:
        df.select(*self.schemas[what].fieldNames()).write.mode("overwrite").parquet(f"{self.root}/run-{run}/{what}")

    def _summed(self, rows: DataFrame) -> DataFrame:
        sums = [F.expr(f"sum({quote_ident(c)})").alias(c) for c in (*self.columns, ROWS)]
        return rows.groupBy(C.CONTRACT, C.SOURCE_FILE).agg(*sums)

    def unfolded(self, committed: DataFrame) -> list[str]:
        """Ids among ``committed`` (a column ``batch_id``) that no run holds; only new ids reach the driver."""
        _, runs = self.state()
        ids = committed.select(C.BATCH_ID).where(F.col(C.BATCH_ID).isNotNull()).distinct()
        return sorted(r[0] for r in ids.join(self.table("batches", runs), C.BATCH_ID, "left_anti").collect())

    def fold(self, bronze: DataFrame, committed: DataFrame) -> int:
        """Fold the committed batches that are not in the ledger; returns the rows folded."""
        new, rows = self.unfolded(committed), 0
        for k in range(0, len(new), FOLD_BATCHES):
            rows += self._fold(bronze, new[k : k + FOLD_BATCHES])
        return rows

    def _fold(self, bronze: DataFrame, ids: list[str]) -> int:
        version, runs = self.state()
        # A filter on a partition column: only the folders of these batches are listed and read.
        new = bronze.where(F.col(C.BATCH_ID).isin(ids) & F.col(C.CONTRACT).isNotNull())
        run = uuid.uuid4().hex
        per_file = new.groupBy(C.CONTRACT, C.SOURCE_FILE).agg(
            *category_sums(C.DURATION, self.columns, fill=False), F.count(F.lit(1)).alias(ROWS)
        )
        folded = Observation("folded")
        self._write(per_file.observe(folded, F.sum(ROWS).alias("n")), run, "files")
        pairs = new.where(F.col(C.MAC).isNotNull()).select(C.CONTRACT, C.MAC).distinct()
        if runs:
            pairs = pairs.join(self.table("devices", runs), [C.CONTRACT, C.MAC], "left_anti")
        self._write(pairs, run, "devices")
        self._write(self.spark.createDataFrame([(i,) for i in ids], BATCHES).coalesce(1), run, "batches")
        M.commit(self.spark, self.root, version + 1, {"runs": [*runs, run]})
        if len(runs) + 1 >= MAX_RUNS:
            self.merge()
        return int(folded.get["n"] or 0)

    def merge(self) -> None:
        """One run in place of all; the runs of earlier versions go, but for those of the last one."""
        version, runs = self.state()
        if len(runs) < 2:
            return
        run = uuid.uuid4().hex
        self._write(self._summed(self.table("files", runs)), run, "files")
        for what in ("devices", "batches"):
            self._write(self.table(what, runs), run, what)
        M.commit(self.spark, self.root, version + 1, {"runs": [run]})
        have = M.versions(self.spark, self.root)
        kept = {r for v in have[-2:] for r in M.load(self.spark, self.root, v)[1]["runs"]}
        p, fs = M._path(self.spark, self.root)
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("run-") and name[4:] not in kept:
                fs.delete(st.getPath(), True)
        M.forget(self.spark, self.root, have[:-2])

    def snapshot(self, run_day: str) -> DataFrame:
        """Silver rows for ``run_day``: those of ``operators.silver.silver_summary`` over all folded batches."""
        _, runs = self.state()
        # Spread by contract once: sums per file, totals and the join with the devices all keep that layout.
        files = self.table("files", runs).repartition(C.CONTRACT)
        if len(runs) > 1:
            files = self._summed(files)
        w = f"OVER (PARTITION BY {quote_ident(C.CONTRACT)})"
        totals = [F.expr(f"coalesce(sum({quote_ident(c)}) {w}, CAST(0 AS BIGINT))").alias(c) for c in self.columns]
        out = files.select(C.CONTRACT, *totals, F.expr(f"sum({quote_ident(ROWS)}) {w}").alias(C.TOTAL_DEVICES), C.SOURCE_FILE)
        devices = self.table("devices", runs).groupBy(C.CONTRACT).agg(F.count(F.lit(1)).alias("_d"))
        return out.join(devices, C.CONTRACT, "left").select(
            C.CONTRACT, *self.columns, C.TOTAL_DEVICES, F.coalesce("_d", F.lit(0).cast("bigint")).alias(C.DISTINCT_DEVICES),
            C.SOURCE_FILE, F.lit(run_day).alias(C.EXEC_DAY),
        )

