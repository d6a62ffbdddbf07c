"""Maintained views (D11): v_kpi, v_content and v_segment kept with the serving table.

Each view's rows depend on one day of the serving table only, and an upsert
switches whole days by pointer. So a refresh compares the partitions of the
serving version in force with those the views were last built from, takes the
changed days out of every view and puts their new rows in; other days are not
read. The result equals a full rebuild.

A refresh that dies leaves some views ahead of others at worst, each whole; the
next one starts from the version recorded before and redoes the same days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators import views as V
from ..sinks import manifest as M
from ..sinks.versioned import VersionedTable

VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {"v_kpi": V.v_kpi, "v_content": V.v_content, "v_segment": V.v_segment}
FOLDER = "_built_from"


class MaintainedViews:
    """The views of ``serving``, as tables under ``root``."""

    def __init__(self, spark: SparkSession, serving: VersionedTable, root: str) -> None:
        self.spark, self.serving, self.root = spark, serving, root.rstrip("/")

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}", C.EXEC_DAY)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def refresh(self) -> list[str]:
        """Bring all views up to the serving version in force; returns the day folders that were rebuilt."""
        now = self.serving.version()
        if now is None:
            return []
        found = M.load(self.spark, self.root, folder=FOLDER)
        before = found[1]["partitions"] if found else {}
        changed = sorted(n for n in {*before, *now.partitions} if before.get(n) != now.partitions.get(n))
        if not changed and found:
            return []
        days = self.serving.rows(now, {n: now.partitions[n] for n in changed if n in now.partitions})
        for name, view in VIEWS.items():
            self.table(name).replace(view(days), changed)
        M.commit(self.spark, self.root, (found[0] if found else 0) + 1, {"partitions": now.partitions}, folder=FOLDER)
        M.forget(self.spark, self.root, M.versions(self.spark, self.root, FOLDER)[:-2], folder=FOLDER)
        return changed
