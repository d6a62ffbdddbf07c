"""Sketches, devices on a stream, maintained views and resumable runs."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from viewlog import constants as C
from viewlog import schemas
from viewlog.operators import serving as S
from viewlog.operators import sketches as SK
from viewlog.operators import silver as SV
from viewlog.plans import maintained as MV
from viewlog.plans import pipeline as P
from viewlog.sinks.versioned import VersionedTable
from viewlog.streaming import device_stream as DS


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _serving(spark, rows):
    """(Contract, day, file, seconds, devices, Active)"""
    base = spark.createDataFrame(rows, "Contract string, execution_day string, source_file string, VOD bigint, TotalDevices bigint, Active string")
    base = base.withColumns({"Phim_Truyen": F.col("VOD"), C.MOST_WATCH: F.lit("Phim_Truyen")})
    return S.align_to_target(base, schemas.SERVING)


def test_views_equal_a_full_rebuild_after_each_export(spark, tmp_path, monkeypatch):
    serving = VersionedTable(spark, str(tmp_path / "s"), C.EXEC_DAY)
    views = MV.MaintainedViews(spark, serving, str(tmp_path / "v"))
    assert views.refresh() == []
    exports = [
        [("a", "d1", "f", 5, 1, "Low"), ("b", "d1", "f", 7, 2, "High"), ("0", "d2", "f", 9, 9, "Low")],
        [("a", "d1", "f", 50, 3, "High"), ("c", "d3", "f", 1, 1, "Low")],
        [("c", None, "f", 2, 1, "Low"), ("b", "d2", "g", 4, 4, None)],
    ]
    for k, rows in enumerate(exports):
        serving.upsert(_serving(spark, rows), C.SERVING_KEY)
        if k == 1:  # a refresh that dies between two views is made up for
            real, seen = VersionedTable.replace, []

            def replace(self, *a, **kw):
                if seen:
                    raise RuntimeError("lost")
                seen.append(1)
                return real(self, *a, **kw)  # noqa: B023

            with monkeypatch.context() as m:
                m.setattr(VersionedTable, "replace", replace)
                with pytest.raises(RuntimeError):
                    views.refresh()
        changed = views.refresh()
        assert changed == [["execution_day=d1", "execution_day=d2"], ["execution_day=d1", "execution_day=d3"],
                           ["execution_day=__HIVE_DEFAULT_PARTITION__", "execution_day=d2"]][k]
        for name, view in MV.VIEWS.items():
            full = view(serving.read())
            assert _rows(views.read(name).select(*full.columns)) == _rows(full), (k, name)
        assert views.refresh() == []


def test_sketches_merge_over_any_split_and_stay_within_the_bound(spark):
    b = spark.range(60_000).select(
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias(C.CONTRACT),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 9001).cast("string")).alias(C.MAC),
        (F.col("id") % 5).cast("string").alias(C.SOURCE_FILE),
    ).unionByName(spark.createDataFrame([("none", None, "f"), (None, "m", "f")], f"{C.CONTRACT} string, {C.MAC} string, {C.SOURCE_FILE} string"))
    exact = {r[0]: r[1] for r in SV.device_count(b).select(C.CONTRACT, C.DISTINCT_DEVICES).collect()}
    whole = {r[0]: r[1] for r in SK.device_sketches(b, [C.CONTRACT]).select(C.CONTRACT, SK.estimate()).collect()}
    merged = {r[0]: r[1] for r in SK.merged(SK.device_sketches(b)).select(C.CONTRACT, SK.estimate()).collect()}
    assert exact.keys() == merged.keys() == whole.keys() and merged["none"] == 0 and merged[None] == 1
    for k, n in exact.items():
        assert abs(merged[k] - n) <= max(1, SK.BOUND * n) and abs(whole[k] - n) <= max(1, SK.BOUND * n)


def _lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "a") as f:
        f.writelines(json.dumps({"_source": {"Contract": c, "Mac": m}}) + "\n" for c, m in rows)


def test_devices_on_a_stream_count_once_through_replays(spark, tmp_path, monkeypatch):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    _lines(f"{src}/f.json", [("a", "1"), ("a", "1"), ("b", None), ("a", "2")])
    got = DS.count_devices(spark, src, out, ck)
    assert _rows(got) == [("a", 2), ("b", 0)]
    _lines(f"{src}/f.json", [("a", "2"), ("a", "3"), ("b", "1")])
    real = DS.write_counts

    def dies(*a):
        real(*a)  # its counts are written, the micro-batch is not committed
        raise RuntimeError("lost")

    monkeypatch.setattr(DS, "write_counts", dies)
    with pytest.raises(Exception, match="lost"):
        DS.count_devices(spark, src, out, ck)
    monkeypatch.setattr(DS, "write_counts", real)
    assert _rows(DS.count_devices(spark, src, out, ck)) == [("a", 3), ("b", 1)]
    assert _rows(DS.count_devices(spark, src, out, ck)) == [("a", 3), ("b", 1)]


def _log(root, name, n):
    os.makedirs(f"{root}/source_file={name}", exist_ok=True)
    with open(f"{root}/source_file={name}/log.json", "w") as f:
        for i in range(n):
            f.write(json.dumps({"_source": {"Contract": f"c{i % 3}", "Mac": f"m{i % 4}", "TotalDuration": i, "AppName": "VOD"}}) + "\n")


@pytest.mark.parametrize("dies_in", ["bronze", "gold"])
def test_a_killed_run_goes_on_where_it_died(spark, tmp_path, monkeypatch, dies_in):
    src = str(tmp_path / "src")
    _log(src, "f1", 12)
    lay = P.Layout(database=f"r_{uuid.uuid4().hex[:8]}", root=str(tmp_path / "tables"))
    batches = [("f1", 4, "2024-03-01"), ("f1", 4, "2024-03-02")]

    class Killed(BaseException):
        pass

    real_mark, real_gold, calls = P._mark_batch, P.gold_stage, []

    def mark(spark_, layout, plan, state):
        real_mark(spark_, layout, plan, state)
        if state == "pending" and plan.run_date == "2024-03-02":
            raise Killed

    def gold(spark_, layout, day, **k):
        calls.append(day)
        if day == "2024-03-02" and calls.count(day) == 1:
            raise Killed
        return real_gold(spark_, layout, day, **k)

    with monkeypatch.context() as m:
        m.setattr(*((P, "_mark_batch", mark) if dies_in == "bronze" else (P, "gold_stage", gold)))
        with pytest.raises(Killed):
            P.run_batches(spark, lay, src, batches, run_id="nightly")
    again = P.run_batches(spark, lay, src, batches, run_id="nightly").collect()
    assert [r.status for r in again] == ["ok"] * 8
    # The second batch was read once, though it was started twice: four lines, not eight.
    assert sorted(r[C.ROW_INDEX] for r in spark.table(lay.table(lay.bronze)).collect()) == list(range(8))
    states = {(r["batch"], r["stage"]): r["n"] for r in spark.table(lay.table(P.RUN_LEDGER)).where("state = 'started'")
              .groupBy("batch", "stage").agg(F.count("*").alias("n")).collect()}
    assert states == {(b, s): 2 if (b, s) == (1, dies_in) else 1 for b in (0, 1) for s in P.STAGES}
    with pytest.raises(ValueError, match="other batches"):
        P.run_batches(spark, lay, src, [("f1", 5, "2024-03-01")], run_id="nightly")
