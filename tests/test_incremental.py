import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from viewlog import constants as C
from viewlog.operators import silver as SV
from viewlog.plans import incremental as INC
from viewlog.plans import pipeline as P
from viewlog.sinks import tables

APPS = ["VOD", "SPORT", None, "RELAX", "KPlus", "junk", "CHILD"]


def _write(root, name, start, n):
    d = f"{root}/source_file={name}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/log.json", "a") as f:
        for i in range(start, start + n):
            rec = {"_source": {"Contract": None if i % 11 == 0 else f"c{i % 5}", "Mac": None if i % 7 == 0 else f"m{i % 3}",
                               "TotalDuration": None if i % 13 == 0 else i, "AppName": APPS[i % 7]}}
            f.write(json.dumps(rec) + "\n")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_silver_equals_full_rebuild(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "src")
    lay = P.Layout(database=f"i_{uuid.uuid4().hex[:8]}", root=str(tmp_path / "tables"))
    _write(src, "20240101", 0, 30)
    _write(src, "20240102", 100, 20)
    days = ["2024-03-01", "2024-03-02", "2024-03-03", "2024-03-04"]
    for k, day in enumerate(days):
        if k == 2:  # more lines arrive in an old file and a new file appears
            _write(src, "20240101", 30, 9)
            _write(src, "20240103", 200, 15)
        P.ingest_batch(spark, lay, src, 12, run_date=day)
        if k == 1:
            # crash after the device append, before the partition rewrite
            real = tables.overwrite_partitions

            def boom(*a, **kw):
                raise RuntimeError("lost")

            monkeypatch.setattr(tables, "overwrite_partitions", boom)
            with pytest.raises(RuntimeError):
                P.silver_stage(spark, lay, day, incremental=True)
            monkeypatch.setattr(tables, "overwrite_partitions", real)
        P.silver_stage(spark, lay, day, incremental=True)
        P.silver_stage(spark, lay, day, incremental=True)  # rerun: nothing new to fold
        bronze = spark.table(lay.table(lay.bronze))
        want = _rows(SV.silver_summary(bronze, run_day=day))
        got = _rows(spark.table(lay.table(lay.silver)).filter(F.col(C.EXEC_DAY) == day).select(
            C.CONTRACT, *C.PIVOT_COLUMNS, C.TOTAL_DEVICES, C.DISTINCT_DEVICES, C.SOURCE_FILE, C.EXEC_DAY))
        assert got == want, day


def test_fold_returns_zero_without_new_rows(spark, tmp_path):
    src = str(tmp_path / "src")
    lay = P.Layout(database=f"i_{uuid.uuid4().hex[:8]}", root=str(tmp_path / "tables"))
    _write(src, "20240101", 0, 10)
    P.ingest_batch(spark, lay, src, 100, run_date="2024-03-01")
    b = spark.table(lay.table(lay.bronze))
    ft, dt = lay.table("f"), lay.table("d")
    assert INC.fold(spark, b, ft, dt) == 9  # one NULL contract is not folded
    assert INC.fold(spark, b, ft, dt) == 0


def test_incremental_gold_equals_full(spark, tmp_path):
    src = str(tmp_path / "src")
    full = P.Layout(database=f"g_{uuid.uuid4().hex[:8]}", root=str(tmp_path / "full"))
    inc = P.Layout(database=f"g_{uuid.uuid4().hex[:8]}", root=str(tmp_path / "inc"))
    for k in range(6):
        _write(src, f"2024010{k + 1}", 50 * k, 8)
    days = [f"2024-03-0{k + 1}" for k in range(6)]
    batches = [(f"2024010{k + 1}", 100, d) for k, d in enumerate(days)]
    assert all(r.status == "ok" for r in P.run_batches(spark, full, src, batches).collect())
    assert all(r.status == "ok" for r in P.run_batches(spark, inc, src, batches, incremental=True).collect())
    P.gold_stage(spark, inc, days[-1], incremental=True)  # rerun of the last day changes nothing
    for lay in (full, inc):
        spark.catalog.refreshTable(lay.table(lay.gold))
    a = _rows(spark.table(full.table(full.gold)))
    b = _rows(spark.table(inc.table(inc.gold)))
    assert a == b
    assert any(r.Active == "High" for r in spark.table(inc.table(inc.gold)).collect())


def test_fold_null_source_file_matches_full(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField(C.CONTRACT, T.StringType()), T.StructField(C.MAC, T.StringType()),
        T.StructField(C.DURATION, T.LongType()), T.StructField(C.APP, T.StringType()),
        T.StructField(C.SOURCE_FILE, T.StringType()), T.StructField(C.ROW_INDEX, T.LongType()),
        T.StructField(C.EXEC_DATE, T.StringType()),
    ])
    first = [("A", "m", 5, "VOD", "f1", 0, "d1"), ("A", "n", 7, None, None, 0, "d1"), ("B", "m", 1, "SPORT", None, 1, "d1")]
    more = [("A", "m", 2, "RELAX", None, 2, "d2"), ("B", None, 3, "VOD", "f1", 1, "d2")]
    ft, dt = f"inc_null_{uuid.uuid4().hex[:6]}_f", f"inc_null_{uuid.uuid4().hex[:6]}_d"
    b1 = spark.createDataFrame(first, schema)
    INC.fold(spark, b1, ft, dt, location=str(tmp_path / "s"))
    b2 = spark.createDataFrame(first + more, schema)
    INC.fold(spark, b2, ft, dt, location=str(tmp_path / "s"))
    assert INC.fold(spark, b2, ft, dt, location=str(tmp_path / "s")) == 0
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    assert rows(INC.snapshot(spark, ft, dt, "x")) == rows(SV.silver_summary(b2, run_day="x"))
