import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from viewlog import constants as C
from viewlog.plans import pipeline as P
from viewlog.sources import checkpoint as CP

APPS = ["VOD", "SPORT", "CHILD", "RELAX", "KPlus", None, "junk"]


def _log(root, name, n, start=0):
    d = f"{root}/source_file={name}"
    os.makedirs(d, exist_ok=True)
    lines = []
    for i in range(start, start + n):
        rec = {"_source": {"Contract": f"c{i % 7}", "Mac": f"m{i % 3}", "TotalDuration": i, "AppName": APPS[i % 7]}}
        lines.append(json.dumps(rec))
    with open(f"{d}/part-00000.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    return lines


@pytest.fixture()
def layout(fresh_dir):
    return P.Layout(database=f"t_{uuid.uuid4().hex[:8]}", root=f"{fresh_dir}/tables")


def _bronze(spark, layout):
    return spark.table(layout.table(layout.bronze))


def test_batches_resume_and_cover_file(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220403", 23)
    sizes = []
    for day in ("2024-02-01", "2024-02-02", "2024-02-03", "2024-02-04"):
        sizes.append(P.ingest_batch(spark, layout, src, 10, run_date=day)["rows"])
    assert sizes == [10, 10, 3, 0]  # offset advances by rows read; past EOF is a no-op
    b = _bronze(spark, layout)
    assert sorted(r[C.ROW_INDEX] for r in b.collect()) == list(range(23))
    log = CP.latest_checkpoints(spark.table(layout.table(layout.checkpoint))).collect()
    assert [(r.file_name, r.last_offset) for r in log] == [("20220403", 23)]


def test_crash_between_write_and_checkpoint(spark, fresh_dir, layout, monkeypatch):
    src = f"{fresh_dir}/src"
    _log(src, "20220404", 15)
    P.ingest_batch(spark, layout, src, 5, run_date="2024-02-01")
    real = CP.append

    def boom(*a, **k):
        # dies after the bronze write, before the completing checkpoint row
        if k.get("state", "done") == "done":
            raise RuntimeError("lost before checkpoint")
        return real(*a, **k)

    monkeypatch.setattr(CP, "append", boom)
    with pytest.raises(RuntimeError):
        P.ingest_batch(spark, layout, src, 5, run_date="2024-02-02")
    monkeypatch.setattr(CP, "append", real)
    P.ingest_batch(spark, layout, src, 5, run_date="2024-02-03")
    idx = sorted(r[C.ROW_INDEX] for r in _bronze(spark, layout).collect())
    assert idx == list(range(15))  # nothing lost, nothing twice


def test_crash_during_bronze_write(spark, fresh_dir, layout, monkeypatch):
    from viewlog.sinks import tables as TB

    src = f"{fresh_dir}/src"
    _log(src, "20220409", 9)
    P.ingest_batch(spark, layout, src, 4, run_date="2024-02-01")
    real = TB.overwrite_partitions

    def boom(spark_, table, df, *a, **k):
        # Rows 6 and 7 of 4-7 reach bronze before the run dies.
        if table.endswith(layout.bronze):
            real(spark_, table, df.where(F.col(C.ROW_INDEX) >= 6), *a, **k)
            raise RuntimeError("write failed")
        return real(spark_, table, df, *a, **k)

    monkeypatch.setattr(TB, "overwrite_partitions", boom)
    with pytest.raises(RuntimeError):
        P.ingest_batch(spark, layout, src, 4, run_date="2024-02-02")
    monkeypatch.setattr(TB, "overwrite_partitions", real)
    P.ingest_batch(spark, layout, src, 100, run_date="2024-02-03")
    assert sorted(r[C.ROW_INDEX] for r in _bronze(spark, layout).collect()) == list(range(9))


def test_crash_before_rejects(spark, fresh_dir, layout, monkeypatch):
    from viewlog.sinks import tables as TB

    src = f"{fresh_dir}/src"
    _log(src, "20220410", 4)
    with open(f"{src}/source_file=20220410/part-00001.json", "w") as f:
        f.write("not json\n")
    real = TB.overwrite_partitions

    def boom(spark_, table, *a, **k):
        if table.endswith(layout.rejects):
            raise RuntimeError("lost before rejects")
        return real(spark_, table, *a, **k)

    monkeypatch.setattr(TB, "overwrite_partitions", boom)
    with pytest.raises(RuntimeError):
        P.ingest_batch(spark, layout, src, None, run_date="2024-02-01")
    monkeypatch.setattr(TB, "overwrite_partitions", real)
    assert P.ingest_batch(spark, layout, src, None, run_date="2024-02-02")["rows"] == 0
    assert sorted(r[C.ROW_INDEX] for r in _bronze(spark, layout).collect()) == [0, 1, 2, 3]
    assert [r["line"] for r in spark.table(layout.table(layout.rejects)).collect()] == ["not json"]


def test_finished_file_is_not_indexed_again(spark, fresh_dir, layout, monkeypatch):
    from viewlog.sources import line_index as LI

    src = f"{fresh_dir}/src"
    _log(src, "20220411", 20)
    builds = []
    real = LI.build_index
    monkeypatch.setattr(LI, "build_index", lambda *a, **k: builds.append(1) or real(*a, **k))
    sizes = [P.ingest_batch(spark, layout, src, None, run_date=f"2024-02-0{d}")["rows"] for d in (1, 2, 3)]
    assert (sizes, len(builds)) == ([20, 0, 0], 1)
    _log(src, "20220412", 0)
    with open(f"{src}/source_file=20220412/part-00000.json", "w") as f:
        f.write("\n  \n\n")
    assert P.ingest_batch(spark, layout, src, None, run_date="2024-02-04")["rows"] == 0


def test_evolved_column_survives_a_new_catalog(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220413", 4)
    P.ingest_batch(spark, layout, src, None, run_date="2024-02-01")
    _log(src, "20220414", 2)
    with open(f"{src}/source_file=20220414/part-00001.json", "w") as f:
        f.write(json.dumps({"_source": {"Contract": "n", "extra": 1}}) + "\n")
    P.ingest_batch(spark, layout, src, None, run_date="2024-02-02")
    again = P.Layout(database=f"t_{uuid.uuid4().hex[:8]}", root=layout.root)
    P.attach(spark, again)
    b = _bronze(spark, again)
    assert b.count() == 7 and [r["extra"] for r in b.filter("extra IS NOT NULL").collect()] == [1]


def test_type_changes_keep_values(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    for k, value in enumerate([3, 0.75, "text", 4]):
        d = f"{src}/source_file=2022050{k}"
        os.makedirs(d)
        with open(f"{d}/part-00000.json", "w") as f:
            f.write(json.dumps({"_source": {"Contract": f"c{k}", "Extra" if k else "extra": value}}) + "\n")
        P.ingest_batch(spark, layout, src, None, run_date=f"2024-02-0{k + 1}")
    b = _bronze(spark, layout)
    got = {r["Contract"]: (r["extra"], r["Extra_double"], r["Extra_string"]) for r in b.collect()}
    assert got == {"c0": (3, None, None), "c1": (None, 0.75, None), "c2": (None, None, "text"), "c3": (4, None, None)}


def test_clashing_keys_are_renamed(spark, fresh_dir, layout):
    d = f"{fresh_dir}/src/source_file=20220501"
    os.makedirs(d)
    record = {"Contract": "c", "AppName": "VOD", "appname": "x", "source_file": "y", "a": {"b": 1}, "a_b": 2, "VOID": 3}
    with open(f"{d}/part-00000.json", "w") as f:
        f.write(json.dumps({"_source": record}) + "\n")
    P.ingest_batch(spark, layout, f"{fresh_dir}/src", None, run_date="2024-02-01")
    r = _bronze(spark, layout).first().asDict()
    assert (r["AppName"], r["appname_2"], r["source_file"], r["source_file_2"], r["VOID"]) == ("VOD", "x", "20220501", "y", 3)
    assert sorted((r["a_b"], r["a_b_2"])) == [1, 2]


def test_schema_evolution_in_bronze(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220405", 4)
    P.ingest_batch(spark, layout, src, 10, run_date="2024-02-01")
    d = f"{src}/source_file=20220405"
    with open(f"{d}/part-00001.json", "w") as f:
        f.write(json.dumps({"_source": {"Contract": "n", "Region": "north", "Score": 3}}) + "\n")
    info = P.ingest_batch(spark, layout, src, 10, run_date="2024-02-02")
    assert info["rows"] == 1 and set(info["new_columns"]) == {"Region", "Score"}
    b = _bronze(spark, layout)
    assert dict(b.dtypes)["Score"] == "bigint"  # real type, not a blanket BIGINT
    assert b.filter(F.col("Region").isNull()).count() == 4


def test_run_batches_end_to_end_and_idempotent(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220403", 12)
    _log(src, "20220404", 12, start=100)
    batches = [("20220403", 10, "2024-03-01"), ("20220404", 10, "2024-03-02")]
    st = P.run_batches(spark, layout, src, batches).collect()
    assert all(r.status == "ok" for r in st), [tuple(r) for r in st]
    serving = spark.table(layout.table(layout.serving))
    first = sorted(tuple(r) for r in serving.collect())
    assert {r.execution_day for r in serving.collect()} == {"2024-03-01", "2024-03-02"}
    # Rerun of the last day's silver, gold and export changes nothing.
    P.silver_stage(spark, layout, "2024-03-02")
    P.gold_stage(spark, layout, "2024-03-02")
    P.export_stage(spark, layout)
    assert sorted(tuple(r) for r in spark.table(layout.table(layout.serving)).collect()) == first
    silver = spark.table(layout.table(layout.silver))
    assert silver.filter(F.col(C.EXEC_DAY) == "2024-03-02").count() == silver.filter(
        F.col(C.EXEC_DAY) == "2024-03-02").select(C.CONTRACT, C.SOURCE_FILE).distinct().count()


def test_run_batches_failure_skips_rest_of_batch(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220403", 5)
    st = P.run_batches(spark, layout, src, [("20220499", 5, "2024-03-01"), ("20220403", 5, "2024-03-02")])
    rows = [(r.source_file, r.stage, r.status) for r in st.collect()]
    assert rows[0] == ("20220499", "bronze", "failed")
    assert rows[1:4] == [("20220499", s, "skipped") for s in ("silver", "gold", "export")]
    assert [r[2] for r in rows[4:]] == ["ok"] * 4


def test_changed_source_file_is_refused(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220406", 10)
    P.ingest_batch(spark, layout, src, 4, run_date="2024-02-01")
    # Appended lines: offsets stay valid.
    d = f"{src}/source_file=20220406/part-00000.json"
    with open(d, "a") as f:
        f.write(json.dumps({"_source": {"Contract": "late", "TotalDuration": 1}}) + "\n")
    assert P.ingest_batch(spark, layout, src, 100, run_date="2024-02-02")["rows"] == 7
    # Rewritten shorter: refused.
    _log(src, "20220406", 3)
    with pytest.raises(CP.ChangedSourceError):
        P.ingest_batch(spark, layout, src, 4, run_date="2024-02-03")


def test_malformed_line_goes_to_rejects_and_counts_as_read(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    lines = _log(src, "20220407", 5)
    lines[2] = "{broken"
    with open(f"{src}/source_file=20220407/part-00000.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    info = P.ingest_batch(spark, layout, src, 10, run_date="2024-02-01")
    assert info["rows"] == 5 and info["rejects"] == 1
    rej = spark.table(layout.table(layout.rejects)).collect()
    assert [(r.source_file, r.row_index, r.line) for r in rej] == [("20220407", 2, "{broken")]
    assert spark.table(layout.table(layout.bronze)).count() == 4
    log = CP.latest_checkpoints(spark.table(layout.table(layout.checkpoint))).collect()
    assert log[0].last_offset == 5


def test_flat_layout_one_object_per_day(spark, fresh_dir, layout):
    """The original's layout: <prefix>/<YYYYMMDD>.json, one object per day."""
    src = f"{fresh_dir}/daily"
    os.makedirs(src)
    for day, n in (("20220403", 7), ("20220404", 5)):
        with open(f"{src}/{day}.json", "w") as f:
            for i in range(n):
                f.write(json.dumps({"_source": {"Contract": f"{day}-{i}", "TotalDuration": i}}) + "\n")
    assert P.ingest_batch(spark, layout, src, 4, "2024-02-01", files=["20220403"])["rows"] == 4
    assert P.ingest_batch(spark, layout, src, 100, "2024-02-02")["rows"] == 8  # 3 left + all of the other
    rows = spark.table(layout.table(layout.bronze)).collect()
    assert sorted((r.source_file, r.row_index) for r in rows) == sorted(
        [("20220403", i) for i in range(7)] + [("20220404", i) for i in range(5)])
    assert all(r.Contract.startswith(r.source_file) and r.Contract.endswith(f"-{r.row_index}") for r in rows)


def test_line_index_built_once_and_dropped_when_done(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220408", 10)
    idx = P._index_path(spark, layout)
    man = f"{idx}_manifest"
    P.ingest_batch(spark, layout, src, 3, run_date="2024-02-01")
    P.ingest_batch(spark, layout, src, 3, run_date="2024-02-02")
    builds = spark.read.parquet(man).filter("file_size >= 0").count()
    assert builds == 1  # the second batch read the existing index
    assert os.path.isdir(f"{idx}/source_file=20220408")
    # The file grows: the index is rebuilt, offsets continue.
    with open(f"{src}/source_file=20220408/part-00000.json", "a") as f:
        f.write(json.dumps({"_source": {"Contract": "late"}}) + "\n")
    assert P.ingest_batch(spark, layout, src, 100, run_date="2024-02-03")["rows"] == 5
    assert spark.read.parquet(man).filter("file_size >= 0").count() == 2
    assert not os.path.isdir(f"{idx}/source_file=20220408")  # fully read: index dropped
    assert sorted(r.row_index for r in spark.table(layout.table(layout.bronze)).collect()) == list(range(11))


def test_paths_with_spaces(spark, fresh_dir, layout):
    src = f"{fresh_dir}/raw logs"
    d = f"{src}/{'source_file'}=2022 04 10"
    os.makedirs(d)
    with open(f"{d}/part 0.json", "w") as f:
        for i in range(6):
            f.write(json.dumps({"_source": {"Contract": f"c{i}"}}) + "\n")
    assert P.ingest_batch(spark, layout, src, 4, run_date="2024-02-01")["rows"] == 4
    assert P.ingest_batch(spark, layout, src, 4, run_date="2024-02-02")["rows"] == 2
    rows = spark.table(layout.table(layout.bronze)).collect()
    assert sorted((r.source_file, r.row_index, r.Contract) for r in rows) == [
        ("2022 04 10", i, f"c{i}") for i in range(6)]


def test_default_batch_size_from_last_run(spark, fresh_dir, layout):
    src = f"{fresh_dir}/src"
    _log(src, "20220411", 10)
    assert P.ingest_batch(spark, layout, src, 3, run_date="2024-02-01")["rows"] == 3
    assert P.ingest_batch(spark, layout, src, None, run_date="2024-02-02")["rows"] == 3  # the stored rows_per_run
    _log(src, "20220412", 5)
    info = P.ingest_batch(spark, layout, src, None, run_date="2024-02-03", files=["20220412"])
    assert info["rows"] == 5  # no history: the default size
