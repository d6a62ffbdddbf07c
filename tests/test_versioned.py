"""Versioned tables, manifests and the batch ledger: crashes at every step."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from viewlog import constants as C
from viewlog.operators import silver as SV
from viewlog.plans import pipeline as P
from viewlog.plans.ledger import Ledger
from viewlog.sinks import manifest as M
from viewlog.sinks import tables
from viewlog.sinks.versioned import VersionedTable

SCHEMA = "k string, v bigint, day string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "day")
    t.upsert(spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d2"), ("n", 3, None), (None, 4, "d1")], SCHEMA), ["k", "day"])
    return t


def test_upsert_replaces_keys_and_keeps_the_rest(spark, tmp_path):
    t = _table(spark, tmp_path)
    n = t.upsert(spark.createDataFrame([("a", 10, "d1"), (None, 40, "d1"), ("n", 30, None), ("c", 5, "x'y %/z")], SCHEMA), ["k", "day"])
    assert _rows(t.read(n)) == sorted([("a", 10, "d1"), (None, 40, "d1"), ("b", 2, "d2"), ("n", 30, None), ("c", 5, "x'y %/z")], key=repr)
    assert _rows(t.read(1)) == sorted([("a", 1, "d1"), ("b", 2, "d2"), ("n", 3, None), (None, 4, "d1")], key=repr)


def test_only_touched_partitions_are_written_anew(spark, tmp_path):
    t = _table(spark, tmp_path)
    before = t.version().partitions
    t.upsert(spark.createDataFrame([("a", 10, "d1")], SCHEMA), ["k", "day"])
    after = t.version().partitions
    assert before["day=d2"] == after["day=d2"] and before["day=d1"] != after["day=d1"]


@pytest.mark.parametrize("step", ["staged", "joined", "written", "committed"])
def test_a_writer_that_dies_leaves_the_version_before_whole(spark, tmp_path, monkeypatch, step):
    t = _table(spark, tmp_path)
    t.register(name := f"v_{uuid.uuid4().hex[:8]}")
    old = _rows(t.read())
    updates = spark.createDataFrame([("a", 10, "d1"), ("z", 9, "d9")], SCHEMA)
    new = sorted([r for r in old if r[0] != "a"] + [("a", 10, "d1"), ("z", 9, "d9")], key=repr)

    def boom(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "staged":
            m.setattr(VersionedTable, "version", boom)
        elif step == "joined":
            m.setattr(VersionedTable, "_touched", boom)
        elif step == "written":
            m.setattr(M, "commit", boom)
        else:
            m.setattr(VersionedTable, "vacuum", boom)
        with pytest.raises(RuntimeError):
            t.upsert(updates, ["k", "day"])
    committed = step == "committed"
    assert _rows(t.read()) == (new if committed else old)
    assert _rows(spark.table(name)) == old  # the catalog still shows the version it was given
    t.upsert(updates, ["k", "day"])
    t.register(name)
    assert _rows(t.read()) == _rows(spark.table(name)) == new
    assert not [f for f in os.listdir(tmp_path / "t") if f.startswith("_stage-")]


def test_a_pinned_reader_keeps_its_version(spark, tmp_path):
    t = _table(spark, tmp_path)
    pinned = t.read()
    want = _rows(pinned)
    for v in range(3):
        t.upsert(spark.createDataFrame([("a", v, "d1"), ("b", v, "d2")], SCHEMA), ["k", "day"])
    assert _rows(pinned) == want
    t.vacuum(keep=1)
    assert M.versions(spark, t.root) == [4]
    assert _rows(t.read()) == sorted([("a", 2, "d1"), ("b", 2, "d2"), ("n", 3, None), (None, 4, "d1")], key=repr)


def test_two_writers_cannot_commit_one_version(spark, tmp_path):
    M.commit(spark, str(tmp_path), 1, {"x": "é"})
    with pytest.raises(M.VersionTaken):
        M.commit(spark, str(tmp_path), 1, {"x": 2})
    assert M.load(spark, str(tmp_path)) == (1, {"x": "é"})


def test_opening_a_version_runs_no_job(spark, tmp_path):
    t = _table(spark, tmp_path)
    spark.sparkContext.setJobGroup(group := uuid.uuid4().hex, "open")
    try:
        t.read().schema  # noqa: B018
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plain_partitions_are_adopted(spark, tmp_path):
    rows = [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("day").parquet(str(tmp_path / "t"))
    t = VersionedTable(spark, str(tmp_path / "t"), "day")
    assert _rows(t.read()) == rows
    t.upsert(spark.createDataFrame([("b", 7, "2024-01-02")], SCHEMA), ["k", "day"])
    assert _rows(t.read()) == [("a", 1, "2024-01-01"), ("b", 7, "2024-01-02")]


def test_columns_evolve_and_nothing_is_cut(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.upsert(spark.createDataFrame([("a", 0.5, "d1", True)], "k string, v double, day string, extra boolean"), ["k", "day"])
    got = {r["k"]: (r["v"], r["v_double"], r["extra"]) for r in t.read().collect()}
    assert got["a"] == (None, 0.5, True) and got["b"] == (2, None, None)


# --- the ledger ----------------------------------------------------------------


def _log(root, name, n):
    os.makedirs(f"{root}/source_file={name}", exist_ok=True)
    with open(f"{root}/source_file={name}/log.json", "a") as f:
        for i in range(n):
            f.write(json.dumps({"_source": {"Contract": f"c{i % 3}", "Mac": f"m{i % 4}", "TotalDuration": i, "AppName": "VOD"}}) + "\n")


def _silver(spark, lay, day):
    return _rows(spark.table(lay.table(lay.silver)).where(F.col(C.EXEC_DAY) == day).drop(C.EXEC_DAY))


def _full(spark, lay, day):
    return _rows(SV.silver_summary(spark.table(lay.table(lay.bronze)), run_day=day).select(
        C.CONTRACT, *C.PIVOT_COLUMNS, C.TOTAL_DEVICES, C.DISTINCT_DEVICES, C.SOURCE_FILE))


@pytest.fixture()
def lay(tmp_path):
    return P.Layout(database=f"l_{uuid.uuid4().hex[:8]}", root=str(tmp_path / "tables"))


def test_a_half_written_batch_is_folded_once_and_whole(spark, tmp_path, lay, monkeypatch):
    src = str(tmp_path / "src")
    _log(src, "f1", 8)
    P.ingest_batch(spark, lay, src, 4, run_date="d1")
    P.silver_stage(spark, lay, "d1", incremental=True)
    first = _silver(spark, lay, "d1")
    real = tables.overwrite_partitions

    def boom(spark_, table, df, *a, **k):
        real(spark_, table, df.where(F.col(C.ROW_INDEX) >= 6), *a, **k)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "overwrite_partitions", boom)
        with pytest.raises(RuntimeError):
            P.ingest_batch(spark, lay, src, 4, run_date="d2")
    assert spark.table(lay.table(lay.bronze)).count() == 6
    P.silver_stage(spark, lay, "d2", incremental=True)
    assert _silver(spark, lay, "d2") == first  # the dead half counts for nothing yet
    P.ingest_batch(spark, lay, src, 4, run_date="d3")
    P.silver_stage(spark, lay, "d3", incremental=True)
    assert spark.table(lay.table(lay.bronze)).count() == 8
    assert _silver(spark, lay, "d3") == _full(spark, lay, "d3")


@pytest.mark.parametrize("what", ["files", "devices", "batches", "commit"])
def test_a_fold_that_dies_is_folded_again(spark, tmp_path, lay, monkeypatch, what):
    src = str(tmp_path / "src")
    _log(src, "f1", 9)
    P.ingest_batch(spark, lay, src, 5, run_date="d1")
    P.silver_stage(spark, lay, "d1", incremental=True)
    P.ingest_batch(spark, lay, src, 5, run_date="d2")
    real = Ledger._write

    def write(self, df, run, name):
        if name == what:
            raise RuntimeError("lost")
        real(self, df, run, name)

    def commit(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(*((M, "commit", commit) if what == "commit" else (Ledger, "_write", write)))
        with pytest.raises(RuntimeError):
            P.silver_stage(spark, lay, "d2", incremental=True)
    P.silver_stage(spark, lay, "d2", incremental=True)
    assert _silver(spark, lay, "d2") == _full(spark, lay, "d2")


def test_runs_are_merged_and_a_fold_reads_new_batches_only(spark, tmp_path, lay, monkeypatch):
    from viewlog.plans import ledger as L

    monkeypatch.setattr(L, "MAX_RUNS", 3)
    src = str(tmp_path / "src")
    _log(src, "f1", 20)
    for k in range(5):
        P.ingest_batch(spark, lay, src, 4, run_date=f"d{k}")
        P.silver_stage(spark, lay, f"d{k}", incremental=True)
        assert _silver(spark, lay, f"d{k}") == _full(spark, lay, f"d{k}")
    ledger = Ledger(spark, lay.folder(spark, lay.silver + "_state"))
    assert len(ledger.state()[1]) < 3
    assert ledger.unfolded(P.committed_batches(spark, lay)) == []
    assert ledger.fold(spark.table(lay.table(lay.bronze)), P.committed_batches(spark, lay)) == 0
    kept = [d for d in os.listdir(ledger.root) if d.startswith("run-")]
    assert len(kept) <= 4  # those of the last two versions


# --- siblings ------------------------------------------------------------------


def _create(spark, tmp_path, schema):
    t = f"e_{uuid.uuid4().hex[:8]}"
    tables.create_table(spark, t, spark.createDataFrame([], schema).schema, (), str(tmp_path / "e"))
    return t


def test_a_sibling_that_exists_is_never_cast_into(spark, tmp_path):
    t = _create(spark, tmp_path, "a bigint, a_double bigint")
    tables.append(spark, t, spark.createDataFrame([(0.75,)], "a double"))
    tables.append(spark, t, spark.createDataFrame([(0.25, 7)], "a double, a_double bigint"))
    assert spark.table(t).columns == ["a", "a_double", "a_double_2"]
    assert _rows(spark.table(t)) == sorted([(None, None, 0.75), (None, 7, 0.25)], key=repr)


def test_a_key_called_like_the_sibling_does_not_clash(spark, tmp_path):
    t = _create(spark, tmp_path, "a bigint")
    for _ in range(2):
        tables.append(spark, t, spark.createDataFrame([(0.75, 3)], "a double, a_double bigint"))
    assert _rows(spark.table(t).select("a", "a_double", "a_double_2")) == [(None, 3, 0.75)] * 2
    # A key with the name of a sibling made for another one gets a column of its own.
    tables.append(spark, t, spark.createDataFrame([(5.5,)], "a_double_2 double"))
    assert spark.table(t).where("a_double_2 = 5.5").count() == 0


# --- the schema register ---------------------------------------------------------


def test_a_new_process_reads_the_register_and_no_file(spark, tmp_path, lay, monkeypatch):
    from pyspark.sql.readwriter import DataFrameReader

    src = str(tmp_path / "src")
    _log(src, "f1", 4)
    P.ingest_batch(spark, lay, src, None, run_date="d1")
    with open(f"{src}/source_file=f1/more.json", "w") as f:
        f.write(json.dumps({"_source": {"Contract": "n", "extra": 1, "a": {"b": 2}, "a_b": "x"}}) + "\n")
    P.ingest_batch(spark, lay, src, None, run_date="d2")

    def boom(*a, **k):
        raise AssertionError("a file was opened for its schema")

    again = P.Layout(database=f"l_{uuid.uuid4().hex[:8]}", root=lay.root)
    with monkeypatch.context() as m:
        m.setattr(DataFrameReader, "parquet", boom)
        P.attach(spark, again)
    b = spark.table(again.table(again.bronze))
    assert b.count() == 5 and b.schema.fieldNames() == spark.table(lay.table(lay.bronze)).schema.fieldNames()
    register = M.load(spark, lay.location(lay.bronze), folder=tables.SCHEMA_FOLDER)[1]["columns"]
    keys = {c["name"]: c["key"] for c in register}
    assert keys["extra"] == "extra" and {keys["a_b"], keys["a_b_2"]} == {"a_b", '["a", "b"]'}
    # The nested key alone still goes to its own column, through the new process too.
    with open(f"{src}/source_file=f1/n.json", "w") as f:
        f.write(json.dumps({"_source": {"Contract": "late", "a": {"b": 5}}}) + "\n")
    P.ingest_batch(spark, again, src, None, run_date="d3")
    row = spark.table(again.table(again.bronze)).where("Contract = 'late'").first().asDict()
    nested = next(n for n, k in keys.items() if k.startswith("["))
    assert row[nested] == 5 and row[next(n for n in ("a_b", "a_b_2") if n != nested)] is None


def test_two_writers_lose_no_column_of_the_register(spark, tmp_path):
    t = _create(spark, tmp_path, "a bigint")
    location = str(tmp_path / "e")
    content = M.load(spark, location, folder=tables.SCHEMA_FOLDER)
    other = [*content[1]["columns"], {"name": "z", "key": "z", "type": "string", "comment": None}]
    M.commit(spark, location, content[0] + 1, {"columns": other}, folder=tables.SCHEMA_FOLDER)
    tables.append(spark, t, spark.createDataFrame([(1, 2)], "a bigint, b bigint"))
    assert {f.name for f in tables.registered_schema(spark, location).fields} == {"a", "b", "z"}


# --- lookups -----------------------------------------------------------------------


def test_a_keyed_read_skips_files_and_row_groups(spark, tmp_path, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    from viewlog.sinks import versioned as V

    monkeypatch.setattr(V, "ROW_GROUP_BYTES", 64 << 10)
    t = VersionedTable(spark, str(tmp_path / "t"), "day", lookup="k")
    rows = spark.range(200_000).select(F.concat(F.lit("key-"), F.sha1(F.col("id").cast("string"))).alias("k"), F.col("id").alias("v"), F.lit("d1").alias("day"))
    t.upsert(rows, ["k", "day"])
    key = rows.where("v = 777").first()["k"]
    found = t.read().where(F.col("k") == key)
    assert [r["v"] for r in found.collect()] == [777]
    plan = found._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    read = scan.metrics().get("numOutputRows").get().value()
    assert read < 60_000  # of 200,000: the other files and row groups were skipped
    files = glob.glob(f"{tmp_path}/t/_write=*/day=d1/*.parquet")
    meta = [pq.ParquetFile(f).metadata for f in files]
    assert len(files) > 1 and sum(m.num_row_groups for m in meta) > len(files)


def test_updates_of_new_partitions_are_written_once(spark, tmp_path, monkeypatch):
    """Rows of partitions that the table lacks are not staged; those of others are merged, the rest kept."""
    from pyspark.sql import DataFrameWriter

    t = _table(spark, tmp_path)
    seen, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **k: (seen.append(path), real(w, path, *a, **k))[1])
    before = _rows(t.read())
    t.upsert(spark.createDataFrame([("a", 1, "d7"), ("a", 2, "d8")], SCHEMA), ["k", "day"])
    assert len(seen) == 1 and "/_write=" in seen[0]
    assert _rows(t.read()) == sorted([*before, ("a", 1, "d7"), ("a", 2, "d8")], key=repr)
    t.upsert(spark.createDataFrame([("a", 5, "d7"), ("b", 6, "d7"), ("c", 7, "d9")], SCHEMA), ["k", "day"])
    assert _rows(t.read()) == sorted([*before, ("a", 5, "d7"), ("b", 6, "d7"), ("a", 2, "d8"), ("c", 7, "d9")], key=repr)


def test_snapshot_spreads_the_file_sums_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "s"))
    cols = f"{C.CONTRACT} string, {C.MAC} string, {C.DURATION} bigint, {C.APP} string, {C.SOURCE_FILE} string, {C.BATCH_ID} string"
    rows = [("A", "m1", 5, "VOD", "f1", "b1"), ("A", "m2", 7, "VOD", "f1", "b2"), ("A", "m1", 1, "SPORT", "f2", "b2"), ("B", "m3", 2, "BHD", "f2", "b2")]
    bronze = spark.createDataFrame(rows, cols)
    for b in ("b1", "b2"):
        ledger.fold(bronze, spark.createDataFrame([(b,)], f"{C.BATCH_ID} string"))
    assert len(ledger.state()[1]) == 2
    got = ledger.snapshot("2024-01-01")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") <= 2, plan
    want = SV.silver_summary(bronze, run_day="2024-01-01").select(*got.columns)
    assert _rows(got) == _rows(want)
