from pyspark.sql import types as T

from viewlog import constants as C
from viewlog import schemas
from viewlog.operators import serving as S
from viewlog.operators import views as V

KEY = list(C.SERVING_KEY)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "Contract string, execution_day string, source_file string, v bigint, s string")


def test_align_pads_orders_and_fills(spark):
    df = spark.createDataFrame([("A", None, "x", 5)], "Contract string, Error bigint, extra string, TotalDevices int")
    target = T.StructType([
        T.StructField("TotalDevices", T.LongType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("Error", T.LongType()),
        T.StructField("Note", T.StringType()),
        T.StructField("Score", T.LongType()),
    ])
    out = S.align_to_target(df, target)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in target]
    assert tuple(out.first()) == (5, "A", 0, None, 0)


def test_dedup_deterministic(spark):
    df = _rows(spark, [("A", "d", "f", 1, "x"), ("A", "d", "f", 3, "a"), ("A", "d", "f", 3, "b"), ("B", "d", "f", 2, None)])
    got = sorted(tuple(r) for r in S.dedup_on_key(df, KEY).collect())
    assert got == [("A", "d", "f", 3, "b"), ("B", "d", "f", 2, None)]
    got2 = sorted(tuple(r) for r in S.dedup_on_key(df, KEY, prefer=["s"]).collect())
    assert got2[0] == ("A", "d", "f", 1, "x")


def test_upsert_replaces_keeps_inserts_and_is_idempotent(spark):
    target = _rows(spark, [("A", "d1", "f", 1, "old"), ("B", "d1", "f", 2, "keep")])
    upd = _rows(spark, [("A", "d1", "f", 10, "new"), ("C", "d1", "f", 3, "ins")])
    once = S.upsert(target, upd, KEY)
    twice = S.upsert(once, upd, KEY)
    want = [("A", "d1", "f", 10, "new"), ("B", "d1", "f", 2, "keep"), ("C", "d1", "f", 3, "ins")]
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in twice.collect()) == want


def test_latest_snapshot_and_empty(spark):
    df = _rows(spark, [("A", "2024-01-01", "f", 1, None), ("A", "2024-01-03", "f", 2, None)])
    assert [r.v for r in S.latest_snapshot(df).collect()] == [2]
    assert S.latest_snapshot(df.limit(0)).count() == 0


def test_views_drop_null_bucket_and_do_not_double_count(spark):
    rows = []
    for sf in ("f1", "f2"):  # fan-out: the same totals on two files
        rows.append(("A", "2024-01-01", sf, 0, 10, 0, 0, 0, 5, 3, 1, "Truyen_Hinh", "High"))
    rows.append(("0", "2024-01-01", "f1", 0, 1000, 0, 0, 0, 0, 99, 9, "Phim_Truyen", "Low"))
    cols = ("Contract string, execution_day string, source_file string, Error bigint, Giai_Tri bigint, "
            "Phim_Truyen bigint, The_Thao bigint, Thieu_Nhi bigint, Truyen_Hinh bigint, TotalDevices bigint, "
            "DistinctDevices bigint, MostWatch string, Active string")
    df = spark.createDataFrame(rows, cols)
    kpi = V.v_kpi(df).first()
    assert (kpi.contracts, kpi.total_duration, kpi.total_devices) == (1, 15, 3)
    content = {r.category: r for r in V.v_content(df).collect()}
    assert content["Giai_Tri"].duration == 10 and abs(content["Giai_Tri"].share - 10 / 15) < 1e-12
    seg = V.v_segment(df).collect()
    assert [(r.Active, r.MostWatch, r.contracts) for r in seg] == [("High", "Truyen_Hinh", 1)]
    top = V.v_top(df, 5).collect()
    assert [(r.rank, r.Contract) for r in top] == [(1, "A")]


def test_serving_schema_has_key():
    names = [f.name for f in schemas.SERVING.fields]
    assert names[:3] == KEY


def test_merge_sql_forms():
    from viewlog.sinks.jdbc import merge_sql

    cols = ["Contract", "execution_day", "Odd \"name"]
    ansi = merge_sql("t", "s", cols, cols[:2])
    assert 't."Contract" IS NOT DISTINCT FROM s."Contract"' in ansi and 'SET "Odd ""name" = s."Odd ""name"' in ansi
    my = merge_sql("t", "s", cols, cols[:2], dialect="mysql")
    assert "ON DUPLICATE KEY UPDATE `Odd \"name` = new.`Odd \"name`" in my and ") AS new " in my


def test_upsert_keeps_rows_of_the_null_partition(spark, fresh_dir):
    from viewlog.sinks import tables

    name = f"nullpart_{abs(hash(fresh_dir))}"
    tables.append(spark, name, spark.createDataFrame([("A", 1, None), ("C", 1, "d")], "k string, v int, p string"), ["p"], f"{fresh_dir}/t")
    tables.upsert(spark, name, spark.createDataFrame([("B", 2, None)], "k string, v int, p string"), ["k", "p"], "p")
    tables.upsert(spark, name, spark.createDataFrame([("B", 3, None)], "k string, v int, p string"), ["k", "p"], "p", [None])
    assert sorted(tuple(r)[:2] for r in spark.table(name).collect()) == [("A", 1), ("B", 3), ("C", 1)]


def test_scale_conf_bounds():
    from viewlog.session import scale_conf

    big = scale_conf(100 * 10**12, 8000)  # 10 TB of partials / 200 MiB
    assert int(big["spark.sql.shuffle.partitions"]) == 10**13 // (200 << 20)
    assert int(scale_conf(10**15, 8000)["spark.sql.shuffle.partitions"]) > 50_000
    assert int(scale_conf(10**15, 8000, max_partitions=9_000)["spark.sql.shuffle.partitions"]) == 9_000
    small = scale_conf(10**9, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    mid = scale_conf(10 * 10**12, 4000)
    assert 4000 < int(mid["spark.sql.shuffle.partitions"]) < 50_000


def test_table_upsert_without_partitions(spark, tmp_path):
    from viewlog.sinks import tables

    tables.create_namespace(spark, "ups_np")
    t = "ups_np.target"
    base = spark.createDataFrame([("A", "d", "f", 1, "old"), ("B", "d", "f", 2, "keep")],
                                 "Contract string, execution_day string, source_file string, v bigint, s string")
    tables.append(spark, t, base, [], str(tmp_path / "t"))
    upd = spark.createDataFrame([("A", "d", "f", 10, "new"), ("C", "d", "f", 3, "ins")],
                                "Contract string, execution_day string, source_file string, v bigint, s string")
    tables.upsert(spark, t, upd, KEY)
    tables.upsert(spark, t, upd, KEY)
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == [("A", "d", "f", 10, "new"), ("B", "d", "f", 2, "keep"), ("C", "d", "f", 3, "ins")]


def test_preview_partitions_and_drop(spark, tmp_path):
    from viewlog.sinks import tables

    tables.create_namespace(spark, "small_ops")
    df = spark.createDataFrame([(i, f"d{i % 3}") for i in range(20)], "v bigint, execution_day string")
    tables.append(spark, "small_ops.t", df, ["execution_day"], str(tmp_path / "t"))
    assert tables.preview(spark.table("small_ops.t")).count() == 5
    assert tables.partition_columns(spark, "small_ops.t") == ["execution_day"]
    assert tables.latest_partition(spark, "small_ops.t", "execution_day") == "d2"
    tables.drop_table(spark, "small_ops.t")
    assert not tables.table_exists(spark, "small_ops.t")


def test_upsert_null_key_part_is_replaced(spark):
    target = _rows(spark, [("A", "d1", None, 1, "old"), ("A", "d1", "f", 2, "keep")])
    upd = _rows(spark, [("A", "d1", None, 10, "new")])
    got = sorted((tuple(r) for r in S.upsert(target, upd, KEY).collect()), key=repr)
    assert got == sorted([("A", "d1", None, 10, "new"), ("A", "d1", "f", 2, "keep")], key=repr)


def test_export_to_a_relational_table_uses_its_own_columns(spark, fresh_dir, monkeypatch):
    """Without a database: the metadata probe and the connection's statements are stood in for."""
    import uuid

    from pyspark.sql import types as T

    from viewlog import __main__ as cli
    from viewlog.plans import pipeline as P
    from viewlog.sinks import jdbc

    layout = P.Layout(database=f"j_{uuid.uuid4().hex[:8]}", root=f"{fresh_dir}/tables")
    gold = spark.createDataFrame([("A", 5, "f1", "d1", "x"), ("A", 5, "f1", "d1", "x"), ("B", None, "f1", "d1", "y")],
                                 "Contract string, VOD bigint, source_file string, execution_day string, Extra string")
    from viewlog.sinks import tables
    tables.create_namespace(spark, layout.database, layout.location("_db"))
    tables.append(spark, layout.table(layout.gold), gold, ["execution_day"], layout.location(layout.gold))
    target = T.StructType([T.StructField("Contract", T.StringType()), T.StructField("execution_day", T.StringType()),
                           T.StructField("source_file", T.StringType()), T.StructField("VOD", T.LongType()), T.StructField("Score", T.LongType())])
    staged, ran = {}, []
    monkeypatch.setattr(jdbc.JdbcTarget, "schema", lambda self, spark: target)
    monkeypatch.setattr(jdbc, "write_staging", lambda df, url, table, props, *a: staged.update({table: df.collect()}))
    monkeypatch.setattr(jdbc, "execute", lambda spark, url, statements, props: ran.append((url, statements, props)))
    a = cli.argparse.Namespace(jdbc_url="jdbc:x:y", jdbc_table="t", jdbc_prop=["user=u", "password=a=b"], jdbc_dialect="mysql")
    assert P.export_stage(spark, layout, jdbc=cli._target(a)) == "d1"
    assert sorted(tuple(r) for r in staged["t_staging"]) == [("A", "d1", "f1", 5, 0), ("B", "d1", "f1", 0, 0)]
    (url, merge, props), (_, drop, _) = ran
    assert (url, props) == ("jdbc:x:y", {"user": "u", "password": "a=b"}) and drop == ["DROP TABLE IF EXISTS t_staging"]
    assert merge[0].startswith("INSERT INTO t (`Contract`, `execution_day`, `source_file`, `VOD`, `Score`) SELECT")
    assert not tables.table_exists(spark, layout.table(layout.serving))
