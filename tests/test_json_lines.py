import json
import os

import pytest
from pyspark.sql import functions as F

from viewlog import constants as C
from viewlog.sources import json_lines as J


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_row_index_many_splits_and_blank_lines(spark, fresh_dir, small_splits):
    expect = {}
    for name in ("a", "b"):
        lines, idx = [], 0
        for i in range(400):
            if i % 7 == 3:
                lines.append("   " if i % 2 else "")
                continue
            rec = {"_source": {"Contract": f"{name}{i}", "TotalDuration": i}}
            lines.append(json.dumps(rec))
            expect[(name, f"{name}{i}")] = idx
            idx += 1
        _write(f"{fresh_dir}/{name}.json", lines)
    df = J.indexed_lines(spark, fresh_dir)
    assert df.rdd.getNumPartitions() > 4
    recs = J.flatten(J.parse_records(df, J.discover_source_schema(spark, df)))
    got = {}
    for r in recs.select("Contract", C.ROW_INDEX).collect():
        got[(r.Contract[0], r.Contract)] = r[C.ROW_INDEX]
    assert got == expect


def test_row_index_per_partition_value(spark, fresh_dir, small_splits):
    lines_by_file = {"20240101": 50, "20240102": 30}
    for sf, n in lines_by_file.items():
        for part in range(3):
            recs = [json.dumps({"_source": {"Contract": f"{sf}-{part}-{i}"}}) for i in range(n)]
            _write(f"{fresh_dir}/source_file={sf}/part-{part:05d}.json", recs)
    df = J.indexed_lines(spark, fresh_dir, base_path=fresh_dir, file_col=C.SOURCE_FILE)
    rows = df.select(C.SOURCE_FILE, C.ROW_INDEX, F.get_json_object("value", "$._source.Contract").alias("c")).collect()
    for r in rows:
        sf, part, i = r.c.split("-")
        assert r[C.SOURCE_FILE] == sf
        assert r[C.ROW_INDEX] == int(part) * lines_by_file[sf] + int(i)


def test_slice_past_eof_and_empty(spark, fresh_dir):
    _write(f"{fresh_dir}/x.json", [json.dumps({"_source": {"Contract": str(i)}}) for i in range(5)])
    df = J.indexed_lines(spark, fresh_dir)
    assert J.slice_rows(df, 3, 10).count() == 2
    assert J.slice_rows(df, 10, 10).count() == 0


def test_malformed_missing_extra_nested(spark, fresh_dir):
    lines = [
        json.dumps({"_source": {"Contract": "A", "Mac": "m", "TotalDuration": 5, "AppName": "VOD"}}),
        "{not json",
        json.dumps({"other": 1}),
        json.dumps({"_source": {"Contract": "B", "Extra": "x", "Deep": {"k": 2, "v": {"w": 1.5}}}}),
    ]
    _write(f"{fresh_dir}/f.json", lines)
    df = J.indexed_lines(spark, fresh_dir)
    schema = J.discover_source_schema(spark, df)
    names = [f.name for f in schema.fields]
    assert names[:4] == ["Contract", "Mac", "TotalDuration", "AppName"]
    assert {"Extra", "Deep"} <= set(names)
    parsed = J.parse_records(df, schema)
    bad = parsed.filter(F.col(J.CORRUPT).isNotNull()).collect()
    assert len(bad) == 1 and bad[0][C.ROW_INDEX] == 1
    flat = J.flatten(parsed.filter(F.col(J.CORRUPT).isNull()).drop(J.CORRUPT))
    assert {"Deep_k", "Deep_v_w", "Extra"} <= set(flat.columns)
    rows = {r[C.ROW_INDEX]: r for r in flat.collect()}
    assert rows[2].Contract is None  # no _source: NULL payload
    assert rows[3].Deep_k == 2 and rows[3].Deep_v_w == 1.5 and rows[3].Extra == "x"
    assert rows[0].TotalDuration == 5


def test_empty_file(spark, fresh_dir):
    _write(f"{fresh_dir}/e.json", [""])
    df = J.indexed_lines(spark, fresh_dir)
    assert df.count() == 0
