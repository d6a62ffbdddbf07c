"""Property tests: silver/gold against the brute-force model on random rows,
and ingest in k batches equals ingest in one."""

import json
import os
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_silver_gold import model_silver

from fixtures import BRONZE_SCHEMA
from viewlog import constants as C
from viewlog.operators import gold as G
from viewlog.operators import silver as SV
from viewlog.plans import pipeline as P

APPS = [None, "vod", "OTHER", *[c for _, codes in C.CATEGORY_RULES for c in codes]]
row = st.tuples(
    st.sampled_from([None, "0", "A", "B", "C"]),
    st.sampled_from([None, "m1", "m2", "m3"]),
    st.one_of(st.none(), st.integers(min_value=0, max_value=10**9)),
    st.sampled_from(APPS),
    st.sampled_from([("2024-01-01", "20240101"), ("2024-01-02", "20240102"), ("2024-01-03", "20240103")]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=40))
def test_silver_equals_model(spark, rows):
    flat = [(c, m, d, a, day, sf) for c, m, d, a, (day, sf) in rows]
    df = spark.createDataFrame(flat, BRONZE_SCHEMA)
    got = sorted(tuple(r) for r in SV.silver_summary(df).collect())
    assert got == model_silver(flat)
    gold = G.gold_usage(SV.silver_summary(df)).collect()
    assert len(gold) == len(got)
    for r in gold:
        vals = [r[c] for c in C.CATEGORIES]
        assert r.MostWatch == C.CATEGORIES[vals.index(max(vals))]
        assert r.Taste == "-".join(c for c in C.CATEGORIES if r[c] > 0)


def test_ingest_k_batches_equals_one(spark, tmp_path):
    src = str(tmp_path / "src")
    for name, n in (("20240101", 23), ("20240102", 9)):
        d = f"{src}/source_file={name}"
        os.makedirs(d)
        with open(f"{d}/a.json", "w") as f:
            for i in range(n):
                f.write(json.dumps({"_source": {"Contract": f"{name}-{i}", "TotalDuration": i}}) + "\n")

    def run(n):
        lay = P.Layout(database=f"p_{uuid.uuid4().hex[:8]}", root=str(tmp_path / uuid.uuid4().hex[:6]))
        while P.ingest_batch(spark, lay, src, n, run_date="2024-02-01")["rows"]:
            pass
        return sorted(tuple(r) for r in spark.table(lay.table(lay.bronze)).drop(C.EXEC_DATE, C.BATCH_ID).collect())

    assert run(4) == run(1000)
