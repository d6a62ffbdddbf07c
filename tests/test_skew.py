"""A hot contract holding a third of all rows."""

import re

from pyspark.sql import functions as F
from test_silver_gold import model_silver

from viewlog import constants as C
from viewlog.operators import gold as G
from viewlog.operators import silver as SV
from viewlog.sources.events_adapter import events_as_bronze, read_events

SF = "/root/testdata/sf0.001"


def hot_bronze(spark):
    b = events_as_bronze(read_events(spark, SF), keep_event_id=True)
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(C.NULL_BUCKET_CONTRACT)).otherwise(F.col(C.CONTRACT))
    return b.withColumn(C.CONTRACT, hot).drop("event_id")


def test_hot_contract_results(spark):
    b = hot_bronze(spark)
    rows = [tuple(r) for r in b.collect()]
    assert sum(1 for r in rows if r[0] == C.NULL_BUCKET_CONTRACT) >= len(rows) // 3
    got = sorted(tuple(r) for r in SV.silver_summary(b).collect())
    assert got == model_silver(rows)
    gold = G.gold_usage(SV.silver_summary(b)).filter(F.col(C.CONTRACT) == C.NULL_BUCKET_CONTRACT).collect()
    assert len({r.source_file for r in gold}) == len(gold) == 30  # one row per file of the hot contract
    assert all(r.Active == "High" for r in gold)


def test_every_exchange_sits_on_an_aggregate(spark):
    """Raw rows never cross a shuffle: each exchange's input is a (partial)
    hash aggregate, so a hot key is combined map-side first."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = G.gold_usage(SV.silver_summary(hot_bronze(spark)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [ln for ln in plan.splitlines() if ln.strip()]
    exchanges = 0
    for i, ln in enumerate(lines):
        if re.search(r"Exchange hashpartitioning", ln):
            exchanges += 1
            child = lines[i + 1]
            assert "HashAggregate" in child, (ln, child)
    assert exchanges == 4
