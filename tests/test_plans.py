"""Plan checks: what the optimizer does with the operators."""

from viewlog.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan, word):
    return plan.count(word)


def test_pivot_launches_no_value_discovery_job(spark):
    from viewlog.operators.silver import usage_pivot
    from viewlog.sources.events_adapter import bronze_from_dir

    b = bronze_from_dir(spark, SF)  # reading the parquet footer may run a job
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    sc.setJobGroup("pivot-plan", "pivot plan only")
    df = usage_pivot(b)  # the pivot itself must not run a value-discovery job
    df.schema
    assert list(tracker.getJobIdsForGroup("pivot-plan")) == []
    sc.setJobGroup("other", "other")


def test_flagship_scans_events_once_and_prunes_columns(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(Q.q_gold_usage(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Totals read five event columns; distinct devices re-read two.
    assert _count(plan, "FileScan parquet") == 2
    schemas = [seg.split("\n")[0] for seg in plan.split("ReadSchema:")[1:]]
    assert all("event_type" not in s for s in schemas)
    assert min(s.count(":") for s in schemas) == 2  # user_id, props
    # (contract, file, day) partials, the contract window, (contract, device)
    # and contract partials for distinct devices: four exchanges; the join
    # of the two contract-partitioned sides adds none.
    assert _count(plan, "Exchange hashpartitioning") == 4
    # Broadcast only when Spark's size estimate is under its threshold (it is
    # for these tiny files); otherwise a sort-merge join on co-partitioned sides.
    assert _count(plan, "SortMergeJoin") + _count(plan, "BroadcastHashJoin") == 1


def test_latest_snapshot_uses_subquery_not_collect(spark):
    plan = Q.q_latest_snapshot(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan


def test_upsert_partition_pruning(spark, fresh_dir):
    from pyspark.sql import functions as F

    from viewlog.sinks import tables

    tables.create_namespace(spark, "plan_t")
    df = spark.createDataFrame([("A", "d1", "f", 1), ("B", "d2", "f", 2)], "Contract string, execution_day string, "
                                                                           "source_file string, v bigint")
    tables.append(spark, "plan_t.serving", df.select("Contract", "source_file", "v", "execution_day"),
                  ["execution_day"], f"{fresh_dir}/serving")
    t = spark.table("plan_t.serving").filter(F.col("execution_day").isin(["d2"]))
    plan = _plan(t)
    assert "PartitionFilters: [isnotnull(execution_day" in plan and "d2" in plan
    upd = spark.createDataFrame([("B", "d2", "f", 20)], "Contract string, execution_day string, source_file string, "
                                                          "v bigint")
    tables.upsert(spark, "plan_t.serving", upd, ["Contract", "execution_day", "source_file"], "execution_day")
    got = sorted(tuple(r) for r in spark.table("plan_t.serving").collect())
    assert got == [("A", "f", 1, "d1"), ("B", "f", 20, "d2")]
