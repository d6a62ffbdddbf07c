"""Serving views (D11) over the serving table, after the null-bucket filter.

Only the view names exist in the original; the definitions are ours:

* ``v_kpi``      per day: contracts, total watch time (all six columns), devices
* ``v_content``  per day and category: watch time and its share of the day
* ``v_segment``  per day, Active and MostWatch: contracts
* ``v_top``      the top-N contracts by watch time on the latest day

Each serving row repeats its contract's totals once per source file (the
silver fan-out), so every view first reduces to one row per
(Contract, execution_day); summing raw rows would double-count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .serving import latest_day

TOTAL = "total_duration"


def drop_null_bucket(df: DataFrame) -> DataFrame:
    """Remove the anomalous ``Contract = '0'`` bucket (P11). NULL contracts go too."""
    return df.filter(F.col(C.CONTRACT) != F.lit(C.NULL_BUCKET_CONTRACT))


def contract_days(serving: DataFrame) -> DataFrame:
    """One row per (Contract, execution_day), totals undoubled.

    All fan-out rows of a contract and day carry the same totals, so ``max``
    returns that value; partial aggregation keeps a hot contract cheap.
    """
    base = drop_null_bucket(serving)
    nums = [*C.PIVOT_COLUMNS, C.TOTAL_DEVICES]
    # Numbers only: text in an aggregate would force a sort, and 'Low' would beat 'High'.
    names = F.array(*[F.lit(c) for c in C.CATEGORIES])
    days = base.groupBy(C.CONTRACT, C.EXEC_DAY).agg(
        *[F.max(c).alias(c) for c in nums],
        F.max((F.col(C.ACTIVE) == F.lit("High")).cast("int")).alias("_high"),
        F.max(F.array_position(names, F.col(C.MOST_WATCH))).alias("_most"),
    )
    total = sum((F.col(c) for c in C.PIVOT_COLUMNS[1:]), F.col(C.PIVOT_COLUMNS[0]))
    active = F.when(F.col("_high") == 1, F.lit("High")).when(F.col("_high") == 0, F.lit("Low"))
    return days.withColumns({C.MOST_WATCH: F.get(names, (F.col("_most") - 1).cast("int")), C.ACTIVE: active, TOTAL: total}).drop("_high", "_most")


def v_kpi(serving: DataFrame) -> DataFrame:
    cd = contract_days(serving)
    return cd.groupBy(C.EXEC_DAY).agg(
        F.count(F.lit(1)).alias("contracts"),
        F.sum(TOTAL).alias(TOTAL),
        F.sum(C.TOTAL_DEVICES).alias("total_devices"),
    )


def v_content(serving: DataFrame) -> DataFrame:
    cd = contract_days(serving)
    per_day = cd.groupBy(C.EXEC_DAY).agg(*[F.sum(c).alias(c) for c in C.CATEGORIES])
    day_total = sum((F.col(c) for c in C.CATEGORIES[1:]), F.col(C.CATEGORIES[0]))
    # The day's total goes along as an id column of the unpivot.
    with_total = per_day.withColumn("_day_total", day_total)
    return with_total.unpivot([C.EXEC_DAY, "_day_total"], list(C.CATEGORIES), "category", "duration").select(
        C.EXEC_DAY,
        "category",
        "duration",
        F.try_divide(F.col("duration").cast("double"), F.col("_day_total").cast("double")).alias("share"),
    )


def v_segment(serving: DataFrame) -> DataFrame:
    cd = contract_days(serving)
    return cd.groupBy(C.EXEC_DAY, C.ACTIVE, C.MOST_WATCH).agg(F.count(F.lit(1)).alias("contracts"))


def v_top(serving: DataFrame, n: int = 10, day: Column | None = None) -> DataFrame:
    """Top ``n`` contracts by watch time on the latest day, ties by Contract.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: a per-partition
    top-n then a merge of n rows per partition. The rank is numbered on those
    n rows only. ``day`` may supply the latest day (see
    ``serving.latest_snapshot``).
    """
    cd = contract_days(serving)
    last = cd.filter(F.col(C.EXEC_DAY) == (day if day is not None else latest_day(cd)))
    top = last.orderBy(F.col(TOTAL).desc(), F.col(C.CONTRACT).asc()).limit(n)
    w = Window.orderBy(F.col(TOTAL).desc(), F.col(C.CONTRACT).asc())
    return top.select(
        F.row_number().over(w).alias("rank"), C.CONTRACT, C.EXEC_DAY, TOTAL, C.MOST_WATCH, C.ACTIVE
    )


def register_views(spark, serving: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Register the four views as temp views; returns them by name."""
    views = {
        "v_kpi": v_kpi(serving),
        "v_content": v_content(serving),
        "v_segment": v_segment(serving),
        "v_top": v_top(serving),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views
