"""Gold layer: MostWatch, Taste and the activity segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.features import active_segment, most_watch, taste


def with_features(silver: DataFrame, categories: Sequence[str] = C.CATEGORIES,
                  zero_is_null: bool = False) -> DataFrame:
    """Add ``MostWatch`` and ``Taste``: narrow projections, no shuffle.

    Only the category columns present in the input take part (P10), in the
    given order; the silver layer here always has all five.
    """
    present = set(silver.columns)
    categories = [c for c in categories if c in present]
    if not categories:
        raise ValueError("no category column in the input")
    return silver.withColumn(C.MOST_WATCH, most_watch(categories, zero_is_null)).withColumn(
        C.TASTE, taste(categories)
    )


def active_days(silver: DataFrame, day_col: str = C.EXEC_DAY) -> DataFrame:
    """Distinct days per contract and the High/Low segment.

    A grouped distinct count: partial on (contract, day), then on contract.
    """
    return (
        silver.groupBy(C.CONTRACT)
        .agg(F.count_distinct(day_col).alias(C.ACTIVE_DAYS))
        .withColumn(C.ACTIVE, active_segment(C.ACTIVE_DAYS))
    )


def gold_usage(silver: DataFrame, history: DataFrame | None = None, run_day: str | None = None,
               categories: Sequence[str] = C.CATEGORIES, day_col: str = C.EXEC_DAY,
               zero_is_null: bool = False) -> DataFrame:
    """Gold rows: silver + features + Active.

    ``history`` is the set of silver snapshots Active counts days over.
    Without it, Active counts over the input itself; the input rows of a
    contract are its files (bounded by the file count), and the silver output
    is already partitioned by contract, so a window does what the original's
    aggregate-and-join does without another exchange. With a separate history
    the distinct count is aggregated there and joined on Contract.
    ``run_day`` restamps ``execution_day`` (the original restamps every row).
    """
    feats = with_features(silver, categories, zero_is_null)
    if history is None:
        # The last rank in day order is the number of distinct days (a NULL day counts for none).
        contract = Window.partitionBy(C.CONTRACT)
        rank = F.dense_rank().over(contract.orderBy(F.col(day_col).asc_nulls_last()))
        ranked = feats.filter(F.col(C.CONTRACT).isNotNull()).withColumn(  # as the inner join drops NULL contracts
            "_rank", F.when(F.col(day_col).isNotNull(), rank).otherwise(0)
        )
        out = ranked.withColumn(C.ACTIVE, active_segment(F.max("_rank").over(contract)))
    else:
        active = active_days(history, day_col).select(C.CONTRACT, C.ACTIVE)
        out = feats.join(active, C.CONTRACT, "inner")
    if run_day is not None:
        out = out.withColumn(C.EXEC_DAY, F.lit(run_day))
    return out.select(*feats.columns, C.ACTIVE)
