"""Serving: latest snapshot, alignment to the target layout, dedup, upsert.

(A5, P8, P7, P3, P2, K8, J4; Q11, Q12.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C


def latest_day(df: DataFrame, day_col: str = C.EXEC_DAY) -> Column:
    """``max(day)`` as a scalar-subquery column (A5; NULL on an empty input).

    Used in a filter on a partition column, Spark evaluates the subquery
    before the scan and prunes partitions at run time; nothing is collected by
    the caller.
    """
    return df.agg(F.max(day_col)).scalar()


def latest_snapshot(df: DataFrame, day_col: str = C.EXEC_DAY, day: Column | None = None) -> DataFrame:
    """Rows of the most recent day only.

    ``day`` may supply the latest day from a cheaper relation that
    determines it (a partition list, or the upstream table whose days the
    input carries); by default it is ``max(day_col)`` of the input itself.
    """
    return df.filter(F.col(day_col) == (day if day is not None else latest_day(df, day_col)))


def _default_for(dt: T.DataType) -> Column:
    if isinstance(dt, T.NumericType):
        return F.lit(0).cast(dt)
    return F.lit(None).cast(dt)


def align_to_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """Shape ``df`` like the target table.

    Numeric NULLs become 0; a target column the input lacks is padded with 0
    when numeric and NULL otherwise (the original pads strings with 0 too,
    Q12); extra input columns are dropped; order and types follow the target.
    One ``select``, so it stays a single projection in the plan.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in target.fields:
        if f.name in have:
            c = F.col(f.name)
            if isinstance(have[f.name], T.NumericType):
                c = F.coalesce(c, F.lit(0).cast(have[f.name]))
            if have[f.name] != f.dataType:
                c = c.cast(f.dataType)
        else:
            c = _default_for(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def dedup_on_key(df: DataFrame, keys: Sequence[str] = C.SERVING_KEY,
                 prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key, picked deterministically (Q11).

    The winner is the row with the largest (``prefer`` columns, then every
    other column) in struct order. Written as a grouped ``max`` over a struct,
    which aggregates partially on the map side, so a key with very many rows
    never lands in a single task (a ``row_number`` window would).
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(prefer) + [c for c in rest if c not in prefer]
    packed = F.max(F.struct(*[F.col(c).alias(c) for c in order])).alias("_w")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest]).select(
        *df.columns
    )


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str] = C.SERVING_KEY) -> DataFrame:
    """New contents of the target after ``INSERT ... ON DUPLICATE KEY UPDATE``.

    Target rows whose key appears in the updates are replaced; all other
    rows stay; new keys are added. A left-anti join on the key (shuffle on
    the key, or broadcast of the key set when AQE measures it small) plus a
    union by name.
    """
    u = updates.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    # Null-safe key match (a NULL key part equals NULL, as one row per key
    # requires); Spark still plans it as an equi-join.
    cond = None
    for i, k in enumerate(keys):
        c = target[k].eqNullSafe(u[f"_key{i}"])
        cond = c if cond is None else cond & c
    keep = target.join(u, cond, "left_anti")
    return keep.unionByName(updates.select(*target.columns))
