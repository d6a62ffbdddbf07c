"""Per-row behaviour features of the gold layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

# Expressions are built as SQL text: one JVM call per expression instead of
# one per literal; Catalyst sees the same expression tree either way.


def most_watch(categories: Sequence[str] = C.CATEGORIES, zero_is_null: bool = False) -> Column:
    """Name of the category with the largest value.

    ``greatest`` skips NULLs; a tie goes to the first category in the given
    order; when every category is 0 the first category wins (as in the
    original) unless ``zero_is_null``; when every category is NULL the result
    is NULL.
    """
    cols = [_ident(c) for c in categories]
    top = f"greatest({', '.join(cols)})" if len(cols) > 1 else cols[0]
    whens = " ".join(f"WHEN {c} = {top} THEN {_lit(name)}" for name, c in zip(categories, cols))
    expr = f"CASE {whens} END"
    if zero_is_null:
        expr = f"CASE WHEN {top} > 0 THEN {expr} END"
    return F.expr(expr)


def taste(categories: Sequence[str] = C.CATEGORIES, sep: str = C.TASTE_SEPARATOR) -> Column:
    """Categories with a positive value, joined by ``-`` in category order.

    ``concat_ws`` skips the NULLs left by the non-matching ``when``s, so a
    contract with no positive category gets the empty string.
    """
    parts = ", ".join(f"CASE WHEN {_ident(c)} > 0 THEN {_lit(c)} END" for c in categories)
    return F.expr(f"concat_ws({_lit(sep)}, {parts})")


def active_segment(active_days: Column | str = C.ACTIVE_DAYS, min_days: int = C.ACTIVE_MIN_DAYS) -> Column:
    """``High`` when the number of distinct active days exceeds ``min_days``."""
    days = F.col(active_days) if isinstance(active_days, str) else active_days
    return F.when(days > min_days, F.lit(C.ACTIVE_HIGH)).otherwise(F.lit(C.ACTIVE_LOW))
