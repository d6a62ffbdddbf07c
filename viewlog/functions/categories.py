"""App code -> content category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def category_sql(app: str = C.APP) -> str:
    """The CASE expression of ``category_of`` as SQL text."""
    a = _sql_col(app)
    whens = " ".join(
        f"WHEN {a} IN ({', '.join(_sql_str(c) for c in codes)}) THEN {_sql_str(name)}" for name, codes in C.CATEGORY_RULES
    )
    return f"CASE {whens} ELSE {_sql_str(C.ERROR_CATEGORY)} END"


def is_category_sql(name: str, app: str = C.APP) -> str:
    """Predicate ``category_of(app) = name`` as SQL text.

    The code lists are disjoint, so membership in one list is the same as the
    CASE picking that category; a conditional sum then costs one ``IN`` per
    category instead of the whole CASE per sum.
    """
    a = _sql_col(app)
    if name == C.ERROR_CATEGORY:
        every = [code for _, codes in C.CATEGORY_RULES for code in codes]
        return f"coalesce(NOT ({a} IN ({', '.join(_sql_str(c) for c in every)})), true)"
    for cat, codes in C.CATEGORY_RULES:
        if cat == name:
            return f"({a} IN ({', '.join(_sql_str(c) for c in codes)}))"
    raise ValueError(f"unknown category {name!r}")


def category_of(app: Column | str = C.APP) -> Column:
    """Content category of an app code.

    Exact, case-sensitive match against the fixed code lists; any other value,
    NULL included, maps to ``Error``. A single CASE expression, so it stays in
    whole-stage codegen. (Built from SQL text for a column name: one call
    instead of one per literal.)
    """
    if isinstance(app, str):
        return F.expr(category_sql(app))
    expr = None
    for name, codes in C.CATEGORY_RULES:
        cond = app.isin(*codes)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(C.ERROR_CATEGORY))


def is_category(name: str, app: Column | str = C.APP) -> Column:
    """Predicate ``category_of(app) == name`` (see ``is_category_sql``)."""
    if isinstance(app, str):
        return F.expr(is_category_sql(name, app))
    if name == C.ERROR_CATEGORY:
        every = [code for _, codes in C.CATEGORY_RULES for code in codes]
        return F.coalesce(~app.isin(*every), F.lit(True))
    for cat, codes in C.CATEGORY_RULES:
        if cat == name:
            return app.isin(*codes)
    raise ValueError(f"unknown category {name!r}")


def transform_category(df: DataFrame, app_col: str = C.APP, out_col: str = C.TYPE) -> DataFrame:
    """Add the ``Type`` column."""
    return df.withColumn(out_col, category_of(app_col))
