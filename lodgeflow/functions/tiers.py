"""Tier tables: label a value by the first rule it satisfies.

A tier table is ``((op, bound, label), ...)`` plus a default label, with
``op`` one of ``>``, ``>=``, ``<``, ``<=``, ``==`` or ``between`` (bound is
``(lo, hi)``, inclusive), rendered as a Spark ``when`` chain. A NULL value matches
no rule and gets the default, as in SQL.
"""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Tier = tuple[str, Any, Any]


def _pred(c: Column, op: str, bound) -> Column:
    if op == "between":
        return c.between(*bound)
    return {">": c > bound, ">=": c >= bound, "<": c < bound, "<=": c <= bound,
            "==": c == bound}[op]


def tier(c: Column, tiers: Sequence[Tier], default) -> Column:
    """Spark expression: the label of the first matching rule, else ``default``."""
    expr = None
    for op, bound, label in tiers:
        value = label if isinstance(label, Column) else F.lit(label)
        expr = (F.when(_pred(c, op, bound), value) if expr is None
                else expr.when(_pred(c, op, bound), value))
    default = default if isinstance(default, Column) else F.lit(default)
    return default if expr is None else expr.otherwise(default)
