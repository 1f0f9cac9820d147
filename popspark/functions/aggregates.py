"""Missing-propagating aggregates (A5).

Spark's ``sum`` skips NULLs ({2, NULL} → 2); the reproduced semantics give
NULL as soon as one input is missing.  ``strict_sum`` keeps that while
staying algebraic: count(*), count(x) and sum(x) all have partial forms, so
map-side partial aggregation (and therefore skew tolerance) is preserved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_sum(c: Column | str) -> Column:
    """sum(x) in BIGINT, or NULL when any row of the group has x NULL.

    Given a column name, the same expression is built as one SQL expression
    (one JVM round trip instead of a dozen when the plan is assembled).
    """
    if isinstance(c, str):
        q = f"`{c}`"
        return F.expr(f"CASE WHEN count(1) = count({q}) THEN sum(CAST({q} AS BIGINT)) END")
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c.cast("bigint")))
