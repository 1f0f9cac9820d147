"""Wide ↔ long reshapes.

``DataFrame.unpivot`` plans as an ``Expand`` (codegen'd, no shuffle) and keeps
NULL values, as the reproduced ``pivot_longer`` does.  ``pivot`` is always
given its value list, which (a) skips Spark's extra distinct-values job over
the input and (b) bounds the width by construction.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_with_prefix(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """P10: column names starting with any prefix, case-insensitively, in frame order.

    A driver-side comprehension over the schema; safe once the frame holds
    only intended columns (after an explicit select).
    """
    lowered = tuple(p.lower() for p in prefixes)
    return [c for c in columns if c.lower().startswith(lowered)]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def unpivot_named(
    df: DataFrame,
    ids: Sequence[str],
    values: Mapping[str, str],
    name_col: str,
    value_col: str,
) -> DataFrame:
    """Unpivot ``values`` (label → column); ``name_col`` receives the label.

    R1/R3: the label is what lands in the long table, so columns are renamed
    to their labels first (a projection, fused into the same stage).
    """
    if all(label == col for label, col in values.items()):
        return df.unpivot(list(ids), list(values), name_col, value_col)
    labelled = df.select(*ids, *[_q(col).alias(label) for label, col in values.items()])
    return labelled.unpivot(list(ids), list(values), name_col, value_col)


def unpivot_split(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    names_to: tuple[str, str],
    value_col: str,
    sep: str = "_",
) -> DataFrame:
    """R2: unpivot and split each column name at ``sep`` into two key columns."""
    tmp = "__name"
    long = df.unpivot(list(ids), list(values), tmp, value_col)
    parts = F.split(F.col(tmp), sep, 2)
    return long.select(
        *ids,
        parts.getItem(0).alias(names_to[0]),
        parts.getItem(1).alias(names_to[1]),
        value_col,
    )


def pivot_cells(
    df: DataFrame,
    ids: Sequence[str],
    cell: Column,
    values: Sequence[str],
    aggs: Mapping[str, object],
) -> DataFrame:
    """One row per ``ids`` with one column per (cell value, aggregate).

    ``aggs`` maps a suffix to an aggregate Column; with a single entry the
    output columns are named exactly as the cell values, otherwise
    ``<value>_<suffix>``.  A cell with no input row is NULL.
    """
    grouped = df.withColumn("__cell", cell).groupBy(*ids).pivot("__cell", list(values))
    cols = [agg.alias(suffix) for suffix, agg in aggs.items()]
    return grouped.agg(*cols)
