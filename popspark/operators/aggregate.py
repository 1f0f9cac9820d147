"""Grouped, missing-propagating aggregations (A1–A4).

Every aggregate here is ``strict_sum``: algebraic, so Spark plans a partial
aggregate before the shuffle.  That partial step is what makes the
pipelines skew-proof — a state holding a third of all rows still leaves
each map task with at most (years × bands × sexes × races) partial rows for
it — and what keeps the shuffle small whatever the input size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.aggregates import strict_sum


def sum_strict(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A1/A2/A3: group by ``keys``; each value column becomes its strict sum."""
    return df.groupBy(*keys).agg(*[strict_sum(v).alias(v) for v in values])


def national(
    states: DataFrame,
    keys: Sequence[str] = ("year", "age", "sex", "race_p_ethnicity"),
    value: str = "population",
) -> DataFrame:
    """A4 + P12: national rows re-aggregated from the state result.

    Reading the *state* result (not the raw rows) matters for 1990, whose
    pivot creates explicit NULL state cells that must null the national
    cell.  The input is already state-level, so this shuffle is tiny.
    """
    return (
        states.groupBy(*keys)
        .agg(strict_sum(value).alias(value))
        .withColumns({"state_fips": F.lit(codes.US_FIPS), "state_name": F.lit(codes.US_NAME)})
    )


def states_and_nation(df: DataFrame, keys: Sequence[str], values: Sequence[str], state: str = "state_fips") -> DataFrame:
    """A1 + A4 in one aggregate: ``keys``, the strict sums of ``values``, and ``nation`` (a row over all states).

    Grouping sets: an Expand gives every row once with its state and once
    without, and one shuffle carries the partial sums of both.  A strict sum
    over all rows is the strict sum of the states' strict sums, so this equals
    ``national`` on a state result, wherever state rows come straight from a
    group-by (not 1990, whose pivot makes missing state cells).  National rows
    are told by the grouping, as a missing state code is a group of its own.
    """
    rest = [k for k in keys if k != state]
    sums = [strict_sum(v).alias(v) for v in values]
    nation = F.grouping(state).cast("boolean").alias("nation")
    out = df.groupingSets([list(keys), rest], *keys).agg(nation, *sums)
    return out.withColumn(state, F.when(F.col("nation"), F.lit(codes.US_FIPS)).otherwise(F.col(state)))
