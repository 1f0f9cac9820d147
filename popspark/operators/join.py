"""Joins (J1; J2 is ``quality.missing_sources``).

J1 attaches state names *after* aggregation, so both sides are bounded by
the number of output cells, not by the input.  No broadcast hint is given:
the static planner broadcasts only under ``spark.sql.autoBroadcastJoinThreshold``
and AQE re-checks the measured shuffle size at runtime
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), falling back to a
sort-merge join above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def attach_state_names(df: DataFrame, names: DataFrame, key: str = "state_fips") -> DataFrame:
    """Left join on the state code; unmatched rows keep a NULL name.

    The comparison is null-safe, as the reproduced join matches a missing
    code to a missing code.  Spark still plans it as an equi-join.
    """
    n = names.select(F.col(key).alias("__k"), F.col("state_name"))
    return df.join(n, df[key].eqNullSafe(n["__k"]), "left").drop("__k")
