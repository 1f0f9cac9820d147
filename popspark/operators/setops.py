"""Set operations and ordering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import CANONICAL
from ..functions import codes, recode


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL matched by column name (positional union is wrong here)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def canonical(df: DataFrame) -> DataFrame:
    """The seven output columns in their canonical order."""
    return df.select(*CANONICAL)


def states_and_nation(states: DataFrame, nation: DataFrame) -> DataFrame:
    """State rows followed by national rows, by name."""
    return canonical(states).unionByName(canonical(nation))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct; NULLs compare equal."""
    return df.dropDuplicates()


def sort_codes(df: DataFrame, key: str = "state_fips") -> DataFrame:
    """O1: ascending by code, missing codes last."""
    return df.orderBy(F.col(key).asc_nulls_last())


def _export_keys(decade: int):
    """(is_us, block keys, within-block sort keys) of the O2 order."""
    is_us = (F.col("state_fips") == F.lit(codes.US_FIPS)) & (F.col("state_name") == F.lit(codes.US_NAME))
    is_us = F.coalesce(is_us, F.lit(False))
    band = recode.band_rank("age")
    if decade in (1970, 1980):
        rest = [F.col("sex").asc_nulls_last(), F.col("race_p_ethnicity").asc_nulls_last(), band.asc_nulls_last()]
    elif decade == 1990:
        # state rows follow the pivot's columns: the NH cells, then H last;
        # national rows are grouped by the label, so H sorts first there.
        h_last = F.when(~is_us & (F.col("race_p_ethnicity") == F.lit(codes.HISPANIC_TOTAL_1990)), 1).otherwise(0)
        rest = [
            band.asc_nulls_last(),
            F.col("sex").asc_nulls_last(),
            h_last.asc(),
            F.col("race_p_ethnicity").asc_nulls_last(),
        ]
    else:
        prefix = F.when(
            ~is_us,
            recode.code_map("race_p_ethnicity", dict(zip(codes.RACE_NAMES_2000, codes.RACE_LEVELS_2000))),
        )
        rest = [
            band.asc_nulls_last(),
            F.col("sex").asc_nulls_last(),
            prefix.asc_nulls_last(),
            recode.race_rank_2000("race_p_ethnicity").asc_nulls_last(),
        ]
    return is_us, [is_us.asc(), F.col("year").asc_nulls_last()], [F.col("state_fips").asc_nulls_last(), *rest]


def export_order(df: DataFrame, decade: int) -> DataFrame:
    """O2: the order in which the reproduced pipeline writes a decade.

    State rows come first in group-key order, national rows after them.
    1970/1980 group keys end (sex, race, age); 1990 (age, sex) then the
    pivot's column order for state rows (NH_* alphabetical, H last) and the
    label for national rows; 2000+ state rows (age, sex, race prefix) and
    national rows (age, sex, race level).  Export only — a global sort is a
    range-partitioned shuffle of the (small, aggregated) result, so call it
    just before writing.
    """
    _, block, rest = _export_keys(decade)
    return df.orderBy(*block, *rest)


def export_position(df: DataFrame, decade: int) -> DataFrame:
    """O2 as data: each row's 1-based position inside its (national?, year) block.

    Blocks are written in (state rows, national rows) × year order, so the
    block plus this position is the full export order.  The window is
    partitioned by block, which holds at most one year of one decade's
    aggregated output, never the input.
    """
    is_us, _, rest = _export_keys(decade)
    w = Window.partitionBy(is_us, F.col("year")).orderBy(*rest)
    return df.withColumn("position", F.row_number().over(w))


def shared_rows(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` for several readers: dealt out by ``keys`` in a shuffle that all can reuse with those below it, so that the costly steps run once.

    Every reader would push its own filters and columns below that shuffle, so
    that no two were alike: a row id in the struct (a nondeterministic
    expression) keeps filters and pruning above it.
    """
    row = F.struct(*df.columns, F.monotonically_increasing_id().alias("row_id"))
    return df.repartition(*keys).select(row.alias("row")).select(*(f"row.{c}" for c in df.columns))


def product_positions(decades: Mapping[int, DataFrame]) -> DataFrame:
    """O2 of the combined product as data: its rows with decade and a 1-based ``position`` in the whole product.

    No task sorts the product.  A run is the rows of one (decade, national?,
    year, state), at most one row per band, sex and race.  Runs are counted,
    and the counts are added up in export order, first over the runs of a
    decade, then over the decades; a row's position is the sum before its run
    plus its place in the run.  The rows, as large as the product, are shuffled
    whole, so that both readers use the same aggregates of the decades.
    """
    parts = []
    for d, df in decades.items():
        is_us, _, rest = _export_keys(d)
        keyed = canonical(df).withColumns({"decade": F.lit(d), "nation": is_us})
        run = Window.partitionBy("nation", "year", "state_fips").orderBy(*rest)
        parts.append(keyed.withColumn("place", F.row_number().over(run)))
    key = ["decade", "nation", "year", "state_fips"]
    rows = shared_rows(union_by_name(parts), *key)
    runs = rows.groupBy(*key).agg(F.max("place").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    in_decade = Window.partitionBy("decade").orderBy("nation", F.col("year").asc_nulls_last(), F.col("state_fips").asc_nulls_last()).rowsBetween(*earlier)
    totals = runs.groupBy("decade").agg(F.sum("n").alias("total"))
    first = totals.select("decade", F.coalesce(F.sum("total").over(Window.orderBy("decade").rowsBetween(*earlier)), F.lit(0)).alias("first"))  # a row per decade
    before = F.coalesce(F.sum("n").over(in_decade), F.lit(0))
    offsets = runs.withColumn("before", before).join(first, "decade").select(*key, (F.col("first") + F.col("before")).alias("offset"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in key]
    placed = rows.alias("r").join(offsets.alias("o"), same)
    return placed.select(*(f"r.{c}" for c in CANONICAL), "r.decade", (F.col("o.offset") + F.col("r.place")).alias("position"))


def product_order(decades: Mapping[int, DataFrame]) -> DataFrame:
    """O2 of the combined product: decades in order, each as it is exported."""
    return product_positions(decades).orderBy("position")
