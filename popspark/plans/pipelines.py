"""The decade pipelines (PL1–PL6), the state-name dimension (PL8) and the
combined product (PL7/PL9).

Each pipeline takes a typed source DataFrame (from ``sources.readers`` or
``sources.driver_views``) plus the state-name dimension and returns the
seven canonical columns.  Shape of every plan:

    scan → project/recode → partial agg → Exchange(year,state,...) → final agg
         → unpivot (Expand, on state-level rows only) → join names
         → ∪ national re-aggregate of that same result (exchange reused)

Aggregating the wide columns *before* unpivoting is equivalent for
strict sums (associative, per column) and keeps the Expand off the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, recode
from ..functions.aggregates import strict_sum
from ..operators import aggregate, join, reshape, setops


# ----------------------------------------------------------------- PL8
def state_names(county_table: DataFrame) -> DataFrame:
    """PL8: (state_code, state_name, ...) → distinct (state_fips, state_name) for codes ≤ '56'.

    P3 compares *strings*: an integer literal would make Spark cast the
    column and fail on non-numeric codes under ANSI.
    """
    kept = county_table.filter(F.col("state_code") <= F.lit(codes.MAX_STATE_CODE))
    return setops.distinct_rows(
        kept.select(F.col("state_code").alias("state_fips"), F.col("state_name"))
    )


def state_names_sorted(county_table: DataFrame) -> DataFrame:
    """PL8 with O1 (ascending code, as written to disk)."""
    return setops.sort_codes(state_names(county_table))


def _finish(states: DataFrame, names: DataFrame) -> DataFrame:
    """J1 + A4 + U1 on a state-level long frame."""
    named = join.attach_state_names(states, names)
    us = aggregate.national(named)
    return setops.states_and_nation(named, us)


# ------------------------------------------------------------ PL1 / PL2
def wide_age_states(raw: DataFrame, decade: int) -> DataFrame:
    """1970/1980 up to the state-level long frame (no names yet)."""
    if decade == 1970:
        fips = F.col("fips")  # 1970 codes are used as they are
        sex = recode.sex_of("race_sex", codes.RACE_SEX_1970)
        race = recode.race_of("race_sex", codes.RACE_SEX_1970)
    elif decade == 1980:
        fips = recode.pad_one_zero("fips")
        sex = recode.title_case(recode.last_word("race_sex"))
        race = recode.first_word("race_sex")
    else:
        raise ValueError(f"not a wide-age decade: {decade}")
    bands = codes.wide_age_band_members()
    rec = raw.select(
        F.col("year"),
        recode.state_of_fips(fips).alias("state_fips"),
        sex.alias("sex"),
        race.alias("race_p_ethnicity"),
        *[recode.add_strict(members).alias(label) for label, members in bands.items()],
    )
    keys = ["year", "state_fips", "sex", "race_p_ethnicity"]
    wide = aggregate.sum_strict(rec, keys, list(codes.BANDS))
    # the band columns are already named by their labels (F15 folded in)
    return reshape.unpivot_named(wide, keys, {b: b for b in codes.BANDS}, "age", "population")


def pipeline_wide_age(raw: DataFrame, names: DataFrame, decade: int) -> DataFrame:
    """PL1 (1970) / PL2 (1980)."""
    return _finish(wide_age_states(raw, decade), names)


# ----------------------------------------------------------------- PL3
def long_codes_records(raw: DataFrame) -> DataFrame:
    """1990 recodes: year, state, band, sex, race, origin, population."""
    return raw.select(
        recode.year_from_code("year", codes.YEAR_OFFSET_1990).alias("year"),
        recode.state_of_fips(recode.pad_one_zero("fips")).alias("state_fips"),
        recode.age_band("age", first_age_code=0).alias("age"),
        recode.sex_of("race_sex", codes.RACE_SEX_1990).alias("sex"),
        recode.race_of("race_sex", codes.RACE_SEX_1990).alias("race"),
        recode.origin_label("origin").alias("origin"),
        F.col("population").cast("bigint").alias("population"),
    )


def cell_name(origin: str = "origin", race: str = "race"):
    """Pivot column name '<origin>_<race>', a missing label spelt 'NA'."""
    return F.concat(
        F.coalesce(F.col(origin), F.lit("NA")), F.lit("_"), F.coalesce(F.col(race), F.lit("NA"))
    )


def long_codes_states(raw: DataFrame) -> DataFrame:
    """1990 up to the state-level long frame with race_p_ethnicity (no names).

    R4 *is* the state aggregation: one groupBy(year, state, band, sex) with a
    pivot over the 15 possible origin×race cells (explicit values → no extra
    distinct job; bounded width).  Each cell carries its strict sum and its
    row count, so "cell absent everywhere" (the pivot column would not
    exist) is told apart from "cell NULL here".
    """
    rec = long_codes_records(raw)
    ids = ["year", "state_fips", "age", "sex"]
    cells = codes.pivot_names_1990()
    wide = reshape.pivot_cells(
        rec,
        ids,
        cell_name(),
        cells,
        {"pop": strict_sum("population"), "n": F.count(F.lit(1))},
    )
    hisp = [f"{codes.ORIGIN_LABELS[1]}_{r}" for r in codes.HISPANIC_RACES_1990]
    keep = [c for c in cells if c not in hisp]
    # H = sum of the four Hispanic race cells; any absent/NULL → NULL.
    h_value = " + ".join(f"CAST(`{c}_pop` AS BIGINT)" for c in hisp)
    # Long again over everything but the ids — one (label, value, rows)
    # struct per kept cell plus H, which exists whenever the pivot does.
    entries = [f"struct('{c}' AS race_p_ethnicity, `{c}_pop` AS population, `{c}_n` AS n)" for c in keep]
    entries.append(f"struct('{codes.HISPANIC_TOTAL_1990}' AS race_p_ethnicity, {h_value} AS population, 1L AS n)")
    long = wide.selectExpr(*ids, f"inline(array({', '.join(entries)}))")
    # A cell is a column only if some state row has it: semi-join on the
    # (≤ 16-row, bounded by the cell list) set of present cells.
    present = long.groupBy("race_p_ethnicity").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)
    return long.join(F.broadcast(present.select("race_p_ethnicity")), "race_p_ethnicity", "left_semi").select(
        *ids, "race_p_ethnicity", "population"
    )


def pipeline_long_codes(raw: DataFrame, names: DataFrame) -> DataFrame:
    """PL3 (1990)."""
    return _finish(long_codes_states(raw), names)


# ------------------------------------------------------------ PL4–PL6
def wide_race_filtered(raw: DataFrame, decade: int) -> DataFrame:
    """Postcensal YEAR codes only, all-ages total rows dropped (NULLs dropped too)."""
    lay = codes.WIDE_RACE_LAYOUTS[decade]
    lo, hi = lay["year_codes"]
    return raw.filter(F.col("YEAR").between(lo, hi) & (F.col("AGEGRP") != lay["total_age"]))


def wide_race_records(raw: DataFrame, decade: int) -> DataFrame:
    """P1 + F11 + F13/F14 + P4: year, STATE, COUNTY, band, 14 counts."""
    lay = codes.WIDE_RACE_LAYOUTS[decade]
    kept = wide_race_filtered(raw, decade)
    return kept.select(
        recode.year_from_code("YEAR", lay["year_offset"]).alias("year"),
        F.col("STATE"),
        F.col("COUNTY"),
        recode.age_band("AGEGRP", lay["first_age_code"]).alias("age"),
        *codes.WIDE_RACE_COLUMNS,
    )


def wide_race_states(raw: DataFrame, decade: int) -> DataFrame:
    """2000/2010/2020 up to the state-level long frame (no names).

    County → state is one aggregate (a sum of strict sums is the strict sum),
    done on the 14 wide columns, then R2 unpivots the state-level rows.
    """
    rec = wide_race_records(raw, decade).withColumnRenamed("STATE", "state_fips")
    keys = ["year", "state_fips", "age"]
    wide = aggregate.sum_strict(rec, keys, list(codes.WIDE_RACE_COLUMNS))
    values = reshape.columns_with_prefix(wide.columns, ("NH", "H"))  # the 14 counts
    long = reshape.unpivot_split(wide, keys, values, ("rpe", "sex"), "population")
    return long.select(
        "year",
        "state_fips",
        "age",
        recode.title_case("sex").alias("sex"),
        recode.race_label_2000("rpe").alias("race_p_ethnicity"),
        "population",
    )


def pipeline_wide_race(raw: DataFrame, names: DataFrame, decade: int) -> DataFrame:
    """PL4 (2000) / PL5 (2010) / PL6 (2020)."""
    return _finish(wide_race_states(raw, decade), names)


# ------------------------------------------------------------ dispatch
def pipeline(decade: int, raw: DataFrame, names: DataFrame) -> DataFrame:
    """The decade's pipeline on its typed source."""
    if decade in (1970, 1980):
        return pipeline_wide_age(raw, names, decade)
    if decade == 1990:
        return pipeline_long_codes(raw, names)
    if decade in codes.WIDE_RACE_LAYOUTS:
        return pipeline_wide_race(raw, names, decade)
    raise ValueError(f"unknown decade {decade}")


def combine(decade_results: Mapping[int, DataFrame]) -> DataFrame:
    """PL7/U3: all decades into one table (UNION ALL, by name), each row with its source decade."""
    return setops.union_by_name(
        [setops.canonical(df).withColumn("decade", F.lit(d)) for d, df in decade_results.items()]
    )
