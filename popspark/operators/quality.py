"""Data-quality guards.

All guards are DataFrames of violations, computed by Spark; only the names
of missing files (at most the manifest's 65) are brought to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes


class SourceError(RuntimeError):
    """A decade could not be processed; carries the decade for context."""


def manifest_frame(spark: SparkSession, manifest: Mapping[int, Sequence[str]] | None = None) -> DataFrame:
    """Expected (decade, file_name) pairs; 65 rows for the full job."""
    manifest = manifest or codes.source_manifest()
    rows = [(int(d), str(f)) for d, files in manifest.items() for f in files]
    return spark.createDataFrame(rows, "decade int, file_name string")


def source_completeness(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files with their row counts; NULL ``n_rows`` = missing or empty.

    ``present`` has (file_name, n_rows).  Missing and zero-row sources both
    surface as NULL, which is what the fail-fast check tests for.
    """
    p = present.filter(F.col("n_rows") > 0).select("file_name", "n_rows")
    return expected.join(p, "file_name", "left").select("decade", "file_name", "n_rows")


def missing_sources(expected: DataFrame, present: DataFrame, on: Sequence[str] = ("file_name",)) -> DataFrame:
    """Expected files that are absent or empty (anti-join on ``on``)."""
    p = present.filter(F.col("n_rows") > 0).select(*on)
    return expected.join(p, list(on), "left_anti")


def domain_violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(column, value, n_rows) for every value failing its domain predicate.

    ``checks`` maps a column name to a predicate that is TRUE for valid
    values.  NULL counts as a violation (it becomes a missing label).  One
    pass over the input: each row emits its violations as (column, value)
    structs, which one partial-then-final aggregate counts.
    """
    flagged = F.array(
        *[
            F.when(
                ~F.coalesce(ok, F.lit(False)),
                F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")),
            )
            for name, ok in checks.items()
        ]
    )
    found = df.select(F.explode(F.filter(flagged, lambda v: v.isNotNull())).alias("v"))
    return found.groupBy(F.col("v.column").alias("column"), F.col("v.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def layout_checks(decade: int) -> dict[str, Column]:
    """Per-layout code domains (§1.5): column → predicate TRUE for a valid value."""
    c = F.col
    if decade == 1970:
        return {
            "year": c("year").isNotNull(),
            "fips": F.length("fips") == 5,
            "race_sex": c("race_sex").isin(*codes.RACE_SEX_1970),
        }
    if decade == 1980:
        words = F.split(c("race_sex"), " ")
        return {
            "year": c("year").isNotNull(),
            "fips": F.length("fips").between(4, 5),
            "race_sex": (F.size(words) >= 2)
            & F.lower(F.element_at(words, -1)).isin("male", "female"),
        }
    if decade == 1990:
        return {
            "year": c("year").isNotNull(),
            "fips": F.length("fips").between(3, 5),
            "age": c("age").between(0, 18),
            "race_sex": c("race_sex").isin(*codes.RACE_SEX_1990),
            "origin": c("origin").isNotNull(),
        }
    lay = codes.WIDE_RACE_LAYOUTS[decade]
    return {
        "YEAR": c("YEAR").isNotNull(),
        "AGEGRP": c("AGEGRP").between(lay["first_age_code"], codes.BAND_LAST_CODE[-1])
        | (c("AGEGRP") == lay["total_age"]),
        "STATE": F.length("STATE") == 2,
    }


def fail_fast(decades: Iterable[int], run: Callable[[int], object]) -> dict[int, object]:
    """D3: run each decade in order; the first failure aborts with its decade."""
    done: dict[int, object] = {}
    for d in decades:
        if d not in codes.DECADES:
            raise SourceError(f"unknown decade {d}")
        try:
            done[d] = run(d)
        except Exception as e:  # re-raised with context, never swallowed
            raise SourceError(f"failed to process {d}: {e}") from e
    return done


def require_sources(missing: DataFrame) -> None:
    """Raise when expected files are missing, naming all of them (the manifest has 65)."""
    names = [f"{r.decade}/{r.file_name}" for r in missing.orderBy("decade", "file_name").collect()]
    if names:
        raise SourceError(f"missing source files ({len(names)}): {', '.join(names)}")


def ambiguous_names(names: DataFrame) -> DataFrame:
    """D2 on the dimension: state codes with several names; each name would repeat the code's rows."""
    return names.groupBy("state_fips").agg(F.count_distinct("state_name").alias("n_names")).filter("n_names > 1")
