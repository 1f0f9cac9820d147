"""The whole job on source files (PL9): dimension → audit → decades → combine.

Directory contract:

    <src_root>/<decade>/<file>                   the 65 source files
    <out_root>/_commits/<number>/                what is published, and where it lies
    <out_root>/_versions/<id>/<output>           the outputs themselves:
        state_names                              S11
        <decade>/states-asrpe<decade>            S10, gzip CSV parts
        states-asrpe                             S12, combined gzip CSV
        states-asrpe-parquet/decade=<decade>     S12, Parquet copy, one output per decade

``output(spark, out_root, name)`` tells where a published output lies.
Everything is first written under ``<out_root>/_staging``.  Only when all
decades and the combined product are complete does one commit publish them
together (D3, ``sinks.publish``); a run that fails or is killed at any step
leaves the published outputs as they were.

Each decade is written in the reproduced row order (O2: a range sort of
the already-aggregated result, at most tens of thousands of rows) before
the next starts and the combined product is built by re-scanning those
written results (S9), so a lost executor only ever recomputes the current
decade, and lineage never spans decades.  The combined product is ordered
by source decade, then by the decade's export order.

A decade's result depends on the content of its files and on the state names.
``content`` digests both, whatever the files' names, sizes and times.  With
``resume=True`` a run reuses the decades that a failed run left in the staging
folder if their digest is the same.  With ``incremental=True`` it also leaves
published decades with the same digest as they are: the new commit names their
old files, and only the other decades and the combined CSV are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..functions import codes
from ..operators import quality, setops
from ..sources import readers, sinks
from . import pipelines as pl


def list_sources(spark: SparkSession, src_root: str, decade: int) -> DataFrame:
    """(file_name, n_bytes, modified) of every file under <src_root>/<decade>; content is not read."""
    try:
        listing = spark.read.format("binaryFile").load(f"{src_root.rstrip('/')}/{decade}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file_name string, n_bytes bigint, modified timestamp")
    return listing.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("n_bytes"),
        F.col("modificationTime").alias("modified"),
    )


def files_with_rows(spark: SparkSession, src_root: str, decade: int, names: Iterable[str]) -> DataFrame:
    """(decade, file_name, n_rows) of the files that hold a data row; n_rows is 1.

    Reads no further than each file's first data row: for the layouts with a
    header the second non-blank line, for 1980 the first data line.
    """
    value = F.col("value")
    is_data = readers.is_data_line_1980(value) if decade == 1980 else F.length(F.trim(value)) > 0
    lines = 2 if decade in codes.WIDE_RACE_LAYOUTS else 1
    found = [
        spark.read.text(f"{src_root.rstrip('/')}/{decade}/{name}")
        .filter(is_data)
        .limit(lines)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(decade).alias("decade"), F.lit(name).alias("file_name"), F.when(F.col("n") >= lines, 1).alias("n_rows"))
        for name in names
    ]
    if not found:
        return spark.createDataFrame([], "decade int, file_name string, n_rows int")
    return setops.union_by_name(found)


def audit_sources(spark: SparkSession, src_root: str, decades: Sequence[int]) -> DataFrame:
    """Expected files that are missing, or hold no data row, for the given decades."""
    manifest = {d: codes.source_manifest()[d] for d in decades}
    expected = quality.manifest_frame(spark, manifest)
    present = []
    for d in decades:
        # names of at most the manifest's 65 files
        listed = {r.file_name for r in list_sources(spark, src_root, d).select("file_name").collect()}
        present.append(files_with_rows(spark, src_root, d, [f for f in manifest[d] if f in listed]))
    return quality.missing_sources(expected, setops.union_by_name(present), on=("decade", "file_name"))


def source_paths(src_root: str, decade: int) -> list[str]:
    return [f"{src_root.rstrip('/')}/{decade}/{f}" for f in codes.source_manifest()[decade]]


def read_decade(
    spark: SparkSession, decade: int, paths: Sequence[str], seen: Observation | None = None, problems: readers.Problems | None = None
) -> DataFrame:
    """The typed source of one decade (S1–S6, U2); ``seen`` counts the rejected lines of 1980, ``problems`` unreadable fields."""
    if decade == 1970:
        return readers.read_wide_age_1970(spark, paths, problems)
    if decade == 1980:
        return readers.read_wide_age_1980(spark, paths, seen, problems=problems)
    if decade == 1990:
        return readers.read_long_codes_1990(spark, paths, problems)
    return readers.read_wide_race(spark, paths, decade, problems)


def write_decade(
    spark: SparkSession, src_root: str, out: str, decade: int, names: DataFrame, problems: readers.Problems | None = None
) -> DataFrame:
    """PL1–PL6 on files: writes the decade's result to ``out``; returns its typed source.

    1980 rows are the lines behind the preamble, by their numbers.  If one of
    them doesn't look like data, or a line of the preamble looks like a row,
    the file isn't laid out as expected, so the decade fails.
    """
    seen = Observation("lines") if decade == 1980 else None
    paths = source_paths(src_root, decade)
    raw = read_decade(spark, decade, paths, seen, problems)
    sinks.write_csv_gz(setops.export_order(pl.pipeline(decade, raw, names), decade), out, mode="overwrite")
    if seen and (n := seen.get[readers.ROW_LIKE]):
        raise quality.SourceError(f"{n} of the {codes.PREAMBLE_LINES_1980} lines of the preamble are laid out as rows")
    if seen and (n := seen.get[readers.REJECTED]):
        raise quality.SourceError(f"{n} lines behind the preamble are not data lines")
    return read_decade(spark, decade, paths)


def decade_name(decade: int) -> str:
    return f"{decade}/states-asrpe{decade}"


def copy_name(decade: int) -> str:
    return f"states-asrpe-parquet/decade={decade}"


def output(spark: SparkSession, out_root: str, name: str) -> str:
    """Where the published output ``name`` lies, such as ``states-asrpe`` or ``state_names``."""
    return sinks.output(spark, out_root.rstrip("/"), name)


def decade_output(spark: SparkSession, out_root: str, decade: int) -> str:
    return output(spark, out_root, decade_name(decade))


def read_product(spark: SparkSession, out_root: str) -> DataFrame:
    """The published combined product (its CSV)."""
    return readers.read_decade_result(spark, output(spark, out_root, "states-asrpe"))


def read_product_copy(spark: SparkSession, out_root: str) -> DataFrame:
    """The published Parquet copy, with the source decade; a filter on it leaves only the scans of those decades."""
    found = sinks.newest(spark, out_root.rstrip("/"))
    parts = [
        spark.read.schema(readers.OUTPUT_SCHEMA).parquet(sinks.output(spark, out_root.rstrip("/"), copy_name(d), found)).withColumn("decade", F.lit(d))
        for d in codes.DECADES
        if copy_name(d) in found.outputs
    ]
    return setops.union_by_name(parts)


def staging(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/_staging"


def content(spark: SparkSession, decade: int, paths: Sequence[str]) -> DataFrame:
    """(file_name, lines, low, high), a digest of every file's content, one row per file.

    Two sums of 64-bit hashes over a file's lines: they don't depend on the
    order of the lines, so every task adds up its own, and rewriting a file
    with its rows in another order changes nothing.  Where a line's number
    matters (the preamble of 1980, a header), it is hashed with the line.
    """
    first = codes.PREAMBLE_LINES_1980 if decade == 1980 else 1 if decade in codes.WIDE_RACE_LAYOUTS else 0
    lines = readers.numbered_lines(spark, list(paths), first)
    halves = [F.sum(F.xxhash64(F.lit(seed), "value", "line").cast("decimal(20,0)")).cast("string").alias(name) for seed, name in ((1, "low"), (2, "high"))]
    return lines.groupBy(F.col(readers.FILE).alias("file_name")).agg(F.count(F.lit(1)).alias("lines"), *halves)


def _fingerprint(spark: SparkSession, src_root: str, decade: int, names: DataFrame) -> str:
    """A digest of what a decade's result depends on: its files' content (≤ 51 rows), and the state names (≤ 57 rows)."""
    files = sorted(map(str, content(spark, decade, source_paths(src_root, decade)).collect()))
    return hashlib.sha256("\n".join(files + sorted(map(str, names.collect()))).encode()).hexdigest()


def run_job(
    spark: SparkSession,
    src_root: str,
    out_root: str,
    county_table: DataFrame,
    decades: Sequence[int] = codes.DECADES,
    check_sources: bool = True,
    resume: bool = False,
    domain_report: bool = False,
    parse_report: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """PL9. Returns the combined product as re-read from disk.

    ``domain_report`` also writes, per decade, the source codes outside their
    domains (``<decade>/domain-violations/``, one small CSV), and the state
    codes with several names (``state_names-violations/``).  Unmapped codes
    never fail the job — they become missing labels, as in the reproduced
    pipeline — and the report costs one more scan of each decade's input.
    ``parse_report`` writes, per decade, how many fields of each file and
    column aren't missing but unreadable (``<decade>/parse-problems/``),
    counted by the scan that computes the result.
    """
    out_root, stage = out_root.rstrip("/"), staging(out_root)
    if resume:
        sinks.reclaim(spark, stage, out_root)
    else:
        sinks.remove(spark, stage)
    published = sinks.newest(spark, out_root) if incremental else sinks.Commit()
    outputs = ["state_names"]
    names_table = pl.state_names_sorted(county_table)
    sinks.write_state_names(names_table, f"{stage}/state_names", mode="overwrite")
    names = readers.read_state_names(spark, f"{stage}/state_names")
    if domain_report:
        sinks.write_report(quality.ambiguous_names(names), f"{stage}/state_names-violations")
        outputs.append("state_names-violations")

    if check_sources:
        quality.require_sources(audit_sources(spark, src_root, decades))

    inputs: dict[str, str] = {}
    results: dict[int, str] = {}
    redone: list[int] = []

    def one(decade: int) -> None:
        out, reports = decade_name(decade), {}
        if domain_report:
            reports["domain"] = f"{decade}/domain-violations"
        if parse_report:
            reports["parse"] = f"{decade}/parse-problems"
        wanted = [out, *reports.values()]
        digest = inputs[str(decade)] = _fingerprint(spark, src_root, decade, names)
        if published.inputs.get(str(decade)) == digest and {*wanted, copy_name(decade)} <= published.outputs.keys():
            results[decade] = sinks.output(spark, out_root, out, published)
            return
        marker = f"{stage}/{decade}/_inputs-{digest}"
        if not (sinks.exists(spark, marker) and all(sinks.exists(spark, f"{stage}/{p}/_SUCCESS") for p in wanted)):
            sinks.remove(spark, f"{stage}/{decade}")
            problems = readers.Problems(source_paths(src_root, decade)) if parse_report else None
            raw = write_decade(spark, src_root, f"{stage}/{out}", decade, names, *([problems] if problems else []))
            if domain_report:
                sinks.write_report(quality.domain_violations(raw, quality.layout_checks(decade)), f"{stage}/{reports['domain']}")
            if problems:
                found = spark.createDataFrame(problems.counts(), "file_name string, column string, n_fields long")
                sinks.write_report(found.coalesce(1), f"{stage}/{reports['parse']}")
            sinks.mark(spark, marker)
        results[decade] = f"{stage}/{out}"
        redone.append(decade)
        outputs.extend(wanted)

    quality.fail_fast(decades, one)
    outputs.extend(write_combined(spark, results, stage, redone))
    sinks.publish(spark, stage, out_root, outputs, inputs, _other_copies(decades))
    return read_product(spark, out_root)


def write_combined(spark: SparkSession, paths: Mapping[int, str], root: str, redone: Sequence[int]) -> list[str]:
    """PL7: re-scans written decades (S9), unions them (U3), writes the product (S12) under ``root``.

    The CSV holds all decades, ordered by decade, then as the decade itself
    was exported.  The Parquet copy has a folder per decade; only those of
    ``redone`` are written.
    """
    results = {d: readers.read_decade_result(spark, p) for d, p in paths.items()}
    sinks.write_csv_gz(setops.canonical(setops.product_order(results)), f"{root}/states-asrpe", mode="overwrite")
    if redone:
        copy = pl.combine({d: results[d] for d in redone})
        sinks.write_parquet_by_decade(copy, f"{root}/states-asrpe-parquet", mode="overwrite")
    return ["states-asrpe", *map(copy_name, redone)]


def _other_copies(decades: Iterable[int]) -> list[str]:
    """The folders that a copy of a product of only these decades doesn't have."""
    return [copy_name(d) for d in codes.DECADES if d not in set(decades)]


def combine_outputs(spark: SparkSession, out_root: str, decades: Sequence[int] = codes.DECADES) -> DataFrame:
    """PL7 on published decades.

    A decade is read from this job's output or, when that is absent, from a
    single ``<decade>/states-asrpe<decade>.csv.gz`` file as the reproduced job
    writes it, so existing results can be combined too.
    """
    out_root = out_root.rstrip("/")
    found, paths = sinks.newest(spark, out_root), {}
    for d in decades:
        path = sinks.output(spark, out_root, decade_name(d), found)
        paths[d] = path if sinks.exists(spark, path) else f"{out_root}/{decade_name(d)}.csv.gz"
    stage = f"{out_root}/_combining"
    sinks.remove(spark, stage)
    sinks.publish(spark, stage, out_root, write_combined(spark, paths, stage, list(decades)), gone=_other_copies(decades))
    return read_product(spark, out_root)
