"""Sinks (S10–S12).

Results are written as directories of part files, never funnelled through
one task: gzip CSV (header, ``NA`` for missing) for export, Parquet
partitioned by decade for the combined product.  The job writes to a staging
folder; ``publish`` makes what is complete the published version (D3).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


#: how results are rendered, and read back
CSV_OPTIONS = {"nullValue": "NA"}


def write_csv_gz(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Gzip CSV with header; NULL written as NA."""
    df.write.mode(mode).options(header="true", compression="gzip", **CSV_OPTIONS).csv(path)


def write_state_names(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The state-name lookup as plain CSV with header (tiny: one part)."""
    df.coalesce(1).write.mode(mode).option("header", "true").csv(path)


def write_parquet_by_decade(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S12 (Parquet copy): partitioned by the source decade, so readers prune decades."""
    df.write.mode(mode).partitionBy("decade").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """An audit result as CSV with header; usually tiny, so AQE leaves few parts."""
    df.write.mode("overwrite").option("header", "true").option("nullValue", "NA").csv(path)


# ------------------------------------------------------------------ commits
VERSIONS, COMMITS = "_versions", "_commits"


def _fs(spark: SparkSession, path: str):
    """(file system, path) of any Hadoop-compatible URI."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a local session may have none, and gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="popspark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def mark(spark: SparkSession, path: str) -> None:
    """Makes an empty file, as a marker."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, a: str, b: str) -> None:
    fs, source = _fs(spark, a)
    target = spark._jvm.org.apache.hadoop.fs.Path(b)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"cannot move {a} to {b}")


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


@dataclass
class Commit:
    """What is published: each output's folder, relative to the root, and what the decades were made from."""

    number: int = 0
    outputs: dict[str, str] = field(default_factory=dict)
    inputs: dict[str, str] = field(default_factory=dict)


def _read_commit(spark: SparkSession, root: str, name: str) -> Commit:
    """A commit's rows are (kind, name, value): a CSV with one line for each output or input."""
    rows = spark.read.schema("kind STRING, name STRING, value STRING").csv(f"{root}/{COMMITS}/{name}").collect()
    return Commit(int(name), *({r.name: r.value for r in rows if r.kind == kind} for kind in ("output", "input")))


def newest(spark: SparkSession, root: str) -> Commit:
    """The published state; commit 0 with nothing in it if there is none."""
    found = [n for n in _names(spark, f"{root}/{COMMITS}") if n.isdigit()]
    return _read_commit(spark, root, found[-1]) if found else Commit()


def output(spark: SparkSession, root: str, name: str, commit: Commit | None = None) -> str:
    """Where a published output lies; an output that was never committed lies at its plain place."""
    found = (commit or newest(spark, root)).outputs.get(name)
    return f"{root}/{found or name}"


def publish(
    spark: SparkSession,
    stage: str,
    root: str,
    names: Sequence[str],
    inputs: Mapping[str, str] | None = None,
    gone: Sequence[str] = (),
    keep: int = 2,
) -> Commit:
    """D3: makes ``stage``/name the published output of all names, at once.

    The staging folder becomes a version folder, which nobody reads yet.  A
    commit then lists where every output lies, those of earlier versions that
    stay included, ``gone`` ones not; it is written aside and moved to its number by a single
    rename.  Readers take the commit with the highest number, so a driver that
    is killed before the rename leaves the old outputs, and after it the new
    ones.  Then versions go that none of the last ``keep`` commits names; a
    reader that began with the commit before still finds its files.  One
    writer at a time, as there is one staging folder.
    """
    absent = [n for n in names if not exists(spark, f"{stage}/{n}")]
    if absent:
        raise OSError(f"not in {stage}: {', '.join(absent)}")
    old = newest(spark, root)
    version = f"{VERSIONS}/{uuid.uuid4().hex}"
    outputs = {n: path for n, path in old.outputs.items() if n not in gone} | {n: f"{version}/{n}" for n in names}
    remade = {n.split("/")[0] for n in names}  # what these were made from before doesn't count any more
    made_from = {k: v for k, v in old.inputs.items() if k not in remade} | dict(inputs or {})
    new = Commit(old.number + 1, outputs, made_from)
    rename(spark, stage, f"{root}/{version}")
    rows = [("output", *x) for x in new.outputs.items()] + [("input", *x) for x in new.inputs.items()]
    aside = f"{root}/{COMMITS}/_{uuid.uuid4().hex}"
    spark.createDataFrame(rows, "kind string, name string, value string").coalesce(1).write.csv(aside)
    rename(spark, aside, f"{root}/{COMMITS}/{new.number:012d}")
    vacuum(spark, root, keep)
    return new


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Removes commits but the last ``keep``, what was written aside, and versions that no commit left names."""
    found = _names(spark, f"{root}/{COMMITS}")
    numbers = [n for n in found if n.isdigit()]
    kept = numbers[len(numbers) - min(keep, len(numbers)) :]
    named = {path.split("/")[1] for n in kept for path in _read_commit(spark, root, n).outputs.values() if path.startswith(f"{VERSIONS}/")}
    for n in found:
        if n not in kept:
            remove(spark, f"{root}/{COMMITS}/{n}")
    for v in _names(spark, f"{root}/{VERSIONS}"):
        if v not in named:
            remove(spark, f"{root}/{VERSIONS}/{v}")


def reclaim(spark: SparkSession, stage: str, root: str) -> None:
    """Takes back the staging folder of a run that ended between its last two steps, for a run that resumes."""
    named = {p.split("/")[1] for n in _names(spark, f"{root}/{COMMITS}") if n.isdigit() for p in _read_commit(spark, root, n).outputs.values() if p.startswith(f"{VERSIONS}/")}
    lost = [v for v in _names(spark, f"{root}/{VERSIONS}") if v not in named]
    if len(lost) == 1 and not exists(spark, stage):
        rename(spark, f"{root}/{VERSIONS}/{lost[0]}", stage)
