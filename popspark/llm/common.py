"""Helpers shared by the operators of this subpackage.

Every operator takes a DataFrame, reads only the columns it names and returns
new columns, so extra columns of any name never clash.
"""

from __future__ import annotations

import os
import string
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

#: bytes -> bytes: A-Z to a-z, every byte outside [0-9A-Za-z\x80-\xff] to a space
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
#: bytes -> bytes: A-Z to a-z, the white space \x09-\x0d to a space
SPACE_BYTES = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(col, UPPER, LOWER)


def crc_mod(col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % mod


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text after lower-casing A-Z."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name inside the folder that driver and executors share.

    That folder is ``spark.checkpoint.dir``. Only a local session may have
    none; it then gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the shared folder and reads it back.

    This cuts the lineage and keeps an expensive step from running twice. The
    files outlive lost executors; they go when the shared folder is cleared.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, text_hash, y) of all rows of at most ``max_rows`` labelled ids that are not held out.

    A row is held out when crc32(doc_id as text) mod 5 is 0. The sample is the
    ids with the smallest hash, the same in every run; the limit is on the
    narrow labels table, so at most ``max_rows`` ids are broadcast and the
    texts of the others never leave their scan task. ``one_per_id`` makes the
    bound hold for rows, once the texts have become small.
    """
    wanted = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(crc_mod(F.col("doc_id"), 5) != 0)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(wanted), "doc_id")


def one_per_id(rows: DataFrame, *columns: str) -> DataFrame:
    """doc_id, y and ``columns`` of the row with the smallest text_hash of every id; each task first reduces its own rows."""
    least = F.min(F.struct("text_hash", *columns)).alias("least")
    return rows.groupBy("doc_id", "y").agg(least).select("doc_id", "y", *(F.col(f"least.{c}") for c in columns))


def per_text(
    df: DataFrame,
    keys: list[str],
    text: str,
    fn: Callable[[list[str]], dict[str, list]],
    fields: str,
    batch_bytes: int = 2_000_000,
) -> DataFrame:
    """``keys`` and the columns that ``fn`` computes from a list of texts (null: empty).

    ``fn`` gets whole texts, as many at a time as hold ``batch_bytes`` bytes, and
    at least one.
    """
    src = df.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    ddl = StructType.fromDDL(", ".join([*(f"`{k}` {t}" for k, t in src.dtypes[:-1]), fields]))
    out = to_arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, len(keys), batch_bytes):
                got = fn(part.column(len(keys)).to_pylist())
                cols = {k: part.column(j) for j, k in enumerate(keys)}
                new = {k: pa.array(v, out.field(k).type) for k, v in got.items()}
                yield pa.RecordBatch.from_pydict(cols | new)

    return src.mapInArrow(run, ddl)


def text_slices(batch: pa.RecordBatch, column: int, batch_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows, as many at a time as hold ``batch_bytes`` bytes in ``column``, and at least one."""
    start, size = 0, 0
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    for i, length in enumerate(lengths):
        size += length or 0
        if size >= batch_bytes or i + 1 == len(lengths):
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0


def worker_file(path: str | None, default: str) -> str:
    """The place of a vocabulary file: a given path, or the public file's own."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(default)


def base_name(path: str) -> str:
    return os.path.basename(path)
