"""A corpus pipeline over the operators of popspark.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; what it returns is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents; the last
returns the token ids of the documents that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm import byte_bpe, decontaminate, exact_dedup, near_join, toxicity
from popspark.llm.common import shared_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; it learns from the labelled rows of its input."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return near_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold much of a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and whether the ids decode to the text."""
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return byte_bpe.encode_checked(docs).select("doc_id", n_tokens, "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", tokenize),
]

#: a trained classifier and a byte-level BPE are beyond SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents; every stage's result is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
