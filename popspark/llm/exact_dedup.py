"""Operator 5: exact deduplication by content sort, in DataFrame operations only.

Texts are equal when identical after lower-casing A-Z. Rows are
range-partitioned by the normalised text, each partition is sorted externally,
equal texts lie next to each other, and the window over that order compares
each whole text with its neighbour's. Spark samples the splitters and sends
them to the driver; so that they stay small, they are the first ``LEAD``
characters, with the whole text's hash to part texts that begin alike. Both
follow from the text, so equal texts share a range.

A text that very many rows share would fill one range. Such texts are found
first: hashes of the texts are counted (partial counts before the shuffle),
and a hash with more than rows / (4 x partitions) rows is hot. There are fewer
than 4 x partitions of those at any input size, so their list can be
broadcast. Rows of a hot hash get a salt, which splits their text over
several ranges; the runs of one hot text, one row per salt, are then merged on
the whole text. Only this merge, of at most 8 x partitions rows, is broadcast
back. A hash only chooses salts; equality is decided on texts alone.

Cases: a null text is an empty one. Of rows with equal text and equal id one
stays; a null id ranks below all others. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popspark.llm.common import lower_ascii, shuffle_partitions, staged, table

#: characters of a splitter
LEAD = 32

ORACLE = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW w AS (PARTITION BY norm)
"""


def normalised(text: str = "text") -> Column:
    return lower_ascii(F.coalesce(F.col(text), F.lit("")))


def _runs(docs: DataFrame, text: str, id_: str, keep: list[str]) -> DataFrame:
    """One row per document, with its place in the run of equal texts in its range."""
    parts = shuffle_partitions(docs.sparkSession)
    hash_ = F.xxhash64(normalised(text))
    target = max(docs.count() // (4 * parts), 1)  # rows of one text that one range may hold
    hot = (
        docs.groupBy(hash_.alias("hash"))
        .count()
        .filter(F.col("count") > max(target, 2))
        .select("hash", F.ceil(F.col("count") / target).alias("salts"))
    )
    salt = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("id"), F.col("salts"))).otherwise(F.lit(0).cast("long"))
    key = F.col("row").getField
    ranged = (
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
            hash_.alias("hash"),
            F.substring(normalised(text), 1, LEAD).alias("lead"),
        )
        .join(F.broadcast(hot), "hash", "left")
        .withColumn("id", key(id_))
        .select("row", "hash", "lead", F.col("salts").isNotNull().alias("hot"), salt.alias("salt"))
        .repartitionByRange(parts, "lead", "hash", "salt")
        .select("*", key(id_).alias("id"), lower_ascii(F.coalesce(key(text), F.lit(""))).alias("norm"))
        .sortWithinPartitions("lead", "hash", "salt", "norm", F.desc_nulls_last("id"))
    )
    run = Window.partitionBy("lead", "hash", "salt", "norm")
    ordered = run.orderBy(F.desc_nulls_last("id"))
    return ranged.select(
        "row",
        "id",
        "hot",
        "salt",
        F.sha2("norm", 256).alias("sha"),
        F.row_number().over(ordered).alias("place"),
        F.first("id").over(ordered).alias("run_id"),
        F.count(F.lit(1)).over(run).alias("run_size"),
        F.when(F.col("hot"), F.col("norm")).alias("hot_text"),
    )


def mark_duplicates(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """One row per document: the id, keep_id, group_size, kept and text_sha256."""
    runs = _runs(docs, text, id_, [id_, text]).drop("row")
    first = F.col("place") == 1
    runs = staged(runs.withColumn("hot_text", F.when(first, F.col("hot_text"))), "exact-runs")
    same = Window.partitionBy("hot_text")
    merged = runs.filter(first & F.col("hot")).select(
        "sha",
        "salt",
        F.max("run_id").over(same).alias("top"),
        F.sum("run_size").over(same).alias("size"),
        F.row_number().over(same.orderBy(F.desc_nulls_last("run_id"))).alias("rank"),
    )
    return runs.join(F.broadcast(merged), ["sha", "salt"], "left").select(
        F.col("id").alias(id_),
        F.when(F.col("hot"), F.col("top")).otherwise(F.col("run_id")).alias("keep_id"),
        F.when(F.col("hot"), F.col("size")).otherwise(F.col("run_size")).alias("group_size"),
        (first & (F.coalesce(F.col("rank"), F.lit(1)) == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns."""
    firsts = _runs(docs, text, id_, docs.columns).filter(F.col("place") == 1)
    best = Window.partitionBy("hot_text").orderBy(F.desc_nulls_last("run_id"))
    hot = firsts.filter("hot").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == 1)
    kept = firsts.filter(~F.col("hot")).select("row").unionByName(hot.select("row"))
    return kept.select("row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_duplicates(table(spark, sf_dir, "documents"))
