"""Operator 13: source divergence audit.

How far do a language's sources differ in their words, and which terms stand
out in a source? Terms are runs of letters (A-Z lower-cased; every character
beyond ASCII counts as a letter). A language keeps the terms that at least
``MIN_DOCS`` of its documents hold. A group is a language and a source.

Strings are materialized late:

1. Each task counts its documents' terms per group and emits a row for a term
   and group (bounded memory: a full table is emitted and begun anew). The
   rows are stored with the term and a 64-bit digest of (language, term).
2. Only the digests are shuffled to add up document counts. A digest's count
   is never below that of one of its terms, so no kept term is lost here.
3. The strings of the digests that pass are joined back, and each digest's
   minimum and maximum are compared. Where they differ, the digest stands for
   several terms; it is split: its terms are counted again by their strings.
4. Occurrences per group and kept term are added up by digest, too. For the
   report, a group's rows are first cut to those whose value ranks within the
   limit (ties stay), and only these get their strings back for the tie-break.

The digests that pass are broadcast while they are at most ``SMALL``; with
more, the same joins are plain shuffles.

A pair's value is a sum over all kept terms, also those that neither source
holds. Terms are dealt to blocks and sources to tiles; a task adds up one
block for the sources of one pair of tiles, as a matrix of at most about
``BLOCK`` x 2 ``TILE`` numbers. No rows of term and source pair exist.

With count occurrences of a kept term in a group, N of all kept terms there
and V kept terms in the language, p = 1 + floor(10^9 (count + 5) / (N + 5 V)),
in decimals of 38 digits; so all arithmetic is exact.

Cases: null text, lang and source count as ''; a group without terms has
count 0 for every kept term; without kept terms pairs have value 0; a source
that is alone in its language has no pair; repeated rows all count, also as
documents; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popspark.llm.common import staged, table, text_slices

MIN_DOCS, TOP = 30, 50
#: added to every count; what the shares are multiplied by
SMOOTH, SCALE = 5, 1_000_000_000
#: terms that a task counts before it emits them (about 150 bytes each)
HELD = 500_000
#: digests that are broadcast, at most (8 bytes each)
SMALL = 4_000_000
#: terms of a block, sources of a tile, both about
BLOCK, TILE = 4096, 256

#: bytes -> bytes: A-Z to a-z, every other ASCII byte but a-z to a space
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


_PARTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                words = pa.array(list(n), pa.binary()).cast(pa.string())
                own = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*own, words, pa.array(n.values(), pa.int64()), pa.array(list(map(docs.__getitem__, n)), pa.int64())], schema=_PARTS)
        held.clear()

    for batch in batches:
        for part in text_slices(batch, 2):
            langs, sources = part.column(0).to_pylist(), part.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, part.column(2).cast(pa.binary()).to_pylist(), strict=True):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                found = terms(text)
                n.update(found)
                docs.update(set(found))
            if sum(len(n) for n, _ in held.values()) >= HELD:
                yield from rows()
    yield from rows()


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def _digest(bits: int) -> Column:
    """A digest of the language and the term; fewer bits make collisions, for tests."""
    full = F.xxhash64("lang", "term")
    return full if bits >= 64 else F.pmod(full, F.lit(1 << bits))


def _with(left: DataFrame, right: DataFrame, on: list[str], how: str, small: bool) -> DataFrame:
    return left.join(F.broadcast(right) if small else right.hint("merge"), on, how)


class Audit:
    """Counts of kept terms, as frames that are stored or small."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, bits: int = 64):
        docs = _named(docs)
        ddl = "lang string, source string, term string, n long, docs long"
        parts = staged(docs.mapInArrow(_count, ddl).withColumn("digest", _digest(bits)), "audit-parts")
        passed = staged(parts.groupBy("digest").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("digest"), "audit-digests")
        self.small = passed.count() <= SMALL
        # the strings of what passed: one row for a (digest, lang, term), then the extremes of each digest
        strings = _with(parts.select("digest", "lang", "term"), passed, ["digest"], "left_semi", self.small).distinct()
        name = F.struct("lang", "term")
        ends = staged(strings.groupBy("digest").agg(F.min(name).alias("low"), F.max(name).alias("high")), "audit-strings")
        several = F.col("low") != F.col("high")
        clean, mixed = ends.filter(~several), ends.filter(several).select("digest")
        vocabulary = clean.select("digest", F.lit("").alias("split"), "low.lang", "low.term")
        counts = _with(parts.select("digest", "lang", "source", "n"), clean.select("digest"), ["digest"], "left_semi", self.small)
        counts = counts.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n")).withColumn("split", F.lit(""))
        if mixed.count():
            again = _with(parts, mixed, ["digest"], "left_semi", self.small)
            kept = again.groupBy("digest", "lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
            kept = staged(kept.select("digest", F.col("term").alias("split"), "lang", "term"), "audit-split")
            vocabulary = vocabulary.unionByName(kept)
            own = again.withColumn("split", F.col("term")).join(kept.select("digest", "split", "lang"), ["digest", "split", "lang"], "left_semi")
            counts = counts.unionByName(own.groupBy("lang", "source", "digest", "split").agg(F.sum("n").alias("n")))
        #: digest, split ('' or the term itself where a digest has several), lang, term
        self.vocabulary = vocabulary
        counts = staged(counts, "audit-counts")
        sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
        groups = docs.select("lang", "source").distinct()
        total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        zero = F.lit(0).cast("long")
        #: lang, source, total (N), v (V), base (p of a term that the group doesn't hold)
        self.groups = staged(
            groups.join(total, ["lang", "source"], "left").join(sizes, "lang", "left").withColumns({"total": F.coalesce("total", zero), "v": F.coalesce("v", zero)}).withColumn("base", share(zero)),
            "audit-groups",
        )
        #: lang, source, digest, split, n, p; only where n > 0
        self.counts = counts.join(self.groups, ["lang", "source"]).withColumn("p", share(F.col("n"))).drop("total", "v", "base")

    def pairs(self) -> DataFrame:
        """lang, source, item (the other source), value, rank."""
        dealt = self.groups.groupBy("lang").agg(F.max("v").alias("v"), F.count(F.lit(1)).alias("s"))
        dealt = dealt.select("lang", (F.floor(F.col("v") / BLOCK) + 1).alias("blocks"), F.ceil(F.col("s") / TILE).alias("tiles"))
        tile = F.pmod(F.xxhash64("source"), F.col("tiles")).alias("tile")
        block = F.pmod(F.xxhash64("digest", "split"), F.col("blocks"))
        groups = self.groups.join(dealt, "lang").select("lang", "source", "base", "blocks", "tiles", tile)
        sizes = self.vocabulary.join(dealt, "lang").groupBy("lang", block.alias("block")).agg(F.count(F.lit(1)).alias("terms"))
        every = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        every = every.join(sizes, ["lang", "block"], "left").withColumn("terms", F.coalesce("terms", F.lit(0).cast("long")))
        none = {"digest": F.lit(None).cast("long"), "split": F.lit(None).cast("string"), "p": F.lit(None).cast("long")}
        columns = ["lang", "block", "tile", "tiles", "source", "base", "terms", "digest", "split", "p"]
        marks = every.withColumns(none).select(*columns)
        body = self.counts.join(dealt, "lang").withColumns({"tile": tile, "block": block, "base": F.lit(None).cast("long"), "terms": F.lit(None).cast("long")}).select(*columns)
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
        dealt_rows = marks.unionByName(body).withColumn("other", other)
        dealt_rows = dealt_rows.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")}).drop("other", "tiles")
        sums = dealt_rows.groupBy("lang", "block", "a", "b").applyInPandas(_distances, "lang string, one string, two string, value long")
        value = sums.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
        both = value.select("lang", F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item")))).alias("x"), "value")
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return both.select("lang", "x.source", "x.item", "value").withColumn("rank", F.row_number().over(ranked))

    def standing_out(self, top: int = TOP) -> DataFrame:
        """lang, source, item (a term whose share is above the language's), value, rank; ranks to ``top``."""
        whole = self.counts.groupBy("lang", "digest", "split").agg(F.sum("n").alias("n"))
        langs = self.groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
        q = whole.join(langs, "lang").select("lang", "digest", "split", share(F.col("n")).alias("q"))
        above = self.counts.join(q, ["lang", "digest", "split"]).filter(F.col("p") > F.col("q")).withColumn("value", F.col("p") - F.col("q"))
        group = Window.partitionBy("lang", "source")
        near = above.withColumn("place", F.rank().over(group.orderBy(F.desc("value")))).filter(F.col("place") <= top)
        named = near.join(self.vocabulary.select("digest", "split", "lang", F.col("term").alias("item")), ["digest", "split", "lang"])
        rank = F.row_number().over(group.orderBy(F.desc("value"), "item"))
        return named.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "source", "item", "value", "rank")


def share(count: Column) -> Column:
    """p, from ``count`` and the columns total and v; 0 where the language keeps no term."""
    over = (F.col("total").cast("decimal(20,0)") + F.lit(SMOOTH).cast("decimal(2,0)") * F.col("v").cast("decimal(18,0)")).cast("decimal(22,0)")
    times = (count.cast("decimal(20,0)") + F.lit(SMOOTH).cast("decimal(2,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(F.col("v") > 0, F.lit(1).cast("long") + F.call_function("div", times, over)).otherwise(F.lit(0).cast("long"))


def _distances(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over one block of terms of |p - q|, for each pair of a source of tile a and one of tile b."""
    marks, body = rows[rows["base"].notna()], rows[rows["base"].isna()]
    lang, a, b = rows["lang"].iloc[0], int(rows["a"].iloc[0]), int(rows["b"].iloc[0])
    names = marks["source"].to_numpy()
    tiles = marks["tile"].to_numpy(np.int64)
    base = marks["base"].to_numpy(np.int64)
    place = {s: i for i, s in enumerate(names)}
    term = body.groupby(["digest", "split"], sort=False).ngroup().to_numpy()
    width = int(term.max()) + 1 if len(term) else 0
    p = np.repeat(base[:, None], width, 1)
    p[body["source"].map(place).to_numpy(np.int64), term] = body["p"].to_numpy(np.int64)
    absent = int(marks["terms"].iloc[0]) - width  # terms of the block that none of these sources holds
    one, two, value = [], [], []
    order = np.argsort(tiles, kind="stable")
    for at, i in enumerate(order):
        if tiles[i] != a:
            continue
        others = order[at + 1 :] if a == b else order[tiles[order] == b]
        far = np.abs(p[others] - p[i]).sum(1) + absent * np.abs(base[others] - base[i])
        one += [names[i]] * len(others)
        two += names[others].tolist()
        value += far.tolist()
    return pd.DataFrame({"lang": pd.Series([lang] * len(one), dtype=object), "one": pd.Series(one, dtype=object), "two": pd.Series(two, dtype=object), "value": pd.Series(value, dtype=np.int64)})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    found = Audit(docs, min_docs, bits)
    parts = {"pair": found.pairs(), "term": found.standing_out(top)}
    pair, term = (df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in parts.items())
    return pair.unionByName(term)


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN kept USING (lang)
          LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) USING (lang, source, term)),
gp AS (SELECT lang, source, term, n, 1 + (CAST({SCALE} AS HUGEINT) * (n + {SMOOTH})) //
         CAST(sum(n) OVER (PARTITION BY lang, source) + {SMOOTH} * count(*) OVER (PARTITION BY lang, source) AS HUGEINT) AS p FROM cells),
lc AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL),
lp AS (SELECT lang, term, 1 + (CAST({SCALE} AS HUGEINT) * (n + {SMOOTH})) //
         CAST(sum(n) OVER (PARTITION BY lang) + {SMOOTH} * count(*) OVER (PARTITION BY lang) AS HUGEINT) AS q FROM lc),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
