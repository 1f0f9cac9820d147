"""Operator 9: benchmark decontamination by Wu-Manber multi-pattern search.

The patterns are the windows of the benchmark items: 13 consecutive words, or
all words of a shorter item. The alphabet is words, so patterns of one length
m form one table. For a block of B words that ends at the search position, the
shift table says how far the search may skip: a word that no pattern holds
skips the m words it could touch, a block that no pattern holds skips
m - B + 1. A shift of 0 leads to the bucket of the patterns that end with this
block, and a direct comparison of all m words confirms an occurrence.

The pattern set goes to every task. Its size is checked: it is cut into blocks
of at most ``max_windows`` windows, each block searches all documents, and the
blocks' hits are merged per document.

Cases: a null or empty text has no words and no hit; an item without words
has no window; items with equal windows all count; items without an id are
searched like others, count as one item and are left out of the list of ids;
repeated rows are each judged; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import WORD_BYTES, per_text, table, words

WINDOW = 13
#: windows that one pass over the documents searches for (about 300 bytes each)
MAX_WINDOWS = 200_000
#: a document is contaminated when at least one word in this many is hit
ONE_IN = 20

_WORDS_SQL = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
WITH item AS (SELECT item_id, {_WORDS_SQL.format("text")} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, coalesce({_WORDS_SQL.format("text")}, []) AS w FROM documents),
spot AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS key
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM doc, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
occ AS (SELECT doc_id, i, win.m, item_id FROM spot JOIN win USING (m, key)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM occ) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


class WuManber:
    """Finds all places of patterns that are ``m`` numbers long in a list of numbers."""

    def __init__(self, patterns: Iterable[tuple[int, ...]], m: int):
        self.m = m
        self.b = b = min(3, m)
        self.far = m - b + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.bucket: dict[tuple[int, ...], set[tuple[int, ...]]] = {}
        for p in patterns:
            for end in range(b, m + 1):
                block = p[end - b : end]
                self.shift[block] = min(self.shift.get(block, self.far), m - end)
            self.bucket.setdefault(p[m - b :], set()).add(p)

    def find(self, seq: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(start, pattern) of every occurrence; 0 stands for a word that no pattern holds."""
        m, b, far, shift, bucket = self.m, self.b, self.far, self.shift, self.bucket
        i, n = m, len(seq)  # i: end of the place that is looked at
        while i <= n:
            if not seq[i - 1]:
                i += m
                continue
            block = tuple(seq[i - b : i])
            skip = shift.get(block, far)
            if skip:
                i += skip
                continue
            place = tuple(seq[i - m : i])
            if place in bucket[block]:
                yield i - m, place
            i += 1


class Matcher:
    """The Wu-Manber tables of a set of windows, one for each length."""

    def __init__(self, windows: list[tuple[str | None, list[str]]]):
        """windows: (item id, words)."""
        self.number: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], set[str | None]] = {}
        lengths: dict[int, set[tuple[int, ...]]] = {}
        for item, ws in windows:
            key = tuple(self.number.setdefault(w.encode(), len(self.number) + 1) for w in ws)
            self.items.setdefault(key, set()).add(item)
            lengths.setdefault(len(key), set()).add(key)
        self.tables = [WuManber(sorted(p), m) for m, p in sorted(lengths.items())]

    def search(self, text: str) -> tuple[int, list[int], list[str | None]]:
        """Number of words; merged [start, end) pairs, flat; item ids, a missing one last."""
        ws = text.encode().translate(WORD_BYTES).split()
        number = self.number.get
        seq = [number(w, 0) for w in ws]
        spans: list[tuple[int, int]] = []
        found: set[str | None] = set()
        for t in self.tables:
            for start, place in t.find(seq):
                spans.append((start, start + t.m))
                found |= self.items[place]
        return len(ws), merged(spans), sorted(found, key=lambda x: (x is None, x))


def merged(spans: Iterable[tuple[int, int]]) -> list[int]:
    """Disjoint spans in order, as a flat list of starts and ends."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, words): the windows of every item, as many rows as the items have words at most."""

    def cut(texts: list[str]) -> dict[str, list]:
        out = []
        for t in texts:
            ws = [w.decode() for w in words(t)]
            out.append([ws[i : i + size] for i in range(max(len(ws) - size + 1, 1))] if ws else [])
        return {"windows": out}

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    cut_items = per_text(items, ["item"], "text", cut, "windows array<array<string>>")
    return cut_items.select("item", F.explode("windows").alias("words")).distinct()


def search_documents(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """``keep``, n_words, spans (flat starts and ends of the hit words) and items, one row per document."""
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark)
    blocks = -(-windows.count() // max_windows) or 1
    of_block = F.pmod(F.xxhash64("words"), F.lit(2 * blocks if blocks > 1 else 1))

    def scan(block: int, src: DataFrame, columns: list[str]) -> DataFrame:
        part = windows.filter(of_block == block).collect()
        shared = spark.sparkContext.broadcast([(r.item, r.words) for r in part])
        made: list[Matcher] = []

        def search(texts: list[str]) -> dict[str, list]:
            if not made:
                made.append(Matcher(shared.value))
            n, spans, items = zip(*map(made[0].search, texts), strict=True)
            return {"n_words": list(n), "spans": list(spans), "items": list(items)}

        return per_text(src, columns, text, search, "n_words long, spans array<long>, items array<string>")

    if blocks == 1:
        return scan(0, docs, list(keep))
    # one pass for each block; a row is named by its kept columns and its text's digest, equal rows are counted
    named = docs.select(*keep, text, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("__sha"))
    key = [*keep, "__sha", "n_words"]
    hits = None
    for block in range(2 * blocks):
        own = scan(block, named, [*keep, "__sha"]).groupBy(*key).agg(F.first("spans").alias("spans"), F.first("items").alias("items"), F.count(F.lit(1)).alias("__n"))
        hits = own if hits is None else hits.unionByName(own)
    join_spans = F.udf(lambda flat: merged(zip(flat[::2], flat[1::2], strict=True)), "array<long>", useArrow=True)
    both = hits.groupBy(*key).agg(
        join_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("__n").alias("__n"),
    )
    return both.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*keep, "n_words", "spans", "items")


def n_hit() -> Column:
    """Hit words of a row of search_documents."""
    add = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(add, F.lit(0).cast("long"), lambda a, x: a + x)


def judged(found: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated to the rows of search_documents."""
    return found.withColumn("n_hit", n_hit()).withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of the documents that aren't contaminated, with all their columns."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    return judged(search_documents(row, benchmark, ("row",))).filter(~F.col("contaminated")).select("row.*")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )
