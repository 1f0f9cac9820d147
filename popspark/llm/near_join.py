"""Operator 6: n-gram Jaccard join with several global orders.

A document is the set of its distinct 5-word shingles, as 64-bit hashes. Two
documents link when 100 * intersection >= 80 * union; the result is the
component that each document's links lead to.

How the work is cut:

1. ``_gather`` turns whole texts into batches of shingle postings, dealt by
   hash range. A shingle that several documents of a batch share is sent once,
   with a count, so a shingle that a third of all documents hold costs a range
   one row a batch.
2. ``_count`` finds each shingle's document frequency in its range, and
   answers the batches with the shingles that at least two documents hold.
   Only those can be common to two documents.
3. ``_home`` puts a document's shared shingles together. Under an order by
   rising frequency a document whose prefix (size - needed overlap + 1) holds
   no shared shingle has no partner, and is done. The others are candidates.
4. Equal sets become one class. Classes that meet in a prefix bucket of the
   first order are joined by a star to the bucket's smallest class; the
   components of those stars are closed under linking. The stars are as many
   as the postings, never the pairs of a bucket.
5. Each such component is verified. A pair passes the length filter, must
   share a prefix shingle under every one of the global orders, and then its
   overlap is counted exactly. A component of more than ``BLOCK`` classes is
   first compared with one pivot; classes linked to the pivot are already one
   component, so only the rest is compared, block by block, with all blocks.

Every order is a function of (frequency, hash) alone, so each is a global
order and no filter loses a link.

Cases: a text without words is an empty set, linked with nothing. A row with
a null id has its set counted, links with nothing and has a null component.
Rows with equal id and text are one document. The input should be a stored
table: a task that runs again must see its rows in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import SPACE_BYTES, UPPER, LOWER, shuffle_partitions, staged, table

N = 5
#: links need 100 * intersection >= PERCENT * union
PERCENT = 80
#: postings and documents of a batch, and classes of a block
BATCH_POSTINGS, BATCH_DOCS, BLOCK = 1_000_000, 30_000, 256
#: dropped documents whose keys are broadcast; more are joined by a shuffle
BROADCAST_KEYS = 200_000
ORDERS = 3
_LOW = np.uint64((1 << 48) - 1)
_PIECE = 2_000_000  # bytes hashed at a time

_SPLIT = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"
ORACLE = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], chr(10)) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id
FROM doc LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) r ON r.a = doc.doc_id
"""


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x * np.uint64((0x9E3779B97F4A7C15 + 2 * seed) & (2**64 - 1))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**63, N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.cumprod(np.full(1 << 12, 0x5851F42D4C957F2D, np.uint64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of the words (between spaces) of translated bytes, a bounded piece at a time."""
    global _POWERS
    hashes, starts, at = [], [], 0
    while at < len(data):
        stop = len(data)
        if stop - at > _PIECE and (cut := data.find(b" ", at + _PIECE)) >= 0:
            stop = cut + 1
        raw = np.frombuffer(data, np.uint8, stop - at, at)
        word = raw != 32
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        first, size = edge[::2], edge[1::2] - edge[::2]
        if len(first):
            if size.max() > len(_POWERS):
                _POWERS = np.cumprod(np.full(2 * int(size.max()), _POWERS[0], np.uint64))
            offset = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(offset, size)
            hashes.append(_mix(np.add.reduceat(_BYTE[raw[word]] * _POWERS[place], offset), 1))
            starts.append(first + at)
        at = stop
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    parts = [t.encode().translate(SPACE_BYTES) for t in texts]
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
    h, starts = word_hashes(b" ".join(parts))
    bounds = np.searchsorted(starts, offsets)
    full = len(h) - N + 1
    whole = _mix(sum((h[k : k + full] * _PLACE[k] for k in range(1, N)), h[:full] * _PLACE[0]), 2) if full > 0 else h[:0]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= N:
            out.append(np.unique(whole[a : b - N + 1]))
        elif b > a:
            out.append(_mix((h[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a), 3))
        else:
            out.append(h[:0])
    return out


_ROW = "dest int, batch long, kind int, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
_FIELDS = pa.schema([("dest", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), *((x, pa.binary()) for x in "abcdefg")])
_NULL_ID = np.iinfo(np.int64).max


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _FIELDS, strict=True)], schema=_FIELDS)


def _six(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _gather(bits: int):
    """Texts to postings by hash range (kind 1), and what stays with the batch (kind 0)."""

    def flush(batch: int, ids: list, sums: list, sets: list) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(s) for s in sets], np.int64)
        all_ = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype="<u2"), sizes)
        all_ = ((all_ >> np.uint64(64 - bits)) << np.uint64(48)) | (all_ & _LOW)
        order = np.argsort(all_, kind="stable")
        tok, owner = all_[order], owner[order]
        head = np.flatnonzero(np.concatenate(([True], tok[1:] != tok[:-1]))) if len(tok) else np.empty(0, np.int64)
        count = np.diff(np.append(head, len(tok)))
        uniq, one = tok[head], count == 1
        cuts = np.searchsorted(uniq, np.arange(1 << bits, dtype=np.uint64) << np.uint64(48))
        cuts = np.append(cuts, len(uniq))
        lone = np.zeros(len(tok), bool)
        lone[head[one]] = True
        digests = b"".join(hashlib.md5(s.tobytes()).digest() for s in sets)
        dest = batch & ((1 << bits) - 1)
        out = [(dest, batch, 0, np.array(ids, "<i8").tobytes(), sizes.astype("<u4").tobytes(), digests, owner[~lone].tobytes(), uniq[~one].astype("<u8").tobytes(), count[~one].astype("<u2").tobytes(), b"".join(sums))]
        for r in range(1 << bits):
            lo, hi = cuts[r], cuts[r + 1]
            if hi > lo:
                u, c, w = uniq[lo:hi], count[lo:hi], one[lo:hi]
                out.append((r, batch, 1, _six(u[w]), owner[head[lo:hi][w]].tobytes(), _six(u[~w]), c[~w].astype("<u2").tobytes(), None, None, None))
        yield _rows(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch = TaskContext.get().partitionId() << 32
        ids, sums, sets, size = [], [], [], 0
        for rb in batches:
            texts = [t or "" for t in rb.column(1).to_pylist()]
            own = rb.column(0).to_pylist()
            start, chars = 0, 0
            for i, t in enumerate(texts):
                chars += len(t)
                if chars < _PIECE and i + 1 < len(texts):
                    continue
                for j, s in enumerate(shingle_sets(texts[start : i + 1]), start):
                    if len(ids) >= BATCH_DOCS or size and size + len(s) > BATCH_POSTINGS:
                        yield from flush(batch, ids, sums, sets)
                        batch, ids, sums, sets, size = batch + 1, [], [], [], 0
                    ids.append(_NULL_ID if own[j] is None else own[j])
                    sums.append(hashlib.md5(texts[j].encode()).digest())
                    sets.append(s)
                    size += len(s)
                start, chars = i + 1, 0
        if ids:
            yield from flush(batch, ids, sums, sets)

    return run


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for rb in batches:
        yield from zip(*(c.to_pylist() for c in rb.columns), strict=True)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequency of a range's shingles, sent back (kind 2) for those that two documents hold."""
    for dest, rows in groupby(_stream(batches), key=lambda r: r[0]):
        post = []
        for r in rows:
            if r[2] == 0:
                yield _rows([r])
            else:
                post.append(r)
        if not post:
            continue
        ones, many = [_from_six(r[3]) for r in post], [_from_six(r[5]) for r in post]
        tok = np.concatenate([*ones, *many])
        weight = np.concatenate([np.ones(sum(map(len, ones))), *(np.frombuffer(r[6], "<u2") for r in post)])
        _, inverse = np.unique(tok, return_inverse=True)
        df = np.minimum(np.bincount(inverse, weights=weight), 65535).astype("<u2")[inverse]
        at, at_many = 0, sum(map(len, ones))
        for r, o, m in zip(post, ones, many, strict=True):
            own, at = df[at : at + len(o)], at + len(o)
            other, at_many = df[at_many : at_many + len(m)], at_many + len(m)
            shared = own > 1
            yield _rows([(dest, r[1], 2, np.frombuffer(r[4], "<u2")[shared].tobytes(), _six(o[shared]), own[shared].tobytes(), other.tobytes(), None, None, None)])


def needed(size: int) -> int:
    """The least overlap of a set of this size with any partner."""
    return -(-PERCENT * size // 100)


def prefix(tokens: np.ndarray, dfs: np.ndarray, size: int, order: int) -> np.ndarray:
    """The shared shingles in the prefix of a set under one of the global orders.

    All orders put shingles that only one document holds first; those take
    size - len(tokens) places of the prefix.
    """
    room = size - needed(size) + 1 - (size - len(tokens))
    if room <= 0:
        return tokens[:0]
    rank = dfs if order < 2 else np.frexp(dfs.astype(np.float64))[1]  # the last order by the number of bits
    return tokens[np.lexsort((_mix(tokens, 10 + order), rank))[:room]]


def _home(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document; candidates carry their shared shingles and the frequencies."""
    names = ["doc_id", "text_md5", "n_shingles", "digest", "tokens", "dfs"]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    for _, rows in groupby(_stream(batches), key=lambda r: r[1]):
        head, *answers = rows
        ids, sizes = np.frombuffer(head[3], "<i8"), np.frombuffer(head[4], "<u4").astype(np.int64)
        owner, many = np.frombuffer(head[6], "<u2"), np.frombuffer(head[7], "<u8")
        times = np.frombuffer(head[8], "<u2")
        many_df = np.concatenate([np.frombuffer(r[6], "<u2") for r in answers]) if answers else times
        idx = np.concatenate([owner, *(np.frombuffer(r[3], "<u2") for r in answers)])
        tok = np.concatenate([np.repeat(many, times), *(_from_six(r[4]) | np.uint64(r[0] << 48) for r in answers)])
        df = np.concatenate([np.repeat(many_df, times), *(np.frombuffer(r[5], "<u2") for r in answers)])
        order = np.lexsort((tok, idx))
        tok, df = tok[order], df[order]
        cut = np.searchsorted(idx[order], np.arange(len(ids) + 1))
        cols: list[list] = [[] for _ in names]
        for i, (id_, size) in enumerate(zip(ids.tolist(), sizes.tolist(), strict=True)):
            t = tok[cut[i] : cut[i + 1]]
            may = id_ != _NULL_ID and len(t) and len(t) >= needed(size)
            cols[0].append(None if id_ == _NULL_ID else id_)
            cols[1].append(head[9][16 * i : 16 * i + 16])
            cols[2].append(size)
            cols[3].append(head[5][16 * i : 16 * i + 16])
            cols[4].append(t.tobytes() if may else None)
            cols[5].append(df[cut[i] : cut[i + 1]].tobytes() if may else None)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def shingle_table(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """doc_id, text_md5, n_shingles, digest (of the set), tokens and dfs (candidates only); stored."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    bits = max(1, min(16, (4 * parts - 1).bit_length()))  # several ranges a partition even out
    src = docs.select(F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    posts = src.mapInArrow(_gather(bits), _ROW).repartition(parts, "dest").sortWithinPartitions("dest", "batch")
    answers = posts.mapInArrow(_count, _ROW).repartition(parts, "batch").sortWithinPartitions("batch", "kind", "dest")
    rows = answers.mapInArrow(_home, "doc_id long, text_md5 binary, n_shingles long, digest binary, tokens binary, dfs binary")
    return staged(rows, "shingles")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b) but the labels: the smallest node it reaches.

    Alternates large-star and small-star steps until the edges stay the same.
    The lowest neighbours are stored before they are joined back: both sides
    of the join are then plain shuffles, and Spark can split a hub's partition.
    """
    turned = lambda e: e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, before = staged(turned(edges), "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "lowest")
        large = turned(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = staged(large, "large-star")
        low = staged(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(low, "a").select("b", "m").union(low.select("a", "m")).toDF("a", "b")
        edges = staged(turned(small), "edges")


_MEMBER = ["digest", "n_shingles", "tokens", "dfs"]


def _postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix shingles of each class under the first order."""
    for rb in batches:
        found = [prefix(np.frombuffer(t, "<u8"), np.frombuffer(d, "<u2"), n, 0) for _, n, t, d in zip(*(c.to_pylist() for c in rb.columns), strict=True)]
        sizes = np.array([len(x) for x in found], np.int64)
        which = np.repeat(np.arange(len(found)), sizes)
        tokens = np.concatenate([*found, np.empty(0, np.uint64)]).astype("<u8").view("<i8")
        yield pa.RecordBatch.from_arrays([pa.array(tokens), rb.column(0).take(pa.array(which))], names=["token", "digest"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a bounded number of sets."""
    m = len(sets)
    tok, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    shared = count[inverse] > 1
    column = (np.cumsum(count > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((m, m), np.float32)
    step = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, (lo, lo + step))
        x = np.zeros((m, step), np.float32)
        x[owner[a:b], column[a:b] - lo] = 1
        out += x @ x.T
    return out


def linked(sizes: np.ndarray, tokens: list[np.ndarray], dfs: list[np.ndarray]) -> np.ndarray:
    """Which pairs of a bounded group link: length and prefix filters, then exact overlaps."""
    may = PERCENT * np.maximum.outer(sizes, sizes) <= 100 * np.minimum.outer(sizes, sizes)
    for order in range(ORDERS):
        if not np.triu(may, 1).any():
            return np.zeros_like(may)
        may &= _overlaps([prefix(t, d, int(n), order) for t, d, n in zip(tokens, dfs, sizes, strict=True)]) > 0
    common = _overlaps(tokens).astype(np.int64)
    return may & (100 * common >= PERCENT * (np.add.outer(sizes, sizes) - common))


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the classes of each group (first column), at most one less than it has classes."""
    for _, rows in groupby(_stream(batches), key=lambda r: r[0]):
        rows = list({r[1]: r for r in rows}.values())
        if len(rows) < 2:
            continue
        link = linked(np.array([r[2] for r in rows]), [np.frombuffer(r[3], "<u8") for r in rows], [np.frombuffer(r[4], "<u2") for r in rows])
        left, a, b = set(range(len(rows))), [], []
        while left:
            todo = [left.pop()]
            while todo:
                i = todo.pop()
                for j in np.flatnonzero(link[i]).tolist():
                    if j in left:
                        left.remove(j)
                        todo.append(j)
                        a.append(rows[i][1])
                        b.append(rows[j][1])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _with_pivot(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each group's pivot, which is its first row, with the others."""
    for _, rows in groupby(_stream(batches), key=lambda r: r[0]):
        pivot = next(rows)
        size, tokens, out = pivot[3], np.frombuffer(pivot[4], "<u8"), []
        for r in rows:
            common = len(np.intersect1d(tokens, np.frombuffer(r[4], "<u8"), assume_unique=True))
            if 100 * common >= PERCENT * (size + r[3] - common):
                out.append(r[2])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array([pivot[2]] * len(out), pa.binary())], names=["a", "b"])


def _links(classes: DataFrame) -> DataFrame:
    """(a, b): links between class digests that join everything that links."""
    spark = classes.sparkSession
    parts = shuffle_partitions(spark)
    posts = staged(classes.select(*_MEMBER).mapInArrow(_postings, "token long, digest binary"), "postings")
    low = staged(posts.groupBy("token").agg(F.min("digest").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "lowest")
    stars = posts.join(low, "token").filter("digest <> low").select(F.col("digest").alias("a"), F.col("low").alias("b")).distinct()
    near = components(stars)
    near = near.unionByName(near.select(F.col("label").alias("node"), "label").distinct())
    size = staged(near.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "sizes")
    members = staged(classes.select(*_MEMBER).join(near.join(size, "label"), F.col("digest") == F.col("node")).drop("node"), "members")

    def verified(grouped: DataFrame) -> DataFrame:
        return grouped.select("group", *_MEMBER).repartition(parts, "group").sortWithinPartitions("group", "digest").mapInArrow(_verify, "a binary, b binary")

    small = verified(members.filter(F.col("size") <= BLOCK).withColumn("group", F.hex("label")))
    big = members.filter(F.col("size") > BLOCK)
    if big.isEmpty():
        return small
    # the pivot of a large component is its label; it goes to all salts of its component
    salts = F.ceil(F.col("size") / BLOCK).cast("int")
    is_pivot = F.col("digest") == F.col("label")
    salt = F.pmod(F.xxhash64("digest"), salts).cast("int")
    own = F.when(is_pivot, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(salt))
    salted = big.select(F.explode(own).alias("salt"), "label", is_pivot.alias("pivot"), *_MEMBER)
    salted = salted.select(F.concat_ws("-", F.hex("label"), "salt").alias("group"), "pivot", *_MEMBER)
    star = staged(salted.repartition(parts, "group").sortWithinPartitions("group", F.desc("pivot"), "digest").mapInArrow(_with_pivot, "a binary, b binary"), "pivot-links")
    # the rest is compared with all blocks
    core = big.join(star.select(F.col("a").alias("digest")), "digest", "left_semi").unionByName(big.filter(is_pivot))
    rest = big.join(star.select(F.col("a").alias("digest")), "digest", "left_anti").filter(~is_pivot)
    n_core = core.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("cores"))
    n_rest = rest.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("rests"))
    counts = staged(n_core.join(n_rest, "label"), "block-counts")
    block = lambda n: F.pmod(F.xxhash64("digest"), F.col(n)).cast("int")
    name = lambda *xs: F.concat_ws("-", F.hex("label"), *xs)
    up_to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    of_rest = F.concat(
        F.transform(up_to("rests"), lambda j: F.struct(F.least("own", j).alias("x"), F.greatest("own", j).cast("string").alias("y"))),
        F.transform(up_to("cores"), lambda j: F.struct(F.col("own").alias("x"), F.concat(F.lit("c"), j.cast("string")).alias("y"))),
    )
    of_core = F.transform(up_to("rests"), lambda j: F.struct(j.alias("x"), F.concat(F.lit("c"), F.col("own").cast("string")).alias("y")))
    blocks = (
        rest.join(counts, "label").withColumn("own", block("rests")).withColumn("to", F.explode(of_rest))
        .unionByName(core.join(counts, "label").withColumn("own", block("cores")).withColumn("to", F.explode(of_core)))
        .withColumn("group", name("to.x", "to.y"))
    )
    return small.unionByName(star).unionByName(verified(blocks))


def jaccard_components(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """doc_id, text_md5, n_shingles and component_id, one row per document."""
    rows = shingle_table(docs, text, id_)
    may = rows.filter(F.col("tokens").isNotNull())
    classes = staged(
        may.groupBy("digest", "n_shingles").agg(F.min(F.struct("doc_id", "tokens", "dfs")).alias("low")).select("digest", "n_shingles", F.col("low.doc_id").alias("rep"), "low.tokens", "low.dfs"),
        "classes",
    )
    label = components(_links(classes))
    labelled = classes.select("digest", "rep").join(label, F.col("digest") == F.col("node"), "left").select("digest", "rep", F.coalesce("label", "digest").alias("label"))
    lowest = staged(labelled.groupBy("label").agg(F.min("rep").alias("component_id")), "lowest-ids")
    of_class = staged(labelled.join(lowest, "label").select("digest", "component_id"), "components")
    narrow = rows.select("doc_id", "text_md5", "n_shingles", "digest", F.col("tokens").isNotNull().alias("may"))
    alone = narrow.filter(~F.col("may")).select("doc_id", "text_md5", "n_shingles", F.col("doc_id").alias("component_id"))
    return narrow.filter("may").join(of_class, "digest").select("doc_id", "text_md5", "n_shingles", "component_id").unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of the document with the smallest id of each component, with all their columns."""
    member = jaccard_components(docs).filter("doc_id <> component_id")
    gone = staged(member.select("doc_id", F.hex("text_md5").alias("md5")).distinct(), "dropped")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone
    md5 = F.upper(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
    return docs.join(gone, (docs["doc_id"] == gone["doc_id"]) & (md5 == gone["md5"]), "left_anti")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
