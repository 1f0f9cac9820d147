"""Operator 1: byte-level BPE encoding and decoding.

A text is cut into pieces by a pattern, and each piece is encoded on its own.
A segment tree over the byte positions of a piece stores in each node the
leftmost minimum pair rank below it. A merge reads the root, and writes at
most three leaves (the merged token's pair, its left neighbour's pair, and the
swallowed token's pair, which ends), each a logarithmic point update; live
neighbours are kept in two arrays. A piece of n bytes takes O(n log n), so one
piece of a million bytes is no problem. Pieces of up to 65 bytes, nearly all,
have their trees side by side in one numpy array: a step merges one pair of
every piece that has one left.

Pieces between single spaces repeat, so a batch's distinct stretches are
encoded once, and a bounded cache per Python worker keeps their ids. The cache
only saves work: when it is full it takes no more (frequent stretches come
early), and results don't depend on it.

Cases: a null text is an empty one, with no ids; repeated rows give repeated
rows; null ids stay null; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import per_text, table, worker_file

VOCABULARY = "byte_bpe_50k.tiktoken"
#: stretches that a worker's cache holds (about 200 bytes each)
CACHE_LIMIT = 150_000
_NONE = 1 << 62
#: leaves of the trees that stand side by side; a larger piece has a tree of its own
WIDTHS = (8, 16, 32, 64)
_EMPTY = np.int32((1 << 31) - 1)


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the lowest-ranked pair, leftmost among equals, merges first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << max(n - 2, 0).bit_length()
    shift = size.bit_length()
    mask = (1 << shift) - 1
    tree = [_NONE] * (2 * size)  # a node: rank << shift | position, so the minimum is the leftmost
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << shift | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    end = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n))  # where the token left of the one that starts here starts

    get = ranks.get
    while (top := tree[1]) != _NONE:
        i = top & mask
        j = end[i]
        stop = end[i] = end[j]
        before[stop] = i
        changes = [(j, _NONE)] if j < n - 1 else []
        rank = get(piece[i : end[stop]]) if stop < n else None
        changes.append((i, _NONE if rank is None else rank << shift | i))
        if i:
            left = before[i]
            rank = get(piece[left:stop])
            changes.append((left, _NONE if rank is None else rank << shift | left))
        for leaf, low in changes:
            k = size + leaf
            if tree[k] == low:
                continue
            tree[k] = low
            while k > 1:
                other = tree[k ^ 1]
                k >>= 1
                if other < low:
                    low = other
                if tree[k] == low:
                    break
                tree[k] = low
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Pairs:
    """(left id, right id) -> id of the merged token, as a hash table that numpy looks up many pairs in."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, _EMPTY, np.int32)
        keys, merged = np.array(keys, np.int64), np.array(merged, np.int32)
        slot = self._slot(keys)
        while len(keys):  # those that find their slot free take it (one of equals), the others move on
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]
            mine = self.keys[slot] == keys
            self.merged[slot[mine]] = merged[mine]
            keys, merged, slot = keys[~mine], merged[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``_EMPTY`` where a pair has none."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.merged[slot], _EMPTY)
        lost = np.flatnonzero((there != keys) & (there != -1))
        slot = slot[lost]
        while len(lost):  # another pair's slot: look at the next one
            slot = (slot + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot]
            hit = there == keys[lost]
            out[lost[hit]] = self.merged[slot[hit]]
            on = ~hit & (there != -1)
            lost, slot = lost[on], slot[on]
        return out


class ByteBpe:
    """Encoder and decoder over one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pairs = Pairs(ranks)
        self.of_byte = np.array([ranks.get(bytes([c]), 0) for c in range(256)], np.int32)
        self.numbers = _Stretches()
        self.values: list[bytes | None] = []  # ids of a stretch, by its number

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = struct.pack("<I", whole)
            elif len(piece) - 1 > WIDTHS[-1]:
                ids = merge_piece(piece, self.ranks)
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
            elif piece:
                groups.setdefault(next(w for w in WIDTHS if len(piece) - 1 <= w), []).append(i)
        for width, own in groups.items():
            for i, ids in zip(own, self._merge_trees([pieces[i] for i in own], width), strict=True):
                out[i] = ids
        return out

    def _merge_trees(self, pieces: list[bytes], width: int) -> list[bytes]:
        """``merge_piece`` for pieces of at most ``width`` + 1 bytes, one merge of every piece in a step.

        Row r of every array belongs to piece r. A node holds rank << shift |
        position, and node k's children are 2 k and 2 k + 1.
        """
        many, size = len(pieces), np.array([len(p) for p in pieces])
        stride, shift = width + 2, width.bit_length()
        mask = (1 << shift) - 1
        data = np.frombuffer(b"".join(p.ljust(stride, b"\0") for p in pieces), np.uint8).reshape(many, stride)
        token = self.of_byte[data]
        at = np.arange(stride)
        token_at, after, before = token.ravel(), np.tile(at + 1, many), np.tile(at - 1, many)
        alive = at < size[:, None]
        leaves = self.pairs.find(token[:, :width].ravel(), token[:, 1 : width + 1].ravel()).reshape(many, width).astype(np.int64)
        leaves = np.where((at[:width] < size[:, None] - 1) & (leaves != _EMPTY), leaves << shift | at[:width], _NONE)
        tree = np.empty((many, 2 * width), np.int64)
        tree[:, width:] = leaves
        k = width
        while k > 1:
            np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2], out=tree[:, k // 2 : k])
            k //= 2
        node, alive_at = tree.ravel(), alive.ravel()
        rows = np.arange(many)
        while True:
            top = node[rows * (2 * width) + 1]
            live = top != _NONE
            rows, top = rows[live], top[live]
            if not len(rows):
                break
            base, i, merged = rows * stride, top & mask, (top >> shift).astype(np.int32)
            j = after[base + i]
            stop = after[base + j]
            token_at[base + i] = merged
            alive_at[base + j] = False
            after[base + i] = stop
            before[base + stop] = i
            # new pairs: with the token behind, and with the token before
            right = self.pairs.find(merged, token_at[base + np.minimum(stop, stride - 1)]).astype(np.int64)
            right = np.where((stop < size[rows]) & (right != _EMPTY), right << shift | i, _NONE)
            left = before[base + i]
            front = self.pairs.find(token_at[base + np.maximum(left, 0)], merged).astype(np.int64)
            front = np.where(front != _EMPTY, front << shift | np.maximum(left, 0), _NONE)
            has, inner = left >= 0, j < width
            leaf = np.concatenate([rows * (2 * width) + width + i, (rows * (2 * width) + width + left)[has], (rows * (2 * width) + width + j)[inner]])
            node[leaf] = np.concatenate([right, front[has], np.full(int(inner.sum()), _NONE)])
            place = np.concatenate([width + i, (width + left)[has], (width + j)[inner]])
            root = leaf - place
            while place[0] > 1:  # all leaves lie equally deep
                place = place >> 1
                node[root + place] = np.minimum(node[root + 2 * place], node[root + 2 * place + 1])
        ids = token[alive].astype("<u4").tobytes()
        ends = (4 * np.cumsum(alive.sum(1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _encode_stretches(self, stretches: list[str]) -> list[bytes]:
        """Ids of strings that are cut into pieces by the pattern, each by itself; distinct pieces are merged once."""
        cut = list(map(self.find, stretches))
        pieces = list(set().union(*cut))
        ids = dict(zip(pieces, self.merge_many([p.encode() for p in pieces]), strict=True))
        return [b"".join(map(ids.__getitem__, c)) for c in cut]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers.

        A single space with no white space on either side always starts a
        piece, and no rule of the pattern looks back; so the stretches between
        such spaces are encoded apart. The first one has no space before it; it is
        looked up with one, which no other stretch holds.
        """
        look = self.numbers.__getitem__
        cut = []
        for t in texts:
            head, *tail = t.split(" ")
            cut.append([look(" " + head), *map(look, tail)])
        new, values = self.numbers.new, self.values
        sound = [s for s in new if _is_apart(s.removeprefix(" "))]
        found = dict(zip(sound, self._encode_stretches([s[1:] if s[0] == " " else " " + s for s in sound]), strict=True))
        values.extend(map(found.get, new))
        out = []
        for t, numbers in zip(texts, cut, strict=True):
            parts = list(map(values.__getitem__, numbers))
            if None in parts:
                parts = self._joined(t.split(" "), parts)
            out.append(b"".join(parts))
        first = len(values) - len(new)
        kept = [x for x in zip(new, values[first:], strict=True) if len(x[0]) <= 64][: max(0, CACHE_LIMIT - first)]
        if len(kept) < len(new):  # the cache is full, or a long stretch isn't worth it
            for stretch in new:
                del self.numbers[stretch]
            del values[first:]
            for stretch, ids in kept:
                self.numbers[stretch] = len(values)
                values.append(ids)
        new.clear()
        return out

    def _joined(self, stretches: list[str], parts: list[bytes | None]) -> list[bytes]:
        """Stretches that border on white space, joined with their neighbours and encoded together."""
        start, before = 0, True
        groups: list[tuple[int, int]] = []  # stretches that can't be cut from each other
        for i, s in enumerate(stretches):
            # the space before a stretch is a cut if neither side of it is white space
            if i and before and s and not s[0].isspace():
                groups.append((start, i))
                start = i
            before = bool(s) and not s[-1].isspace()
        groups.append((start, len(stretches)))
        todo = [(k, a, b) for k, (a, b) in enumerate(groups) if b - a > 1 or parts[a] is None]
        held = [(" " if a else "") + " ".join(stretches[a:b]) for _, a, b in todo]
        out = [parts[a] or b"" for a, _ in groups]
        for (k, _, _), ids in zip(todo, self._encode_stretches(held), strict=True):
            out[k] = ids
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _is_apart(stretch: str) -> bool:
    return bool(stretch) and not stretch[0].isspace() and not stretch[-1].isspace()


class _Stretches(dict):
    """stretch -> number; one that isn't known gets the next number."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, stretch: str) -> int:
        number = self[stretch] = len(self)
        self.new.append(stretch)
        return number


@lru_cache(maxsize=2)
def codec(path: str | None = None, pattern: str | None = None) -> ByteBpe:
    """The codec of a rank file, loaded once in each Python worker."""
    import public_tokenizers

    with open(worker_file(path, VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ByteBpe(ranks, pattern or public_tokenizers.PATTERN)


def encode_documents(
    docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``keys`` and ``ids``: binary, little-endian unsigned 32-bit integers."""
    return per_text(docs, list(keys), text, lambda texts: {"ids": codec(path, pattern).encode_many(texts)}, "ids binary")


def encode_checked(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``keys``, ``ids`` as above, and whether the ids decode to the text again."""

    def run(texts: list[str]) -> dict[str, list]:
        bpe = codec(path, pattern)
        ids = bpe.encode_many(texts)
        return {"ids": ids, "round_trip": [bpe.decode(x) == t.encode() for x, t in zip(ids, texts, strict=True)]}

    return per_text(docs, list(keys), text, run, "ids binary, round_trip boolean")


def decode_documents(
    encoded: DataFrame, keys: tuple[str, ...] = ("doc_id",), path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``keys``, ``ids`` and ``decoded``: the bytes of the text."""
    import pyarrow as pa
    from pyspark.sql.types import StructType

    src = encoded.select(*keys, "ids")

    def run(batches):
        bpe = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                decoded = [bpe.decode(x or b"") for x in part.column(len(keys)).to_pylist()]
                yield part.append_column("decoded", pa.array(decoded, pa.binary()))

    return src.mapInArrow(run, StructType([*src.schema.fields]).add("decoded", "binary"))


def encode_and_decode(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``keys``, ``ids``, and ``decoded``: the bytes that the ids decode to; both in one pass."""

    def run(texts: list[str]) -> dict[str, list]:
        bpe = codec(path, pattern)
        ids = bpe.encode_many(texts)
        return {"ids": ids, "decoded": list(map(bpe.decode, ids))}

    return per_text(docs, list(keys), text, run, "ids binary, decoded binary")


def round_trip(docs: DataFrame) -> DataFrame:
    """Encodes, decodes, and returns the digests of both."""
    return encode_and_decode(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
