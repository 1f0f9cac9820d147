"""Operator 4: token ids in a compressed binary format (static range ANS).

``write`` encodes every whole text with a public tokenizer, appends the end
id, and writes the ids in ascending order of the document id:

    <path>/symbols/   id, frequency: the one table shared by all blocks
    <path>/blocks/    part, block, first (ids before it in its part), doc_ids,
                      lengths, payload; one row per block

Frequencies are counted over all ids of the corpus and scaled to 2^bits. A
block holds whole documents, at least ``BLOCK`` ids if there are as many. Its
ids are dealt to interleaved lanes, lane k taking ids k, k + lanes, ...; one
numpy step codes one id of every lane. Blocks don't depend on each other.
Within a block, a checkpoint every ``EVERY`` steps holds all lanes' states and
the place in the stream, so a decoder may start there. A block carries
checksums of its words and of its ids; both are verified.

A payload is little-endian: magic "RNS1", bits, lanes, ids, steps between
checkpoints, words, crc32 of the words, crc32 of the ids (u32 each), then the
checkpoints (u32 place, u64 state per lane) from step 0 on, then the words.

The tokenizer treats white space as a mere boundary, and so texts are cut at
blanks and line ends, and plain stretches on into the pieces of its split
pattern, for many texts at a time. The library encodes each distinct piece once
in a worker, as long as a bounded cache has room.

Cases: a null or empty text has only the end id; a null document id sorts
first; rows with equal ids are ordered by text, and dealt to several tasks as
long as their first 64 characters differ; an empty table gives empty files and
reads back empty.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popspark.llm.common import base_name, shared_path, shuffle_partitions, table, worker_file

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: ids of a block; lanes of a full block; steps between checkpoints
BLOCK, LANES, EVERY = 1 << 18, 1024, 64
#: pieces that a worker's cache holds (about 180 bytes each)
CACHE_LIMIT = 900_000
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4s7I")


#: fixed values: the tokenizer's own split pattern, and how it prepares a text
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: plain text: printable ASCII without A-Z, and the lower-case letters U+00DF to U+00FF, which no preparation changes
_LETTER = rb"[a-z]|\xc3[\x9f-\xb6\xb8-\xbf]"
_MARK = rb"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]"
_PLAIN = re.compile(rb"(?:%s|[0-9]|%s)+" % (_LETTER, _MARK)).fullmatch
#: the split pattern for plain text
_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|(?:%s)+|[0-9]|%s+" % (_LETTER, _MARK)).findall
#: the model's character for each byte: printable ones stand for themselves, the others follow from 256 on
_HIDDEN = [c for c in range(256) if not (0x21 <= c <= 0x7E or 0xA1 <= c <= 0xAC or 0xAE <= c)]
_SHOWN = {c: 256 + i for i, c in enumerate(_HIDDEN)}


#: bytes -> bytes: A-Z to a-z, a line end to a blank
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 10 else c for c in range(256))
#: kinds of bytes; an apostrophe counts as other, as it may begin a piece of marks or of letters
_BLANK, _ALPHA, _DIGIT, _SIGN, _OTHER = range(5)
_KINDS = bytes(
    _BLANK if c == 32 else _ALPHA if 97 <= c <= 122 else _DIGIT if 48 <= c <= 57
    else _OTHER if c == 39 or not re.fullmatch(_MARK, bytes([c])) else _SIGN
    for c in range(256)
)
#: whether \xc3 and this byte are a plain letter
_AFTER_C3 = np.array([re.fullmatch(_LETTER, bytes([0xC3, c])) is not None for c in range(256)])

#: packs a number of ids
_PACK = [struct.Struct(f"<{n}I").pack for n in range(65)]


def _cut(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin and end in lower-cased texts that have a blank before and after each.

    A plain stretch without apostrophes is cut as by the split pattern; another one stays whole.
    """
    kind = np.frombuffer(bytearray(data.translate(_KINDS)), np.uint8)
    raw = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero(raw == 0xC3)
    lead = lead[_AFTER_C3[raw[lead + 1]]]
    kind[lead] = kind[lead + 1] = _ALPHA
    edge = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    shown = kind != _BLANK
    begins, ends = np.flatnonzero(edge & shown[1:]) + 1, np.flatnonzero(edge & shown[:-1]) + 1
    other = kind[begins] == _OTHER
    if other.any():
        first = kind[begins - 1] == _BLANK
        stretch = np.cumsum(first) - 1
        whole = np.zeros(stretch[-1] + 1, bool)
        whole[stretch[other]] = True
        apart = ~whole[stretch]
        begins, ends = begins[apart | first], ends[apart | np.append(first[1:], True)]
    return begins, ends


class Words:
    """The tokenizer, with a bounded cache of the ids of pieces, and of stretches that aren't cut.

    The tokenizer lower-cases and takes each piece of a stretch on its own, so
    A-Z are lower-cased first, and the ids of a plain stretch are those of its
    pieces. Each distinct piece of a batch is looked up once, and an unknown
    one goes to the library's model; unknown stretches with other characters
    go through the whole tokenizer, many at a time, as words of one text. A
    file whose tokenizer prepares texts in another way is refused.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        steps = [x["type"] for x in (told.get("normalizer") or {}).get("normalizers", [])]
        cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        if steps != _NORMALIZERS or cuts[0].get("pattern") != {"Regex": _SPLIT} or told["model"]["type"] != "BPE":
            raise ValueError(f"{base_name(path)} prepares texts in another way than this operator knows")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.stretches: dict[bytes, bytes] = {}

    def _encode_many(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of strings without blanks, as words of one text; the offsets tell whose an id is."""
        got = {}
        for start in range(0, len(new), 2048):
            some = [x.decode() for x in new[start : start + 2048]]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.cumsum([0, *(len(x) + 1 for x in some)])
            at = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
            cuts = (4 * np.searchsorted(at, begins)).tolist()
            data = np.array(e.ids, "<u4").tobytes()
            for x, a, b in zip(new[start : start + 2048], cuts[:-1], cuts[1:], strict=True):
                got[x] = data[a:b]
        return got

    def _piece(self, piece: bytes) -> bytes:
        shown = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(_SHOWN)
        ids = [t.id for t in self.model.tokenize(shown)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def _look_up(self, distinct: list[bytes]) -> list[bytes]:
        """Ids of each piece or whole stretch; new ones are kept while there is room."""
        held, piece = self.stretches, self._piece
        out = list(map(held.get, distinct))
        new = [i for i, ids in enumerate(out) if ids is None]
        other = []
        for i in new:
            s = distinct[i]
            if s.isalpha():
                out[i] = piece(s)
            elif not _PLAIN(s):
                other.append(i)
            elif b"'" in s:
                out[i] = b"".join([held.get(p) or piece(p) for p in _PIECES(s)])
            else:
                out[i] = piece(s)
        if other:
            got = self._encode_many([distinct[i] for i in other])
            for i in other:
                out[i] = got[distinct[i]]
        room = max(0, CACHE_LIMIT - len(held))
        held.update([(distinct[i], out[i]) for i in new if len(distinct[i]) <= 64][:room])  # a long one isn't worth it
        return out

    def encode(self, texts: list[str], end: int = END_ID) -> list[bytes]:
        """Ids of each text and the end id, as little-endian unsigned 32-bit integers."""
        return self.encode_utf8([t.encode() for t in texts], end)

    def encode_utf8(self, texts: list[bytes], end: int = END_ID) -> list[bytes]:
        data = b" ".join([b"", *texts, b""]).translate(_LOWER)
        begins, ends = _cut(data)
        places = pa.py_buffer(np.concatenate([[0], np.cumsum(ends - begins)]))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, places, pa.py_buffer(data.translate(None, b" "))])
        coded = pieces.dictionary_encode()
        ids = pa.array(self._look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        flat = memoryview(ids.buffers()[2] or b"")
        starts = np.cumsum([1, *(len(t) + 1 for t in texts)])  # of the texts in data
        cuts = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(begins, starts)].tolist() if len(ids) else [0] * len(starts)
        last = struct.pack("<I", end)
        return [b"".join((flat[a:b], last)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=2)
def tokenizer(path: str | None = None) -> Words:
    return Words(worker_file(path, VOCABULARY))


class Symbols:
    """The shared table: ids, and their frequencies scaled to 2^bits."""

    def __init__(self, ids: np.ndarray, frequency: np.ndarray):
        self.ids, self.frequency = ids.astype(np.uint32), frequency.astype(np.uint64)
        self.bits = int(frequency.sum()).bit_length() - 1
        self.before = np.cumsum(self.frequency) - self.frequency
        self.of_slot = np.repeat(np.arange(len(ids), dtype=np.uint32), frequency.astype(np.int64))
        self.number = np.zeros(int(ids.max()) + 1, np.uint32)
        self.number[ids] = np.arange(len(ids))

    @staticmethod
    def scaled(ids: np.ndarray, counts: np.ndarray) -> Symbols:
        """Every id gets at least one of the 2^bits slots; the rest follows the counts."""
        order = np.argsort(ids)
        ids, counts = ids[order], counts[order].astype(float)
        bits = max(12, min(24, len(ids).bit_length() + 3))
        free = (1 << bits) - len(ids)
        frequency = 1 + np.floor(counts / counts.sum() * free).astype(np.int64)
        frequency[np.argmax(frequency)] += (1 << bits) - frequency.sum()
        return Symbols(ids, frequency)


def encode_block(ids: np.ndarray, symbols: Symbols) -> bytes:
    """The payload of one block; see the format above."""
    n, bits = len(ids), np.uint64(symbols.bits)
    lanes = max(1, min(LANES, n // EVERY))
    steps = -(-n // lanes)
    numbers = np.zeros(steps * lanes, np.uint32)
    numbers[:n] = symbols.number[ids]
    rows = numbers.reshape(steps, lanes)
    x = np.full(lanes, _LOW, np.uint64)
    words, points, total = [], [], 0
    room = np.uint64(63) - bits
    for t in range(steps - 1, -1, -1):
        f = symbols.frequency[rows[t]]
        full = x >= f << room
        if full.any():
            out = x[full]
            words.append(out.astype("<u4"))  # the low 32 bits
            total += len(out)
            x[full] = out >> np.uint64(32)
        q = x // f
        x = (q << bits) + (x - q * f) + symbols.before[rows[t]]
        if t % EVERY == 0:
            points.append((total, x.tobytes()))
    stream = b"".join(w.tobytes() for w in reversed(words))
    marks = b"".join(struct.pack("<I", total - place) + state for place, state in reversed(points))
    head = _HEAD.pack(b"RNS1", symbols.bits, lanes, n, EVERY, total, crc32(stream), crc32(ids.astype("<u4").tobytes()))
    return head + marks + stream


def decode_block(payload: bytes, symbols: Symbols, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids from ``first`` up to ``last`` of a block, starting at the checkpoint before ``first``."""
    magic, bits, lanes, n, every, total, words_crc, ids_crc = _HEAD.unpack_from(payload)
    if magic != b"RNS1" or bits != symbols.bits:
        raise ValueError("not a block of this table")
    steps = -(-n // lanes)
    points = -(-steps // every)
    size = 4 + 8 * lanes
    at = _HEAD.size + points * size
    stream = payload[at : at + 4 * total]
    if crc32(stream) != words_crc:
        raise ValueError("damaged words")
    words = np.frombuffer(stream, "<u4").astype(np.uint64)
    last = n if last is None else min(last, n)
    start = first // lanes // every
    mark = _HEAD.size + start * size
    place = struct.unpack_from("<I", payload, mark)[0]
    x = np.frombuffer(payload, "<u8", lanes, mark + 4).astype(np.uint64)
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    begin, end = start * every, min(-(-last // lanes), steps)
    out = np.empty((max(end - begin, 0), lanes), np.uint32)
    for t in range(len(out)):
        slot = x & mask
        s = symbols.of_slot[slot]
        out[t] = s
        x = symbols.frequency[s] * (x >> shift) + slot - symbols.before[s]
        low = x < _LOW
        k = int(np.count_nonzero(low))
        if k:
            x[low] = (x[low] << np.uint64(32)) | words[place : place + k]
            place += k
    ids = symbols.ids[out.ravel()]
    if first == 0 and last == n:
        ids = ids[:n]
        if crc32(ids.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("damaged ids")
    return ids[first - begin * lanes : last - begin * lanes]


#: the ``seq`` of a row that holds its task's histogram, in a column of its own, in place of a document's ids
COUNTS = -1
_TOKENS = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("first", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
_BLOCKS = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])


def _narrow(ids: np.ndarray) -> bytes:
    """Staged ids: a byte that tells the width, then the ids."""
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\4" + ids.astype("<u4").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def _tokenise(path: str | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, first = TaskContext.get().partitionId(), 0, 0
        counts = np.zeros(0, np.int64)
        for rb in batches:
            start, size, texts = 0, 0, rb.column(1).cast(pa.binary()).to_pylist()
            for i, t in enumerate(texts):
                size += len(t)
                if size < 4_000_000 and i + 1 < len(texts):
                    continue
                ids = [np.frombuffer(x, "<u4") for x in tokenizer(path).encode_utf8(texts[start : i + 1])]
                counts = _added(counts, np.bincount(np.concatenate(ids)))
                sizes = np.array([len(x) for x in ids])
                firsts = first + np.cumsum(sizes) - sizes
                cols = [[part] * len(ids), range(seq, seq + len(ids)), firsts, rb.column(0).slice(start, len(ids)), list(map(_narrow, ids)), pa.nulls(len(ids), pa.binary())]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, _TOKENS, strict=True)], schema=_TOKENS)
                seq, first = seq + len(ids), first + int(sizes.sum())
                start, size = i + 1, 0
        if seq:
            row = (part, COUNTS, first, None, None, counts.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _TOKENS, strict=True)], schema=_TOKENS)

    return run


def _added(total: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The sum of two histograms of any length."""
    longer, shorter = (own, total) if len(own) > len(total) else (total, own)
    longer[: len(shorter)] += shorter
    return longer


def _histogram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) of the writer tasks' histograms."""
    total = np.zeros(0, np.int64)
    for rb in batches:
        for x in rb.column(0).to_pylist():
            total = _added(total, np.frombuffer(x, "<i8").copy())
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])


def _blocks(shared):
    """Blocks of neighbouring documents; a task's rows may come from several parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols: Symbols = shared.value
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            payload = encode_block(np.concatenate([h[4] for h in held]), symbols)
            row = (held[0][0], held[0][2], [h[3] for h in held], [len(h[4]) for h in held], payload)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCKS, strict=True)], schema=_BLOCKS)

        for rb in batches:
            for part, seq, first, doc, data in zip(*(c.to_pylist() for c in rb.columns), strict=True):
                if held and (size >= BLOCK or part != held[-1][0] or seq != held[-1][1] + 1):
                    yield flush()
                    held, size = [], 0
                held.append((part, seq, first, doc, _wide(data)))
                size += len(held[-1][4])
        if held:
            yield flush()

    return run


def write(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encodes the documents and writes the file set at ``path``, in order of doc_id."""
    spark = docs.sparkSession
    stage = shared_path(spark, "token-ids")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(shuffle_partitions(spark), "doc_id", F.substring("text", 1, 64))  # the order of text, also where an id repeats
        .sortWithinPartitions("doc_id", "text")
    )
    ddl = "part int, seq long, first long, doc_id long, ids binary, counts binary"
    ordered.mapInArrow(_tokenise(vocabulary), ddl).write.option("compression", "zstd").parquet(stage)
    staged = spark.read.schema(ddl).parquet(stage)
    tokens, counts = staged.filter(F.col("seq") != COUNTS).drop("counts"), staged.filter(F.col("seq") == COUNTS)
    counts = counts.select("counts").mapInArrow(_histogram, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # a row per used id
    ids, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
    symbols = Symbols.scaled(ids, n) if len(ids) else Symbols(np.array([END_ID]), np.array([1 << 12]))
    table_rows = pa.table({"id": symbols.ids.astype(np.int64), "frequency": symbols.frequency.astype(np.int64)})
    spark.createDataFrame(table_rows).coalesce(1).write.parquet(f"{path}/symbols")
    blocks = tokens.mapInArrow(_blocks(spark.sparkContext.broadcast(symbols)), "part int, first long, doc_ids array<long>, lengths array<long>, payload binary")
    blocks.write.option("compression", "none").partitionBy("part").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (binary, unsigned 32-bit), decoded block by block."""
    rows = spark.read.schema("id long, frequency long").parquet(f"{path}/symbols").orderBy("id").toArrow()
    shared = spark.sparkContext.broadcast(Symbols(rows.column("id").to_numpy(), rows.column("frequency").to_numpy()))
    blocks = spark.read.schema("first long, doc_ids array<long>, lengths array<long>, payload binary, part int").parquet(f"{path}/blocks")
    # one row per part, so as many as the writer had tasks
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("size"))
    behind = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(behind), F.lit(0)).alias("offset"))
    schema = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for part, first, docs, lengths, payload in zip(*(c.to_pylist() for c in rb.columns), strict=True):
                ids = decode_block(payload, shared.value)
                cuts = np.cumsum([0, *lengths])
                own = [ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(docs), pa.int32()), pa.array(first + cuts[:-1], pa.int64()), pa.array(docs, pa.int64()), pa.array(own, pa.binary())], schema=schema)

    found = blocks.select("part", "first", "doc_ids", "lengths", "payload").mapInArrow(run, "part int, start long, doc_id long, ids binary")
    return found.join(F.broadcast(offsets), "part").select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "ids")


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-file")
    write(table(spark, sf_dir, "documents"), path)
    return read(spark, path).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
